"""Which keys differ between a table and its copy."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Bits of a key's hash that name its slot: the most slots whose sums are compared.
SLOT_BITS = 16


def copy_differences(source: DataFrame, copy: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (`keys`, `status`, `source_rows`, `copy_rows`) of every key whose rows are not the same on both sides.

    `status` is `missing` (not in the copy), `extra` (only in the copy) or `changed` (other values, or another number of
    rows). Rows are compared by a 64-bit hash of all columns of `source`, by name; the order of rows does not matter, and
    null keys are keys. Both sides are first summed up into slots of key hashes, at most 2**SLOT_BITS rows, which is
    all that equal tables cost. Only rows in slots whose sums differ are grouped by key; rows are added up before each shuffle, so a
    key with very many rows is no hot task.
    """
    columns = sorted(source.columns)
    sign = {"source": 1, "copy": -1}

    def hashed(df: DataFrame, side: str) -> DataFrame:
        slot = F.shiftrightunsigned(F.xxhash64(*keys), 64 - SLOT_BITS)
        mark = F.xxhash64(*columns).cast("decimal(20,0)") * sign[side]
        ones = [F.lit(int(side == s)).alias(f"{s}_rows") for s in sign]
        return df.select(F.struct(*keys).alias("key"), slot.alias("slot"), mark.alias("mark"), *ones)

    def summed(df: DataFrame, by: str) -> DataFrame:
        sums = [F.sum(f"{s}_rows").alias(f"{s}_rows") for s in sign]
        return df.groupBy(by).agg(*sums, F.sum(F.col("mark").cast("decimal(38,0)")).alias("mark")).filter(
            "source_rows <> copy_rows OR mark <> 0"
        )

    both = hashed(source, "source").unionByName(hashed(copy, "copy"))
    off = summed(both, "slot").select("slot")
    found = summed(both.join(off, "slot", "left_semi"), "key")
    status = F.when(F.col("copy_rows") == 0, "missing").when(F.col("source_rows") == 0, "extra").otherwise("changed")
    return found.select(*[F.col("key")[k].alias(k) for k in keys], status.alias("status"), "source_rows", "copy_rows")
