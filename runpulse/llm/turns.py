"""Places and prefix names of the turns of conversations, divided among tasks where one conversation is long."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from runpulse.session import cut_lineage

#: Neighbouring turns of a conversation whose running sums are made together.
BLOCK = 4096
#: Bits that number the rows of one partition in `monotonically_increasing_id`.
ROW_BITS = 33


def joined(rows: DataFrame, per_key: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join with a table that has one row per `keys`; a key that is null is equal to a null."""
    named = per_key.withColumnsRenamed({k: f"_{k}_key" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}_key")) for k in keys]
    return rows.join(named, reduce(and_, same), how).drop(*[f"_{k}_key" for k in keys])


def numbered(rows: DataFrame, keys: list[str], order: list[str], keep: list[str], name: str = "place") -> DataFrame:
    """`keys`, `keep` and the place (from 1) of each row among the rows of its keys along `order`, nulls first.

    Rows are sorted over all tasks by (keys, order), so the rows of a large key lie in many tasks; what a task has of a
    key is a run without gaps, and a key's earlier runs are counted in one row per task. Equal rows are numbered in any order.
    """
    along = [*keys, *order, "_tie"]
    spread = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*along).sortWithinPartitions(*along)
    spread = cut_lineage(spread.withColumn("_at", F.monotonically_increasing_id()).select(*keys, *keep, "_at"), "spread")
    spread = spread.withColumn("_part", F.shiftright("_at", ROW_BITS))
    runs = spread.groupBy(*keys, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    shifts = runs.select(*keys, "_part", (before - F.col("_first") + 1).alias("_shift"))
    placed = joined(spread, shifts, [*keys, "_part"])
    return placed.select(*keys, *keep, (F.col("_at") + F.col("_shift")).alias(name))


def running_sums(rows: DataFrame, keys: list[str], place: str, sums: dict[str, Column]) -> DataFrame:
    """Add running sums along `place`, which numbers the rows of each key without gaps, block by block."""
    blocked = rows.withColumn("_block", F.floor(F.col(place) / BLOCK))
    whole = blocked.groupBy(*keys, "_block").agg(*[F.sum(x).alias(f"_all_{n}") for n, x in sums.items()])
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = whole.select(
        *keys, "_block", *[F.coalesce(F.sum(f"_all_{n}").over(earlier), F.lit(0)).alias(f"_carry_{n}") for n in sums]
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    added = {n: F.sum(x).over(inside) + F.col(f"_carry_{n}") for n, x in sums.items()}
    return joined(blocked, carry, [*keys, "_block"]).withColumns(added).drop("_block", *[f"_carry_{n}" for n in sums])


def content_hashes(role: str = "role", text: str = "text") -> list[Column]:
    """Two 64-bit hashes of what a turn says."""
    return [F.xxhash64(F.lit(seed), role, text).alias(f"says_{seed}") for seed in (0, 1)]


def prefix_nodes(turns: DataFrame, keys: list[str], depth: str) -> DataFrame:
    """Add `node` and `parent`: names of the sequence of turns up to this one and up to the one before.

    `turns` numbers the turns of each key by `depth` from 1 and has `says_0` and `says_1`. A name is made from sums of 128
    bits of hashes of what each turn says at its place, so equal sequences have equal names wherever they stand and no
    conversation is read from its start by one task.
    """
    at = [F.xxhash64(F.lit(seed), depth, "says_0", "says_1") for seed in (2, 3)]
    lanes = {f"_lane_{2 * i + j}": x for i, h in enumerate(at) for j, x in enumerate((h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32)))}
    named = running_sums(turns.withColumns({f"{n}_own": x for n, x in lanes.items()}), keys, depth, {n: F.col(f"{n}_own") for n in lanes})
    return named.withColumns(
        {
            "node": F.md5(F.concat_ws(",", *lanes)),
            "parent": F.md5(F.concat_ws(",", *[F.col(n) - F.col(f"{n}_own") for n in lanes])),
        }
    ).drop(*lanes, *[f"{n}_own" for n in lanes])


def root_name() -> Column:
    """The name of the empty sequence."""
    return F.md5(F.lit("0,0,0,0"))
