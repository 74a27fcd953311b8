"""Join of many rows with one row per key, safe for a key that holds much of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SALTS = 16


def salted_join(
    rows: DataFrame, per_key: DataFrame, keys: list[str], row_id: str, how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Join `rows` to `per_key` (one row per `keys`), each key's rows divided among `salts` tasks.

    Streams do not split skewed partitions at run time; this does it in the plan, at the price of `salts`
    copies of the small side. Spark still broadcasts that side where its size allows.
    """
    salt = F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int")
    copies = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", salt).join(copies, [*keys, "_salt"], how).drop("_salt")
