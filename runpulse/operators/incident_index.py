"""A stored index of known failure signatures, in which new failures look up the nearest known one.

The index holds one row per signature (words, number of incidents, last time) and its MinHash bands. A look-up reads the bands
of the new signatures' keys and compares those candidates; known signatures are not compared with each other again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from runpulse.functions.text import signature
from runpulse.operators.baselines import is_state
from runpulse.operators.joins import salted_join
from runpulse.session import cut_lineage, discard

#: Bands and minimal hashes per band: signatures whose words overlap by 0.6 share no band once in 40,000 times.
BANDS, DEPTH = 24, 2
#: Overlap of words (Jaccard) from which two signatures are near.
LEAST = 0.6


def _signatures(runs: DataFrame) -> DataFrame:
    """The different signatures of failed runs; a failure without a message has none."""
    failed = runs.filter(is_state("failed")).select(signature("error_message").alias("signature"), "execution_date")
    known = failed.filter(F.col("signature").isNotNull()).groupBy("signature")
    counted = known.agg(F.count("*").alias("incidents"), F.max("execution_date").alias("last_seen"))
    words = F.array_sort(F.array_distinct(F.split("signature", " ")))
    return counted.select(F.md5("signature").alias("fingerprint"), words.alias("words"), "incidents", "last_seen")


def _bands(signatures: DataFrame) -> DataFrame:
    """Rows (`band`, `key`, `fingerprint`)."""

    def least(seed: int) -> Column:
        return F.array_min(F.transform("words", lambda w: F.xxhash64(w, F.lit(seed))))

    keys = [F.xxhash64(*[least(band * DEPTH + k) for k in range(DEPTH)]) for band in range(BANDS)]
    return signatures.select("fingerprint", F.posexplode(F.array(*keys)).alias("band", "key"))


def build_index(runs: DataFrame, path: str) -> None:
    """Write the index of all failed runs' signatures below `path`, in place of what is there."""
    found = cut_lineage(_signatures(runs), "signatures")
    found.write.mode("overwrite").parquet(f"{path}/signatures")
    _bands(found).write.mode("overwrite").partitionBy("band").parquet(f"{path}/bands")
    discard(found)


def _read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    schema = "fingerprint string, words array<string>, incidents bigint, last_seen timestamp_ntz"
    bands = spark.read.schema("fingerprint string, key bigint, band int").parquet(f"{path}/bands")
    return spark.read.schema(schema).parquet(f"{path}/signatures"), bands


def nearest_signatures(new: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Rows (`fingerprint`, `nearest`, `overlap`, `incidents`, `last_seen`) for signatures with a near known one.

    The largest overlap wins, then the smallest fingerprint. A signature that is in the index is its own nearest with overlap 1, if
    no other of the same words has a smaller fingerprint.
    """
    known, bands = _read(spark, path)
    pairs = (
        _bands(new).join(bands.withColumnRenamed("fingerprint", "nearest"), ["band", "key"])
        .select("fingerprint", "nearest").distinct()
    )
    met = pairs.join(new.select("fingerprint", F.col("words").alias("_new")), "fingerprint").join(
        known.select(F.col("fingerprint").alias("nearest"), F.col("words").alias("_old"), "incidents", "last_seen"), "nearest"
    )
    overlap = F.size(F.array_intersect("_new", "_old")) / F.size(F.array_union("_new", "_old"))
    scored = met.select("fingerprint", "nearest", overlap.alias("overlap"), "incidents", "last_seen")
    order = F.struct((-F.col("overlap")).alias("o"), "nearest")
    best = scored.filter(F.col("overlap") >= LEAST).groupBy("fingerprint")
    return best.agg(F.min_by(F.struct("nearest", "overlap", "incidents", "last_seen"), order).alias("b")).select(
        "fingerprint", "b.nearest", "b.overlap", "b.incidents", "b.last_seen"
    )


def look_up(runs: DataFrame, path: str) -> DataFrame:
    """Failed runs with the nearest known signature, its overlap, how many incidents it had and when the last one was.

    Without a near one, or without a message, these are null, and `incidents` is 0. The index is not changed.
    """
    spark = runs.sparkSession
    new = cut_lineage(_signatures(runs).select("fingerprint", "words"), "new-signatures")
    found = nearest_signatures(new, spark, path)
    rows = runs.filter(is_state("failed")).select("id", "pipeline_id", F.md5(signature("error_message")).alias("fingerprint"))
    return salted_join(rows, found, ["fingerprint"], "id", "left").select(
        "id", "pipeline_id", "fingerprint", "nearest", "overlap",
        F.coalesce("incidents", F.lit(0)).cast("bigint").alias("incidents"), "last_seen",
    )
