"""A run table on a file store: appends and diagnoses that can be repeated, each touching only the days it must.

The table lies in folders by `run_date`. A job gives its write a name; once all of the write is in place a marker with that name
is left beside the table, and a job that runs again finds it and does nothing. A job that died before its marker starts
over: appends leave out rows that are there already, and a write-back replaces a day by what it was made from, so
both end in the same table however often they run. One writer per table at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from runpulse.session import cut_lineage, discard
from runpulse.sources.sinks import append_runs, merge_diagnoses

#: Markers of finished writes; Spark's readers skip names that begin with an underscore.
MARKERS = "_written"


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def is_written(spark: SparkSession, path: str, write: str) -> bool:
    """Whether the write of that name is finished."""
    fs, place = _place(spark, f"{path}/{MARKERS}/{write}")
    return fs.exists(place)


def _mark(spark: SparkSession, path: str, write: str) -> None:
    fs, place = _place(spark, f"{path}/{MARKERS}/{write}")
    fs.create(place, True).close()


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether the table has any day."""
    fs, place = _place(spark, f"{path}/run_date=*")
    return bool(fs.globStatus(place))


def _days(rows: DataFrame) -> list:
    """The distinct `run_date`s, one per day of the table at most."""
    return [r[0] for r in rows.select("run_date").distinct().collect()]


def _any_of(days: list) -> Column:
    known = F.col("run_date").isin([d for d in days if d is not None])
    return known | F.col("run_date").isNull() if None in days else known


def _keys(spark: SparkSession, path: str) -> DataFrame:
    """Ids and days of the stored runs, without opening a file for its schema."""
    return spark.read.schema("id bigint, run_date date").parquet(path)


def read_store(spark: SparkSession, path: str, days: list | None = None) -> DataFrame:
    """The stored runs with `run_date`, of the given days or of all; days with and without diagnoses may stand side by side."""
    names = ["__HIVE_DEFAULT_PARTITION__" if d is None else d.isoformat() for d in days or []]
    paths = [path] if days is None else [f"{path}/run_date={name}" for name in names]
    stored = spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*paths)
    return stored.withColumn("run_date", F.col("run_date").cast("date"))  # without any day the folders tell no type


def append_once(runs: DataFrame, path: str, write: str) -> bool:
    """Append the runs whose id is not yet stored on their day; whether anything had to be done.

    Only the days of the new rows are looked at, and of them only the ids. Rows without an id cannot be told apart and are left to
    the marker: a job that dies between its append and its marker may store them twice. Of rows with one id and day, one is stored.
    """
    spark = runs.sparkSession
    if is_written(spark, path, write):
        return False
    dated = runs.withColumn("run_date", F.to_date("execution_date"))
    named = dated.filter("id IS NOT NULL").dropDuplicates(["id", "run_date"])
    if _exists(spark, path):
        there = _keys(spark, path).filter(_any_of(_days(dated))).select(F.col("id").alias("_id"), F.col("run_date").alias("_day"))
        same = (F.col("id") == F.col("_id")) & F.col("run_date").eqNullSafe(F.col("_day"))
        named = named.join(there, same, "left_anti")
    append_runs(named.unionByName(dated.filter("id IS NULL")).drop("run_date"), path)
    _mark(spark, path, write)
    return True


def store_diagnoses(diagnoses: DataFrame, path: str, write: str) -> bool:
    """Write diagnoses back into the stored runs with their id; whether anything had to be done.

    Days that hold no such run keep their files. The others are put together anew in the shared folder (a matched run takes all
    diagnosis columns, nulls included; see `merge_diagnoses`) and then replaced. With a `run_date` column in `diagnoses` only these days are
    looked at, otherwise the ids of all days.
    """
    spark = diagnoses.sparkSession
    if is_written(spark, path, write):
        return False
    wanted = cut_lineage(diagnoses, "diagnoses")
    keys = _keys(spark, path)
    if "run_date" in wanted.columns:
        keys = keys.filter(_any_of(_days(wanted)))
    touched = _days(keys.join(wanted.select("id").distinct(), "id", "left_semi"))
    if touched:
        merged = merge_diagnoses(read_store(spark, path, touched), wanted.drop("run_date"))
        days = cut_lineage(merged, "rewritten-days")
        (
            days.hint("rebalance", F.col("run_date"))
            .sortWithinPartitions("run_date", "pipeline_id", "execution_date")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_date").parquet(path)
        )
        discard(days)
    discard(wanted)
    _mark(spark, path, write)
    return True
