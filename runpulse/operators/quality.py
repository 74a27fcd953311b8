"""Checks of copied and loaded tables, and of submitted jobs."""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from runpulse.operators.baselines import _day


def fingerprint(df: DataFrame) -> Column:
    """Aggregate that depends on all values of all rows, but not on their order."""
    return F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))


def observed_copy(spark: SparkSession, source: str, target: str) -> tuple[int, int | None, DataFrame]:
    """Copy a Parquet table: the rows read, their fingerprint, both taken while writing, and the copy."""
    table = spark.read.parquet(source)
    seen = Observation()
    table.observe(seen, F.count(F.lit(1)).alias("n"), fingerprint(table).alias("mark")).write.mode("overwrite").parquet(target)
    return seen.get["n"], seen.get["mark"], spark.read.schema(table.schema).parquet(target)


def copy_tables(
    spark: SparkSession, source_dir: str, target_dir: str, names: list[str], at_once: int = 4
) -> DataFrame:
    """Copy Parquet tables and report, per table, the rows on both sides and whether the content is equal.

    A source is read once: its rows are counted and fingerprinted while they are written. A few copies run at the same time, so
    that small tables do not leave the cluster idle.
    """
    with ThreadPool(at_once) as pool:
        copies = pool.map(lambda n: observed_copy(spark, f"{source_dir}/{n}.parquet", f"{target_dir}/{n}"), names)
    reports = [
        copy.agg(F.count("*").alias("copied_rows"), fingerprint(copy).alias("mark")).select(
            F.lit(name).alias("table_name"),
            F.lit(rows).cast("bigint").alias("source_rows"),
            "copied_rows",
            F.col("mark").eqNullSafe(F.lit(mark).cast("decimal(38,0)")).alias("same_content"),
        )
        for name, (rows, mark, copy) in zip(names, copies)
    ]
    return reduce(DataFrame.unionByName, reports)


def row_count_validation(expected: DataFrame, loaded: DataFrame, ts: str = "execution_date") -> DataFrame:
    """Rows per day in two tables, the difference, and a status."""
    count = lambda df, name: df.groupBy(_day(ts).alias("day")).agg(F.count("*").alias(name))
    both = count(expected, "expected_rows").join(count(loaded, "loaded_rows"), "day", "full")
    e, n = (F.coalesce(c, F.lit(0)).cast("bigint") for c in ("expected_rows", "loaded_rows"))
    return both.select("day", e.alias("expected_rows"), n.alias("loaded_rows")).select(
        "*",
        (F.col("loaded_rows") - F.col("expected_rows")).alias("difference"),
        F.when(F.col("loaded_rows") == 0, "missing")
        .when(F.col("loaded_rows") < F.col("expected_rows"), "short")
        .when(F.col("loaded_rows") > F.col("expected_rows"), "extra")
        .otherwise("ok")
        .alias("status"),
    )


def partition_gaps(runs: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Days inside the range for which a pipeline has no rows."""
    present = runs.select("pipeline_id", _day().alias("day")).distinct()
    days = F.explode(
        F.sequence(F.lit(first_day).cast("timestamp_ntz"), F.lit(last_day).cast("timestamp_ntz"), F.expr("interval 1 day"))
    )
    expected = present.select("pipeline_id").distinct().select("pipeline_id", days.alias("day"))
    return expected.join(present, ["pipeline_id", "day"], "left_anti")


def incomplete_jobs(status: DataFrame) -> DataFrame:
    """Submitted jobs whose latest state is not COMPLETED."""
    newest = Window.partitionBy("app").orderBy(F.desc("ts"), F.desc("status_id"))
    return (
        status.withColumn("_n", F.row_number().over(newest))
        .filter((F.col("_n") == 1) & (F.coalesce("state", F.lit("")) != "COMPLETED"))
        .select("app", "ts", "state")
    )
