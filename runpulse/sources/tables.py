"""Readers for run, sample, log and text tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from runpulse import schemas


def read_runs(spark: SparkSession, path: str, schema: T.StructType = schemas.RUNS) -> DataFrame:
    """Run table in Parquet. The schema is given, so no file is opened to infer it."""
    return spark.read.schema(schema).parquet(path)


def read_runs_jdbc(
    spark: SparkSession, url: str, table: str, low: int, high: int, parts: int, **options: str
) -> DataFrame:
    """Run table in an external database, read in `parts` ranges of `id` at the same time."""
    return (
        spark.read.format("jdbc")
        .options(
            url=url, dbtable=table, partitionColumn="id", lowerBound=str(low), upperBound=str(high),
            numPartitions=str(parts), pushDownPredicate="true", **options,
        )
        .load()
    )


def read_samples(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Labelled metric samples from Parquet or JSON lines; labels are a map."""
    return spark.read.schema(schemas.SAMPLES).format(fmt).load(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """Text files, one row per line in column `text`."""
    return spark.read.text(path).withColumnRenamed("value", "text")


def register_baselines_view(baselines: DataFrame, name: str = "run_baselines") -> DataFrame:
    """Publish a baseline table under a name that SQL can use."""
    baselines.createOrReplaceTempView(name)
    return baselines.sparkSession.table(name)


def document_lines(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Log lines (task, line_no, line) from whole texts, one row per line."""
    return documents.select(
        F.concat(F.lit("task_"), F.col(key).cast("string")).alias("task"),
        F.posexplode(F.split(text, "\n")).alias("line_no", "line"),
    ).withColumn("line_no", F.col("line_no").cast("bigint"))
