"""Writers: run rows, diagnoses and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from runpulse import schemas
from runpulse.functions.text import cut


def append_runs(runs: DataFrame, path: str, message_length: int | None = None) -> None:
    """Append run rows to a table laid out by day, error messages whole unless a length is given.

    Rows are gathered by day; the rebalance hint lets Spark split a day that holds much of the data
    among tasks and put small days together, by the sizes it sees.
    """
    (
        runs.withColumn("error_message", cut("error_message", message_length))
        .withColumn("run_date", F.to_date("execution_date"))
        .hint("rebalance", F.col("run_date"))
        .sortWithinPartitions("run_date", "pipeline_id", "execution_date")
        .write.mode("append")
        .partitionBy("run_date")
        .parquet(path)
    )


def merge_diagnoses(runs: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """Replace all diagnosis columns of the runs whose id is in `diagnoses`; leave the others as they are.

    A matched row takes every column from its diagnosis, nulls included. Of several diagnoses of an id the one
    generated last is taken, of equally late ones the largest in its columns' order. Rows of `runs` never multiply.
    """
    names = schemas.DIAGNOSIS_COLUMNS.fieldNames()
    last = F.max(F.struct("rca_generated_at", *[F.col(c).alias(f"{c}_") for c in names])).alias("_last")
    diagnoses = diagnoses.groupBy("id").agg(last).select("id", *[F.col(f"_last.{c}_").alias(c) for c in names])
    kept = runs if "rca_root_cause" in runs.columns else runs.select("*", *_empty_diagnosis())
    new = diagnoses.select("id", *[F.col(c).alias(f"_new_{c}") for c in names], F.lit(True).alias("_hit"))
    merged = kept.join(new, "id", "left")
    return merged.select(
        *[
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in names else F.col(c)
            for c in kept.columns
        ]
    )


def _empty_diagnosis():
    return [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.DIAGNOSIS_COLUMNS.fields]


def write_alerts(alerts: DataFrame, path: str, fmt: str = "json") -> None:
    """Append alert rows, laid out by day and severity. Sending them is left to whoever reads the table."""
    (
        alerts.withColumn("alert_date", F.to_date("execution_date"))
        .write.mode("append")
        .partitionBy("alert_date", "severity")
        .format(fmt)
        .save(path)
    )
