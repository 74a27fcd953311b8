"""Streaming forms of the checks: run events arrive in files and are judged as they come.

Event time is cast from a timestamp without zone, which a watermark does not accept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from runpulse import schemas
from runpulse.functions.measures import or_zero
from runpulse.operators.baselines import MIN_RUNS, SIGMAS, finished_runs, is_state
from runpulse.operators.joins import salted_join
from runpulse.operators.slices import micros, trailing_moments
from runpulse.streaming.upserts import Upserts

LATE = "10 minutes"


def read_run_stream(
    spark: SparkSession, path: str, schema: T.StructType = schemas.RUN_FACTS, files_per_trigger: int | None = None
) -> DataFrame:
    """Run rows as they are added to a folder, with `event_time`."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).withColumn("event_time", F.col("execution_date").cast("timestamp"))


def deduplicated(stream: DataFrame, late: str = LATE) -> DataFrame:
    """Each run once; rows later than the watermark are dropped, and so are replays of a row."""
    return stream.withWatermark("event_time", late).dropDuplicatesWithinWatermark(["id"])


def window_health(stream: DataFrame, length: str = "30 minutes", every: str | None = None) -> DataFrame:
    """Runs, failures and mean duration per pipeline and closed window; `every` makes the windows slide."""
    return (
        stream.groupBy("pipeline_id", F.window("event_time", length, every or length).alias("w"))
        .agg(
            F.count("*").alias("runs"),
            F.count_if(is_state("failed")).alias("failures"),
            F.avg("duration_seconds").alias("avg_duration"),
        )
        .select("pipeline_id", F.col("w.start").alias("window_start"), "runs", "failures", "avg_duration")
    )


def incident_sessions(stream: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Closed sessions of a pipeline's runs."""
    return (
        stream.groupBy("pipeline_id", F.session_window("event_time", gap).alias("s"))
        .agg(
            F.count("*").alias("runs"),
            F.count_if(is_state("failed")).alias("failures"),
            F.min("event_time").alias("first_seen"),
            F.max("event_time").alias("last_seen"),
        )
        .drop("s")
    )


def judged_stream(stream: DataFrame, baselines: DataFrame) -> DataFrame:
    """Finished runs above the upper bound of published baselines, as they arrive."""
    now = or_zero("duration_seconds")
    published = baselines.select("pipeline_id", "avg_duration", "upper_threshold")
    return (
        salted_join(finished_runs(stream), published, ["pipeline_id"], "id")
        .filter((now > F.col("upper_threshold")) & (F.col("upper_threshold") > 0))
    )


STATE = T.StructType(
    [
        T.StructField("pipeline_id", T.StringType()), T.StructField("n", T.LongType()), T.StructField("mean", T.DoubleType()),
        T.StructField("m2", T.DoubleType()), T.StructField("last_run", T.TimestampNTZType()),
    ]
)


def running_detector(path: str, min_runs: int = MIN_RUNS, forget_days: int | None = None) -> Callable[[DataFrame, int], None]:
    """Batch function that judges each finished run against all runs of its pipeline before it.

    Count, mean and sum of squared deviations per pipeline are kept as `Upserts` below `path`: a batch adds one row for each
    pipeline it has runs of. With `forget_days` a pipeline whose last run is that many days older than the newest one loses its state.
    Inside a batch the earlier rows come from sliced running sums, so a pipeline that sends much of the
    data does not end up in one task, as it would with state per key. A batch that is run again reads the
    same earlier state and overwrites its own output.
    """
    state = Upserts(f"{path}/state", STATE, ["pipeline_id"], expire=None if forget_days is None else ("last_run", forget_days))

    def judge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = (
            finished_runs(batch)
            .select("pipeline_id", "id", "run_id", "execution_date", "duration_seconds", micros("execution_date").alias("_at"))
            .persist()
        )
        try:
            named = rows.select("pipeline_id").distinct()
            known = state.current(spark, batch_id).join(named, "pipeline_id", "left_semi").persist()
            inside = trailing_moments(rows, ["pipeline_id"], "_at", "id", "duration_seconds", None)
            here = {
                "n2": F.coalesce("prior_rows", F.lit(0)),
                "mean2": or_zero("prior_avg"),
                "m22": or_zero("prior_stddev") * or_zero("prior_stddev") * F.greatest(F.col("prior_rows") - 1, F.lit(0)),
            }
            seen = _merge_moments(salted_join(inside.withColumns(here), known.drop("last_run"), ["pipeline_id"], "id", "left"))
            value = or_zero("duration_seconds")
            upper = F.col("mean") + SIGMAS * F.sqrt(F.col("m2") / F.nullif(F.col("n") - 1, F.lit(0)))
            hits = (
                seen.withColumn("upper", upper)
                .filter((F.col("n") >= min_runs) & (value > F.col("upper")) & (F.col("upper") > 0))
                .select("pipeline_id", "id", "run_id", "execution_date", "duration_seconds", F.col("n").alias("prior_rows"), "mean", "upper")
            )
            hits.write.mode("overwrite").parquet(f"{path}/hits/batch={batch_id}")
            totals = rows.groupBy("pipeline_id").agg(
                F.count("duration_seconds").alias("n2"),
                or_zero(F.avg("duration_seconds")).alias("mean2"),
                or_zero(F.var_pop("duration_seconds") * F.count("duration_seconds")).alias("m22"),
                F.max("execution_date").alias("_last"),
            )
            both = _merge_moments(totals.join(known, "pipeline_id", "left"))
            state.store(both.withColumn("last_run", F.greatest("last_run", "_last")), batch_id)
            known.unpersist()
        finally:
            rows.unpersist()

    return judge


def _merge_moments(df: DataFrame) -> DataFrame:
    """Replace (n, mean, m2) by the moments of the union of (n, mean, m2) and (n2, mean2, m22)."""
    n1, n2 = F.coalesce("n", F.lit(0)), F.coalesce("n2", F.lit(0))
    a, b = or_zero("mean"), or_zero("mean2")
    both = F.nullif(n1 + n2, F.lit(0))
    step = b - a
    return df.select(
        *[c for c in df.columns if c not in ("n", "mean", "m2", "n2", "mean2", "m22")],
        (n1 + n2).cast("bigint").alias("n"),
        F.coalesce(a + step * n2 / both, F.lit(0.0)).alias("mean"),
        F.coalesce(or_zero("m2") + or_zero("m22") + step * step * n1 * n2 / both, F.lit(0.0)).alias("m2"),
    )


def change_log(path: str) -> Callable[[DataFrame, int], None]:
    """Batch function that stores the rows of a batch below `path`; run again, it overwrites its own rows."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return store


def current_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Newest row per id of a change log: rows of later batches replace those of earlier ones."""
    full = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    log = spark.read.schema(full).parquet(path)
    newest = F.max_by(F.struct(*schema.fieldNames()), "batch")
    return log.groupBy("id").agg(newest.alias("row")).select("row.*")


def late_rows(stream: DataFrame, path: str, late: str = LATE) -> Callable[[DataFrame, int], None]:
    """Batch function that sets aside the rows a watermark would drop, before any is dropped.

    A row is late if its event time lies more than `late` before the newest one of the batches before its own. Late rows are stored below
    `path`/late, the others below `path`/on_time, one folder per batch; the newest time so far is stored with each batch, so a batch
    that runs again is divided as it was.
    """
    columns = stream.columns

    def divide(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = f"{path}/newest"
        seen = spark.read.schema("newest timestamp, batch bigint").parquet(newest).filter(F.col("batch") < batch_id) if batch_id else None
        limit = seen.agg(F.max("newest")).first()[0] if seen is not None else None
        rows = batch.select(*columns).persist()
        try:
            edge = F.lit(limit).cast("timestamp") - F.expr(f"INTERVAL {late}")
            is_late = F.coalesce(F.col("event_time") < edge, F.lit(False))
            rows.filter(is_late).write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
            rows.filter(~is_late).write.mode("overwrite").parquet(f"{path}/on_time/batch={batch_id}")
            rows.agg(F.max("event_time").alias("newest")).write.mode("overwrite").parquet(f"{newest}/batch={batch_id}")
        finally:
            rows.unpersist()

    return divide


def start(writer: DataStreamWriter, checkpoint: str, once: bool = True):
    """Start a query; `once` handles what is there and stops."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
