"""Duration baselines, run history and aggregate reports over the run table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from runpulse.functions.measures import or_zero, share_pct
from runpulse.functions.text import signature
from runpulse.operators.percentiles import exact_percentiles
from runpulse.schemas import FINISHED

WINDOW_DAYS = 30
MIN_RUNS = 5
SIGMAS = 2.0


def moment(as_of: str) -> Column:
    """The instant a job judges from; always given, never the wall clock, so results repeat."""
    return F.lit(as_of).cast("timestamp_ntz")


def days_before(as_of: str, days: int) -> Column:
    return moment(as_of) - F.make_dt_interval(days=F.lit(days))


def is_state(name: str) -> Column:
    return F.col("state") == name


def finished_runs(runs: DataFrame, states: Sequence[str] = FINISHED, task_id: str | None = None) -> DataFrame:
    """Runs that ended, and where asked for only those of one task."""
    kept = runs.filter(F.col("state").isin(list(states)))
    return kept if task_id is None else kept.filter(F.col("task_id") == task_id)


def runs_in_window(
    runs: DataFrame, as_of: str, days: int = WINDOW_DAYS, until_as_of: bool = False
) -> DataFrame:
    """Runs later than `days` before `as_of`; the edge itself is outside.

    Runs dated after `as_of` count unless `until_as_of` is set. A table laid out by `run_date` is
    also filtered on that column, so whole day folders are skipped.
    """
    start = days_before(as_of, days)
    kept = runs.filter(F.col("execution_date") > start)
    if "run_date" in runs.columns:
        kept = kept.filter(F.col("run_date") >= start.cast("date"))
    return kept.filter(F.col("execution_date") <= moment(as_of)) if until_as_of else kept


def baseline_columns() -> list[Column]:
    mean, sigma = F.avg("duration_seconds"), F.stddev_samp("duration_seconds")
    return [
        F.count("*").alias("total_runs"),
        or_zero(mean).alias("avg_duration"),
        or_zero(sigma).alias("stddev_duration"),
        or_zero(mean + SIGMAS * sigma).alias("upper_threshold"),
        F.greatest(F.lit(0.0), mean - SIGMAS * sigma).alias("lower_threshold"),
        F.max("execution_date").alias("last_run"),
        F.count_if(is_state("failed")).alias("failure_count"),
        share_pct(is_state("success")).alias("success_rate_pct"),
    ]


def duration_baselines(
    runs: DataFrame,
    as_of: str,
    days: int = WINDOW_DAYS,
    min_runs: int = MIN_RUNS,
    states: Sequence[str] = FINISHED,
    task_id: str | None = None,
) -> DataFrame:
    """Mean, sample deviation and two-sigma bounds per pipeline with at least `min_runs` runs."""
    window = runs_in_window(finished_runs(runs, states, task_id), as_of, days)
    return window.groupBy("pipeline_id").agg(*baseline_columns()).filter(F.col("total_runs") >= min_runs)


def ordered_baselines(runs: DataFrame, as_of: str, **options) -> DataFrame:
    """The baselines in the order of their pipelines, sorted by ranges over all tasks."""
    return duration_baselines(runs, as_of, **options).orderBy("pipeline_id")


def newest_first() -> list[Column]:
    return [F.desc("execution_date"), F.desc("id")]


def recent_runs(runs: DataFrame, limit: int = 10, states: Sequence[str] | None = FINISHED) -> DataFrame:
    """The last `limit` runs of every pipeline, numbered from the newest (`recency` 1)."""
    kept = runs if states is None else finished_runs(runs, states)
    newest = Window.partitionBy("pipeline_id").orderBy(*newest_first())
    return kept.withColumn("recency", F.row_number().over(newest)).filter(F.col("recency") <= limit)


def latest_runs(runs: DataFrame) -> DataFrame:
    """The last finished run of every pipeline; a missing duration reads 0."""
    return recent_runs(runs, 1).select(
        "pipeline_id", "run_id", "execution_date", or_zero("duration_seconds").alias("duration_seconds"), "state"
    )


def recent_run_lists(runs: DataFrame, limit: int) -> DataFrame:
    """Per pipeline an array of its last `limit` finished runs, newest first."""
    item = F.struct(
        "recency", "run_id", "execution_date", or_zero("duration_seconds").alias("duration_seconds"), "state"
    )
    return (
        recent_runs(runs, limit)
        .groupBy("pipeline_id")
        .agg(F.sort_array(F.collect_list(item)).alias("recent_runs"))
    )


def run_history(runs: DataFrame, as_of: str, days: int = WINDOW_DAYS, last: int = 3) -> DataFrame:
    """Run count, mean, deviation and the last states of every pipeline, runs of any state included."""
    window = runs_in_window(runs, as_of, days)
    totals = window.groupBy("pipeline_id").agg(
        F.count("*").alias("total_runs"),
        F.round(or_zero(F.avg("duration_seconds")), 1).alias("avg_duration"),
        F.round(or_zero(F.stddev_samp("duration_seconds")), 1).alias("stddev_duration"),
    )
    # the state sits inside a struct, so a missing state keeps its place in the list
    states = (
        recent_runs(window, last, states=None)
        .groupBy("pipeline_id")
        .agg(F.sort_array(F.collect_list(F.struct("recency", "state"))).alias("_last"))
        .select("pipeline_id", F.col("_last.state").alias("recent_statuses"))
    )
    return totals.join(states, "pipeline_id")


def robust_baselines(runs: DataFrame, as_of: str, days: int = WINDOW_DAYS, min_runs: int = MIN_RUNS) -> DataFrame:
    """Median, 95th percentile and failure rate per pipeline."""
    window = runs_in_window(finished_runs(runs), as_of, days)
    rates = (
        window.groupBy("pipeline_id")
        .agg(F.count("*").alias("total_runs"), share_pct(is_state("failed")).alias("failure_rate_pct"))
        .filter(F.col("total_runs") >= min_runs)
    )
    marks = exact_percentiles(
        window, "pipeline_id", "duration_seconds", {"median_duration": 0.5, "p95_duration": 0.95}
    )
    return rates.join(marks, "pipeline_id")


def rca_distribution(diagnosed: DataFrame) -> DataFrame:
    """Diagnosed failures by severity and category, with their share and mean confidence."""
    counts = (
        diagnosed.filter(F.col("rca_root_cause").isNotNull())
        .groupBy("rca_severity", "rca_category")
        .agg(F.count("*").alias("failures"), F.avg("rca_confidence").alias("avg_confidence"))
    )
    return counts.withColumn("share", F.col("failures") / counts.agg(F.sum("failures")).scalar())


def top_failing(runs: DataFrame, limit: int = 20) -> DataFrame:
    """The pipeline tasks with most failures."""
    return (
        runs.groupBy("pipeline_id", "task_id")
        .agg(F.count_if(is_state("failed")).alias("failures"), F.count("*").alias("runs"))
        .filter(F.col("failures") > 0)
        .orderBy(F.desc("failures"), "pipeline_id", "task_id")
        .limit(limit)
    )


def rca_quality_trend(diagnosed: DataFrame) -> DataFrame:
    """Per day: diagnoses, mean and 95th percentile response time, mean confidence."""
    rows = diagnosed.filter(F.col("rca_generated_at").isNotNull()).withColumn(
        "day", F.date_trunc("day", F.col("rca_generated_at").cast("timestamp")).cast("timestamp_ntz")
    )
    daily = rows.groupBy("day").agg(
        F.count("*").alias("diagnoses"),
        F.avg("rca_response_time_seconds").alias("avg_response_seconds"),
        F.avg("rca_confidence").alias("avg_confidence"),
    )
    marks = exact_percentiles(rows, "day", "rca_response_time_seconds", {"p95_response_seconds": 0.95})
    return daily.join(marks, "day", "left")


def _day(ts: str = "execution_date") -> Column:
    return F.date_trunc("day", F.col(ts).cast("timestamp")).cast("timestamp_ntz")


def seven_day_trend(runs: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Runs, failures and mean duration per pipeline and day, days without runs included."""
    window = runs_in_window(runs, as_of, days, until_as_of=True)
    daily = window.groupBy("pipeline_id", _day().alias("day")).agg(
        F.count("*").alias("runs"),
        F.count_if(is_state("failed")).alias("failures"),
        F.avg("duration_seconds").alias("avg_duration"),
    )
    first = days_before(as_of, days)
    spine = daily.select("pipeline_id").distinct().select(
        "pipeline_id",
        F.explode(F.sequence(first, moment(as_of) - F.make_dt_interval(days=F.lit(1)), F.expr("interval 1 day"))).alias("day"),
    )
    return spine.join(daily, ["pipeline_id", "day"], "left").select(
        "pipeline_id", "day",
        F.coalesce("runs", F.lit(0)).cast("bigint").alias("runs"),
        F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures"),
        "avg_duration",
    )


def rollup_health(runs: DataFrame) -> DataFrame:
    """Runs, failures and success rate per pipeline, per team and overall (`level` 0, 1 and 3).

    The rows are first added up per pipeline; only those totals are expanded to the three levels.
    """
    totals = runs.groupBy("team", "pipeline_id").agg(
        F.count("*").alias("runs"),
        F.count_if(is_state("failed")).alias("failures"),
        F.count_if(is_state("success")).alias("successes"),
    )
    return totals.rollup("team", "pipeline_id").agg(
        F.grouping_id().alias("level"),
        F.sum("runs").alias("runs"),
        F.sum("failures").alias("failures"),
        (F.lit(100.0) * F.sum("successes") / F.sum("runs")).cast("double").alias("success_rate_pct"),
    )


def runtime_attribution(runs: DataFrame) -> DataFrame:
    """Total run time per pipeline and its share of all run time."""
    totals = runs.groupBy("team", "pipeline_id").agg(
        F.count("*").alias("runs"), F.sum("duration_seconds").alias("total_seconds")
    )
    whole = totals.agg(F.sum("total_seconds")).scalar()
    return totals.withColumn("share_pct", F.lit(100.0) * F.col("total_seconds") / F.nullif(whole, F.lit(0.0)))


def distinct_signatures(runs: DataFrame) -> DataFrame:
    """Failures and different failure signatures per pipeline."""
    return (
        runs.filter(is_state("failed"))
        .groupBy("pipeline_id")
        .agg(F.count("*").alias("failures"), F.count_distinct(signature("error_message")).alias("signatures"))
    )


def recent_rca_summary(diagnosed: DataFrame, limit: int = 50) -> DataFrame:
    """The newest diagnosed failures."""
    return (
        diagnosed.filter(is_state("failed") & F.col("rca_root_cause").isNotNull())
        .orderBy(F.desc_nulls_first("created_at"), F.desc("id"))
        .limit(limit)
        .select(
            "pipeline_id", "task_id", "execution_date", "rca_severity", "rca_category", "rca_root_cause",
            "rca_confidence", "rca_immediate_fix", "rca_model_used", "created_at",
        )
    )


def newly_failing(runs: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Pipelines that failed in the last `days` but not in the `days` before."""
    now, earlier = _failing_now_and_before(runs, as_of, days)
    return now.subtract(earlier)


def still_failing(runs: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Pipelines that failed in both spans."""
    now, earlier = _failing_now_and_before(runs, as_of, days)
    return now.intersect(earlier)


def _failing_now_and_before(runs: DataFrame, as_of: str, days: int) -> tuple[DataFrame, DataFrame]:
    failed = runs.filter(is_state("failed"))
    edge = days_before(as_of, days)
    now = runs_in_window(failed, as_of, days)
    earlier = runs_in_window(failed, as_of, 2 * days).filter(F.col("execution_date") <= edge)
    return now.select("pipeline_id"), earlier.select("pipeline_id")


def uncovered_pipelines(registry: DataFrame, runs: DataFrame) -> DataFrame:
    """Registered pipelines without a single recorded run."""
    return registry.join(runs.select("pipeline_id").distinct(), "pipeline_id", "left_anti")


def recorded_pipelines(registry: DataFrame, runs: DataFrame) -> DataFrame:
    """Registered pipelines with at least one recorded run."""
    return registry.join(runs.select("pipeline_id").distinct(), "pipeline_id", "left_semi")
