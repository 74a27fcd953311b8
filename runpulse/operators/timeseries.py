"""Time-series operators over labelled samples.

A grid of steps runs from `start` to `end`. Step t sees the samples in (t - span, t]. Samples are first
reduced to one row per series and step-wide pane; only panes are copied to the steps that see them, so the
copies do not grow with the number of samples.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from runpulse.operators.slices import add_slices, micros, previous_row


@dataclass(frozen=True)
class Grid:
    """Evaluation times: `start`, `start + step`, … up to `end` (timestamps as text, step in seconds)."""

    start: str
    end: str
    step: int

    @property
    def step_us(self) -> int:
        return self.step * 1_000_000

    def start_us(self) -> Column:
        return micros(F.lit(self.start).cast("timestamp_ntz"))

    def last_index(self) -> Column:
        return F.floor((micros(F.lit(self.end).cast("timestamp_ntz")) - self.start_us()) / F.lit(self.step_us))

    def pane(self, at: Column) -> Column:
        """Index of the first step that is not before `at`."""
        return F.ceil((at - self.start_us()) / F.lit(self.step_us)).cast("bigint")

    def time(self, index: Column) -> Column:
        return F.timestamp_micros(self.start_us() + index * self.step_us).cast("timestamp_ntz")

    def panes(self, span: int) -> int:
        if span % self.step:
            raise ValueError("the span must be a whole number of steps")
        return span // self.step

    def steps(self, spark: SparkSession) -> DataFrame:
        one = spark.range(1)
        return one.select(F.explode(F.sequence(F.lit(0).cast("bigint"), self.last_index().cast("bigint"))).alias("i")).select(
            self.time(F.col("i")).alias("step")
        )


def series(samples: DataFrame, metric: str, by: list[str], where: dict[str, str] | None = None) -> DataFrame:
    """Samples of one metric with the labels `by` as columns; `where` keeps series with equal labels."""
    kept = samples.filter((F.col("metric") == metric) & F.col("value").isNotNull())
    for name, wanted in (where or {}).items():
        kept = kept.filter(F.col("labels")[name] == wanted)
    return kept.select(micros("ts").alias("_at"), "ts", *[F.col("labels")[name].alias(name) for name in by], "value")


def _seen(points: DataFrame, grid: Grid, span: int) -> DataFrame:
    """Points some step can see, with their pane."""
    reach = grid.panes(span)
    pane = grid.pane(F.col("_at"))
    return points.withColumn("_pane", pane).filter(
        (F.col("_pane") > -reach) & (F.col("_pane") <= grid.last_index())
    )


def _to_steps(panes: DataFrame, grid: Grid, span: int) -> DataFrame:
    """Copy each pane to the steps that see it."""
    first = F.greatest(F.col("_pane"), F.lit(0))
    last = F.least(F.col("_pane") + grid.panes(span) - 1, grid.last_index())
    return panes.withColumn("_i", F.explode(F.sequence(first, last))).drop("_pane")


def instant_values(points: DataFrame, by: list[str], grid: Grid, lookback: int) -> DataFrame:
    """Last value of every series at every step, if it is not older than `lookback` seconds."""
    latest = F.max(F.struct("_at", "value")).alias("_last")
    panes = _seen(points, grid, lookback).groupBy(*by, "_pane").agg(latest)
    return (
        _to_steps(panes, grid, lookback)
        .groupBy(*by, "_i")
        .agg(F.max("_last").alias("_last"))
        .select(grid.time(F.col("_i")).alias("step"), *by, F.col("_last.value").alias("value"))
    )


def counter_rate(points: DataFrame, by: list[str], grid: Grid, window: int) -> DataFrame:
    """Increase per second of every counter over the window before each step.

    A value below the one before it is a reset and counts in full. The increase is divided by the time
    between the first and last sample in the window; it is not stretched to the window's edges. Steps
    with fewer than two samples in the window have no row.
    """
    inside = _seen(points, grid, window)
    linked = previous_row(add_slices(inside, by, "_at", "value"), by, "_at", "value", ["value"], "_prev")
    before = F.col("_prev.value")
    gained = F.when(F.col("value") < before, F.col("value")).otherwise(F.col("value") - before)
    panes = (
        linked.withColumn("_gained", F.coalesce(gained, F.lit(0.0)))
        .groupBy(*by, "_pane")
        .agg(
            F.count("*").alias("_n"),
            F.sum("_gained").alias("_gained"),
            F.min(F.struct("_at", "value", "_gained")).alias("_first"),
            F.max("_at").alias("_last_at"),
        )
    )
    n, first, last = F.sum("_n"), F.min("_first"), F.max("_last_at")
    seconds = (last - first["_at"]) / F.lit(1_000_000.0)
    return (
        _to_steps(panes, grid, window)
        .groupBy(*by, "_i")
        .agg(n.alias("_n"), ((F.sum("_gained") - first["_gained"]) / F.nullif(seconds, F.lit(0.0))).alias("rate"))
        .filter((F.col("_n") >= 2) & F.col("rate").isNotNull())
        .select(grid.time(F.col("_i")).alias("step"), *by, "rate")
    )


def cpu_utilization(samples: DataFrame, grid: Grid, window: int, metric: str = "node_cpu_seconds_total") -> DataFrame:
    """One minus the mean idle rate per node."""
    idle = series(samples, metric, ["node", "mode"], {"mode": "idle"})
    rates = counter_rate(idle, ["node", "mode"], grid, window)
    return rates.groupBy("step", "node").agg((1 - F.avg("rate")).alias("utilization"))


def gauge_difference(samples: DataFrame, left: str, right: str, by: list[str], grid: Grid, lookback: int) -> DataFrame:
    """`left - right` for series with equal labels at the same step."""
    a = instant_values(series(samples, left, by), by, grid, lookback).withColumnRenamed("value", "_a")
    b = instant_values(series(samples, right, by), by, grid, lookback).withColumnRenamed("value", "_b")
    return a.join(b, ["step", *by]).select("step", *by, (F.col("_a") - F.col("_b")).alias("value"))


def _or_zero_at_steps(found: DataFrame, grid: Grid, column: str) -> DataFrame:
    """All steps; 0 where `found` has none."""
    return grid.steps(found.sparkSession).join(found, "step", "left").select(
        "step", F.coalesce(F.col(column).cast("double"), F.lit(0.0)).alias(column)
    )


def success_ratio(samples: DataFrame, by: list[str], grid: Grid, lookback: int) -> DataFrame:
    """Successes over successes plus failures at each step; a small constant keeps the divisor above 0."""
    good = instant_values(series(samples, "run_success", by), by, grid, lookback)
    bad = instant_values(series(samples, "run_failed", by), by, grid, lookback)
    total = lambda df, name: df.groupBy("step").agg(F.sum("value").alias(name))
    s, f = F.col("s"), F.col("f")
    return total(good, "s").join(total(bad, "f"), "step").select("step", (s / (s + f + 0.001)).alias("ratio"))


def active_failures(samples: DataFrame, by: list[str], grid: Grid, lookback: int) -> DataFrame:
    """Sum of the failure gauge at each step, 0 without series."""
    found = instant_values(series(samples, "run_failed", by), by, grid, lookback)
    return _or_zero_at_steps(found.groupBy("step").agg(F.sum("value").alias("failures")), grid, "failures")


def avg_task_duration(samples: DataFrame, by: list[str], grid: Grid, lookback: int) -> DataFrame:
    """Mean of the duration gauge at each step, 0 without series."""
    found = instant_values(series(samples, "run_duration", by), by, grid, lookback)
    return _or_zero_at_steps(found.groupBy("step").agg(F.avg("value").alias("avg_duration")), grid, "avg_duration")


def matching_series_count(
    samples: DataFrame, metric: str, by: list[str], where: dict[str, str], grid: Grid, lookback: int
) -> DataFrame:
    """Number of series with the given labels at each step, 0 without any."""
    found = instant_values(series(samples, metric, by, where), by, grid, lookback)
    return _or_zero_at_steps(found.groupBy("step").agg(F.count("*").alias("series")), grid, "series")


def series_range(points: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """Raw samples in (start, end], in time order."""
    at = F.col("ts")
    inside = (at > F.lit(start).cast("timestamp_ntz")) & (at <= F.lit(end).cast("timestamp_ntz"))
    return points.filter(inside).select("ts", *by, "value").orderBy("ts", *by)


def last_values(points: DataFrame, by: list[str]) -> DataFrame:
    """Newest value of every series."""
    last = F.max(F.struct("ts", "value")).alias("_last")
    return points.groupBy(*by).agg(last).select(*by, "_last.ts", "_last.value")


def resampled_series(points: DataFrame, by: list[str], grid: Grid, staleness: int) -> DataFrame:
    """Every series at every step: its last value, or null once that is older than `staleness` seconds."""
    index = F.explode(F.sequence(F.lit(0).cast("bigint"), grid.last_index().cast("bigint")))
    spine = points.select(*by).distinct().select(*by, index.alias("_i")).select(*by, grid.time(F.col("_i")).alias("step"))
    return spine.join(instant_values(points, by, grid, staleness), [*by, "step"], "left").select("step", *by, "value")


def retained(samples: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Samples young enough to be kept."""
    return samples.filter(F.col("ts") > F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(days=F.lit(days)))


def tumbling_health(runs: DataFrame, minutes: int = 30) -> DataFrame:
    """Runs, failures and mean duration per pipeline and window."""
    window = F.window(F.col("execution_date").cast("timestamp"), f"{minutes} minutes")
    return (
        runs.groupBy("pipeline_id", window.alias("w"))
        .agg(
            F.count("*").alias("runs"),
            F.count_if(F.col("state") == "failed").alias("failures"),
            F.avg("duration_seconds").alias("avg_duration"),
        )
        .select("pipeline_id", F.col("w.start").cast("timestamp_ntz").alias("window_start"), "runs", "failures", "avg_duration")
    )


def sliding_stats(runs: DataFrame, days: int = 7) -> DataFrame:
    """Runs, failures and mean duration per pipeline over windows of `days` that start each day.

    Rows are added up per day first; only the daily totals are copied to the windows they belong to.
    """
    day = F.date_trunc("day", F.col("execution_date").cast("timestamp"))
    daily = runs.groupBy("pipeline_id", day.alias("day")).agg(
        F.count("*").alias("runs"),
        F.count_if(F.col("state") == "failed").alias("failures"),
        F.sum("duration_seconds").alias("seconds"),
        F.count("duration_seconds").alias("timed"),
    )
    starts = F.sequence(F.col("day") - F.make_dt_interval(days=F.lit(days - 1)), F.col("day"), F.expr("interval 1 day"))
    return (
        daily.withColumn("window_start", F.explode(starts))
        .groupBy("pipeline_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"))
        .agg(
            F.sum("runs").alias("runs"),
            F.sum("failures").alias("failures"),
            (F.sum("seconds") / F.nullif(F.sum("timed"), F.lit(0))).alias("avg_duration"),
        )
    )
