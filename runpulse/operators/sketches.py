"""Daily summaries that merge: quantile sketches of durations and distinct sketches of failure signatures.

Runs are summed up once per pipeline and day. Any window of whole days, and any group of pipelines, is then put together
from the days' sketches, whose size is bounded, without reading runs again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from runpulse.functions.text import signature
from runpulse.operators.baselines import MIN_RUNS, WINDOW_DAYS, _day, finished_runs, is_state

#: Size of a quantile sketch: ranks are off by less than RANK_ERROR with a probability of 99 %.
QUANTILE_SIZE, RANK_ERROR = 400, 0.0075
#: Log2 of a distinct sketch's registers: a relative standard error of 0.8 %; small counts are exact.
DISTINCT_BITS = 14


def daily_sketches(runs: DataFrame) -> DataFrame:
    """Per pipeline and `day`: finished `runs`, `failures`, and the sketches `durations` and `signatures`.

    Null durations and messages are in no sketch. Sketches are filled before the shuffle, so a pipeline with very many
    runs sends one row per task and day.
    """
    failed = is_state("failed")
    return (
        finished_runs(runs)
        .groupBy("pipeline_id", _day().alias("day"))
        .agg(
            F.count("*").alias("runs"),
            F.count_if(failed).alias("failures"),
            F.kll_sketch_agg_double("duration_seconds", QUANTILE_SIZE).alias("durations"),
            F.hll_sketch_agg(F.when(failed, signature("error_message")), DISTINCT_BITS).alias("signatures"),
        )
    )


def _quantile(sketch: str, rank: float) -> Column:
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(rank)))


def sketched_baselines(daily: DataFrame, as_of: str, days: int = WINDOW_DAYS, min_runs: int = MIN_RUNS) -> DataFrame:
    """Median, 95th percentile and failure rate per pipeline over the `days` whole days before the day of `as_of`.

    The percentiles are durations of the window whose rank is off by RANK_ERROR at most (see there), null without any
    duration; counts and rates are exact.
    """
    end = F.date_trunc("day", F.lit(as_of).cast("timestamp_ntz")).cast("timestamp_ntz")
    window = daily.filter((F.col("day") >= end - F.make_dt_interval(days=F.lit(days))) & (F.col("day") < end))
    merged = window.groupBy("pipeline_id").agg(
        F.sum("runs").alias("total_runs"),
        F.sum("failures").alias("failures"),
        F.kll_merge_agg_double("durations", QUANTILE_SIZE).alias("durations"),
    )
    return merged.filter(F.col("total_runs") >= min_runs).select(
        "pipeline_id",
        "total_runs",
        (F.lit(100.0) * F.col("failures") / F.col("total_runs")).alias("failure_rate_pct"),
        _quantile("durations", 0.5).alias("median_duration"),
        _quantile("durations", 0.95).alias("p95_duration"),
    )


def sketched_signatures(daily: DataFrame) -> DataFrame:
    """Failures and the estimated number of different failure signatures per pipeline with failures."""
    return (
        daily.filter(F.col("failures") > 0)
        .groupBy("pipeline_id")
        .agg(
            F.sum("failures").alias("failures"),
            F.hll_sketch_estimate(F.hll_union_agg("signatures")).alias("signatures"),
        )
    )
