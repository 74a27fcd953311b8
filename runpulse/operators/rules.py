"""Detection rules. Each returns the pipeline, the run or day it judges, what was seen and expected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from runpulse.functions.measures import deviation_pct, or_zero
from runpulse.operators import baselines as base
from runpulse.operators.baselines import MIN_RUNS, SIGMAS, WINDOW_DAYS, is_state
from runpulse.operators.percentiles import exact_percentiles
from runpulse.operators.slices import DAY_US, add_slices, micros, previous_row, running_totals, trailing_moments
from runpulse.schemas import FINISHED
from runpulse.session import cut_lineage


def judged_runs(
    runs: DataFrame,
    as_of: str,
    days: int = WINDOW_DAYS,
    min_runs: int = MIN_RUNS,
    states: Sequence[str] = FINISHED,
    task_id: str | None = None,
) -> DataFrame:
    """Each pipeline's latest finished run beside its baseline, with the flag `is_anomaly`.

    A pipeline with a finished run in the window has its latest one there too, so older days are not read
    and one aggregation finds both. With other states or a single task the baseline covers other rows than
    the latest run does, and the two are joined.
    """
    if tuple(states) == FINISHED and task_id is None:
        latest = F.struct("run_id", "execution_date", "state", or_zero("duration_seconds").alias("current_duration"))
        judged = (
            base.runs_in_window(base.finished_runs(runs), as_of, days)
            .groupBy("pipeline_id")
            .agg(*base.baseline_columns(), F.max_by(latest, F.struct("execution_date", "id")).alias("_latest"))
            .filter(F.col("total_runs") >= min_runs)
            .select("*", "_latest.*")
            .drop("_latest")
        )
    else:
        latest = base.latest_runs(runs).withColumnRenamed("duration_seconds", "current_duration")
        judged = base.duration_baselines(runs, as_of, days, min_runs, states, task_id).join(latest, "pipeline_id")
    return judged.withColumn(
        "deviation_pct", F.round(deviation_pct("current_duration", "avg_duration"), 1)
    ).withColumn(
        "is_anomaly",
        (F.col("current_duration") > F.col("upper_threshold")) & (F.col("upper_threshold") > 0),
    )


def duration_anomalies(runs: DataFrame, as_of: str, **options) -> DataFrame:
    """Latest runs strictly above the two-sigma bound of a baseline they are part of."""
    return judged_runs(runs, as_of, **options).filter("is_anomaly").select(
        "pipeline_id", "current_duration", "avg_duration", "stddev_duration", "upper_threshold",
        "deviation_pct", "run_id", "execution_date", "total_runs", "success_rate_pct",
    )


def _hit(rule: str, observed: Column | str, expected: Column | str, deviation: Column | str) -> list:
    col = lambda c: F.col(c) if isinstance(c, str) else c
    return [
        "pipeline_id", "run_id", "execution_date",
        F.lit(rule).alias("rule"),
        col(observed).cast("double").alias("observed"),
        col(expected).cast("double").alias("expected"),
        col(deviation).cast("double").alias("deviation_pct"),
    ]


def baseline_rule_hits(judged: DataFrame, off_share: float = 0.2) -> DataFrame:
    """Hits of the three rules that compare a latest run with its baseline, from one pass over `judged`.

    slow_run: strictly above the upper bound. fast_run: below the lower bound. off_mean: more than
    `off_share` off the mean, to either side.
    """
    now, mean = F.col("current_duration"), F.col("avg_duration")

    def hit(rule: str, fired: Column, expected: str) -> Column:
        return F.when(
            fired,
            F.struct(F.lit(rule).alias("rule"), now.alias("observed"), F.col(expected).alias("expected"), "deviation_pct"),
        )

    fired = F.array(
        hit("slow_run", F.col("is_anomaly"), "upper_threshold"),
        hit("fast_run", now < F.col("lower_threshold"), "lower_threshold"),
        hit("off_mean", F.abs(now - mean) > off_share * mean, "avg_duration"),
    )
    return judged.select(
        "pipeline_id", "run_id", "execution_date", F.explode(F.array_compact(fired)).alias("hit")
    ).select("pipeline_id", "run_id", "execution_date", "hit.*")


def fast_run_anomalies(runs: DataFrame, as_of: str) -> DataFrame:
    """Latest runs below the lower bound."""
    return baseline_rule_hits(judged_runs(runs, as_of)).filter(F.col("rule") == "fast_run")


def drift_anomalies(runs: DataFrame, as_of: str, share: float = 0.2) -> DataFrame:
    """Latest runs more than `share` off the mean, to either side."""
    return baseline_rule_hits(judged_runs(runs, as_of), share).filter(F.col("rule") == "off_mean")


def median_ratio_anomalies(runs: DataFrame, as_of: str, ratio: float = 1.8) -> DataFrame:
    """Latest runs longer than `ratio` times the median."""
    latest = base.latest_runs(base.runs_in_window(runs, as_of))
    return (
        base.robust_baselines(runs, as_of)
        .join(latest, "pipeline_id")
        .filter(F.col("duration_seconds") > ratio * F.col("median_duration"))
        .select(
            *_hit(
                "above_median", "duration_seconds", ratio * F.col("median_duration"),
                F.round(deviation_pct("duration_seconds", "median_duration"), 1),
            )
        )
    )


def _timed(runs: DataFrame) -> DataFrame:
    return runs.withColumn("_at", micros("execution_date"))


def asof_baselines(
    runs: DataFrame, days: int | None = WINDOW_DAYS, min_runs: int = MIN_RUNS, like: DataFrame | None = None
) -> DataFrame:
    """Every finished run beside the baseline of the runs strictly before it (`days` None: all of them)."""
    done = _timed(base.finished_runs(runs)).select(
        "pipeline_id", "id", "run_id", "execution_date", "state", or_zero("duration_seconds").alias("current"),
        "duration_seconds", "_at",
    )
    span = None if days is None else days * DAY_US
    known = trailing_moments(done, ["pipeline_id"], "_at", "id", "duration_seconds", span, like=like)
    return known.filter(F.col("prior_rows") >= min_runs).select(
        "pipeline_id", "id", "run_id", "execution_date", "state",
        F.col("current").alias("current_duration"),
        "prior_rows", "prior_avg", "prior_stddev",
        (F.col("prior_avg") + SIGMAS * F.col("prior_stddev")).alias("prior_upper"),
    )


def rolling_anomalies(runs: DataFrame, days: int | None = WINDOW_DAYS, min_runs: int = MIN_RUNS) -> DataFrame:
    """All runs above the two-sigma bound of the runs before them; the judged run is not in its baseline."""
    known = asof_baselines(runs, days, min_runs)
    above = (F.col("current_duration") > F.col("prior_upper")) & (F.col("prior_upper") > 0)
    return known.filter(above).withColumn(
        "deviation_pct", F.round(deviation_pct("current_duration", "prior_avg"), 1)
    )


def anomalies_per_day(hits: DataFrame) -> DataFrame:
    """Hits and affected pipelines per day."""
    day = F.date_trunc("day", F.col("execution_date").cast("timestamp")).cast("timestamp_ntz")
    return hits.groupBy(day.alias("day")).agg(
        F.count("*").alias("anomalies"), F.count_distinct("pipeline_id").alias("pipelines")
    )


def low_success(runs: DataFrame, last: int = 10, floor_pct: float = 80.0) -> DataFrame:
    """Pipelines whose success rate over their last `last` finished runs is below the floor."""
    newest = F.col("recency") == 1
    return (
        base.recent_runs(runs, last)
        .groupBy("pipeline_id")
        .agg(
            F.max(F.when(newest, F.col("run_id"))).alias("run_id"),
            F.max("execution_date").alias("execution_date"),
            F.count("*").alias("runs"),
            (F.lit(100.0) * F.count_if(is_state("success")) / F.count("*")).cast("double").alias("success_pct"),
        )
        .filter((F.col("runs") >= last) & (F.col("success_pct") < floor_pct))
    )


def failure_streaks(runs: DataFrame, min_length: int = 3) -> DataFrame:
    """Unbroken series of failed runs of at least `min_length`.

    The failures of one series have the same number of non-failures before them, so that running count
    names the series.
    """
    done = add_slices(
        _timed(base.finished_runs(runs)).select("pipeline_id", "id", "execution_date", "state", "_at"),
        ["pipeline_id"], "_at", "id",
    )
    passed = F.when(is_state("failed"), 0).otherwise(1)
    return (
        running_totals(done, ["pipeline_id"], "_at", "id", {"passed": passed})
        .filter(is_state("failed"))
        .groupBy("pipeline_id", "passed")
        .agg(
            F.min("execution_date").alias("first_failure"),
            F.max("execution_date").alias("last_failure"),
            F.count("*").alias("length"),
        )
        .filter(F.col("length") >= min_length)
        .drop("passed")
    )


def _with_previous(runs: DataFrame, cols: list[str]) -> DataFrame:
    """Finished runs with struct `prev`: `cols` of the run before."""
    done = _timed(base.finished_runs(runs)).select("pipeline_id", "id", "run_id", "execution_date", "state", "duration_seconds", "_at")
    return previous_row(add_slices(done, ["pipeline_id"], "_at", "id"), ["pipeline_id"], "_at", "id", cols, "prev")


def flaky_pipelines(runs: DataFrame, min_runs: int = MIN_RUNS, flip_share: float = 0.3) -> DataFrame:
    """How often a pipeline changes between success and failure, and whether that is often."""
    flip = F.col("prev.state") != F.col("state")
    return (
        _with_previous(runs, ["state"])
        .groupBy("pipeline_id")
        .agg(F.count("*").alias("runs"), F.count_if(flip).alias("flips"))
        .filter(F.col("runs") >= min_runs)
        .withColumn("flip_rate", (F.col("flips") / F.col("runs")).cast("double"))
        .withColumn("is_flaky", F.col("flip_rate") >= flip_share)
    )


def run_over_run_change(runs: DataFrame) -> DataFrame:
    """Every finished run beside the duration of the run before it and the change in percent."""
    before = F.col("prev.duration_seconds")
    return _with_previous(runs, ["duration_seconds"]).select(
        "pipeline_id", "id", "run_id", "execution_date", "duration_seconds",
        before.alias("previous_duration"),
        F.round(deviation_pct(F.col("duration_seconds"), before), 1).alias("change_pct"),
    )


#: Growth of the daily mean, as percent of the mean, that counts as drift.
PCT_PER_DAY = 2.0


def duration_drift(runs: DataFrame, as_of: str, days: int = WINDOW_DAYS, pct_per_day: float = PCT_PER_DAY) -> DataFrame:
    """Slope of the daily mean duration per pipeline, as percent of the mean per day."""
    number = F.datediff(F.col("execution_date"), base.days_before(as_of, days))
    daily = (
        base.runs_in_window(base.finished_runs(runs), as_of, days)
        .groupBy("pipeline_id", number.alias("day"))
        .agg(F.avg("duration_seconds").alias("mean"))
    )
    return _drift(daily, pct_per_day)


def _drift(daily: DataFrame, pct_per_day: float = PCT_PER_DAY) -> DataFrame:
    slope, mean = F.regr_slope("mean", F.col("day").cast("double")), F.avg("mean")
    return (
        daily.groupBy("pipeline_id")
        .agg(F.count("*").alias("days"), mean.alias("mean_duration"), slope.alias("slope_per_day"))
        .filter(F.col("days") >= 3)
        .withColumn("slope_pct", 100 * F.col("slope_per_day") / F.greatest(F.col("mean_duration"), F.lit(1.0)))
        .withColumn("is_drifting", F.col("slope_pct") >= pct_per_day)
    )


def anomaly_rank(judged: DataFrame) -> DataFrame:
    """Rank of every judged pipeline by deviation, largest first.

    `judged` is read several times and must not change in between, so pass a stored table. The ranks are
    counted inside slices of the deviation; no task sorts all pipelines.
    """
    scored = judged.select(
        "pipeline_id", "deviation_pct", (-F.col("deviation_pct")).alias("_down")
    )
    tied = scored.groupBy("_down").agg(F.count("*").alias("_n"))
    places = running_totals(
        add_slices(tied, [], "_down"), [], "_down", "_down", {"_dense": F.lit(1), "_upto": F.col("_n")}
    )
    total = scored.agg(F.count("*")).scalar()
    return scored.join(places, "_down").select(
        "pipeline_id", "deviation_pct",
        F.col("_dense").cast("bigint").alias("place"),
        ((F.col("_upto") - F.col("_n")) / F.nullif(total - 1, F.lit(0))).cast("double").alias("percent_place"),
    )


def failure_spikes(runs: DataFrame, as_of: str, days: int = WINDOW_DAYS, span: int = 7) -> DataFrame:
    """Days with more failures than mean plus two sigma of the `span` days before, empty days counted as 0.

    Days without failures add nothing to the sums, so only days with failures are kept and the divisor is
    the length of the span.
    """
    number = F.datediff(F.col("execution_date"), base.days_before(as_of, days))
    daily = (
        base.runs_in_window(runs.filter(is_state("failed")), as_of, days)
        .groupBy("pipeline_id", number.alias("day"))
        .agg(F.count("*").alias("failures"))
    )
    return _spikes(daily, as_of, days, span)


def _spikes(daily: DataFrame, as_of: str, days: int, span: int) -> DataFrame:
    before = Window.partitionBy("pipeline_id").orderBy("day").rangeBetween(-span, -1)
    s1 = F.coalesce(F.sum("failures").over(before), F.lit(0))
    s2 = F.coalesce(F.sum(F.col("failures") * F.col("failures")).over(before), F.lit(0))
    variance = (F.lit(span) * s2 - s1 * s1) / F.lit(float(span * (span - 1)))
    return (
        daily.select(
            "pipeline_id", "day", "failures",
            (s1 / F.lit(float(span))).alias("expected"),
            (s1 / F.lit(float(span)) + SIGMAS * F.sqrt(variance)).alias("limit"),
        )
        .filter((F.col("day") >= span) & (F.col("failures") > F.col("limit")))
        .select(
            "pipeline_id",
            F.date_add(base.days_before(as_of, days).cast("date"), F.col("day")).cast("timestamp_ntz").alias("execution_date"),
            "failures", "expected", "limit",
        )
    )


def row_count_deviation(runs: DataFrame, prior: int = 10, share: float = 0.3, min_prior: int = 5) -> DataFrame:
    """Latest runs whose row count is more than `share` off the mean of the runs before."""
    newest, older = F.col("recency") == 1, F.col("recency") > 1
    counts = (
        base.recent_runs(runs, prior + 1)
        .groupBy("pipeline_id")
        .agg(
            F.max(F.when(newest, F.col("run_id"))).alias("run_id"),
            F.max(F.when(newest, F.col("execution_date"))).alias("execution_date"),
            F.max(F.when(newest, F.col("row_count"))).alias("rows"),
            F.avg(F.when(older, F.col("row_count"))).alias("mean_rows"),
            F.count_if(older).alias("earlier"),
        )
        .filter(F.col("earlier") >= min_prior)
    )
    return _off_row_count(counts, share)


def _off_row_count(counts: DataFrame, share: float) -> DataFrame:
    off = F.abs(F.col("rows") - F.col("mean_rows")) > share * F.col("mean_rows")
    pct = F.round(F.lit(100.0) * (F.col("rows") - F.col("mean_rows")) / F.nullif("mean_rows", F.lit(0.0)), 1)
    return counts.filter(off).select(*_hit("row_count", "rows", "mean_rows", pct))


def throughput_anomalies(runs: DataFrame, as_of: str, days: int = WINDOW_DAYS, min_runs: int = MIN_RUNS) -> DataFrame:
    """Latest runs whose rows per second lie outside two sigma, to either side."""
    rate = F.col("row_count") / F.nullif("duration_seconds", F.lit(0.0))
    rated = runs.withColumn("rate", rate).filter(F.col("rate").isNotNull())
    normal = (
        base.runs_in_window(base.finished_runs(rated), as_of, days)
        .groupBy("pipeline_id")
        .agg(F.count("*").alias("runs"), F.avg("rate").alias("mean"), F.stddev_samp("rate").alias("sigma"))
        .filter(F.col("runs") >= min_runs)
    )
    latest = base.recent_runs(base.runs_in_window(rated, as_of, days), 1).select(
        "pipeline_id", "run_id", "execution_date", "rate"
    )
    outside = F.abs(F.col("rate") - F.col("mean")) > SIGMAS * F.col("sigma")
    return normal.join(latest, "pipeline_id").filter(outside).select(
        *_hit("throughput", "rate", "mean", F.round(deviation_pct("rate", "mean"), 1))
    )


def sla_status(runs: DataFrame, limits: DataFrame, as_of: str, days: int = WINDOW_DAYS) -> DataFrame:
    """Breach, early warning or ok for the latest run of every pipeline with a limit.

    Breach: the run is longer than the limit. Warning: the mean plus one day of drift, or the 95th
    percentile, is above it.
    """
    # the newest run of all days, added up before the shuffle
    newest = F.struct("run_id", or_zero("duration_seconds").alias("current_duration"))
    latest = base.finished_runs(runs).groupBy("pipeline_id").agg(F.max_by(newest, F.struct("execution_date", "id")).alias("_latest"))
    latest = latest.select("pipeline_id", "_latest.*")
    marks = exact_percentiles(
        base.runs_in_window(base.finished_runs(runs), as_of, days), "pipeline_id", "duration_seconds", {"p95_duration": 0.95}
    )
    drift = duration_drift(runs, as_of, days).select(
        "pipeline_id", (F.col("mean_duration") + F.col("slope_per_day")).alias("next_mean")
    )
    limit = F.col("limit_seconds")
    soon = (F.coalesce("next_mean", F.lit(0.0)) > limit) | (F.coalesce("p95_duration", F.lit(0.0)) > limit)
    return (
        limits.join(latest, "pipeline_id")
        .join(marks, "pipeline_id", "left")
        .join(drift, "pipeline_id", "left")
        .withColumn("status", F.when(F.col("current_duration") > limit, "breach").when(soon, "warning").otherwise("ok"))
    )


def _window_facts(runs: DataFrame, as_of: str, days: int) -> DataFrame:
    """What the rules need of the window's finished runs, per pipeline (`day` null) and per pipeline and day, from one pass."""
    number = F.datediff(F.col("execution_date"), base.days_before(as_of, days))
    done = base.runs_in_window(base.finished_runs(runs), as_of, days).select(
        "id", "pipeline_id", "run_id", "execution_date", "state", "duration_seconds", number.alias("day"),
        (F.col("row_count") / F.nullif("duration_seconds", F.lit(0.0))).alias("rate"),
    )
    rated, at = F.col("rate").isNotNull(), F.struct("execution_date", "id")
    latest = F.struct("run_id", "execution_date", or_zero("duration_seconds").alias("current_duration"))
    return done.groupingSets([["pipeline_id"], ["pipeline_id", "day"]], "pipeline_id", "day").agg(
        *base.baseline_columns(),
        F.avg("duration_seconds").alias("mean"),
        F.max_by(latest, at).alias("latest"),
        F.count("rate").alias("rated"), F.avg("rate").alias("mean_rate"), F.stddev_samp("rate").alias("sigma_rate"),
        F.max_by(F.when(rated, F.struct("run_id", "execution_date", "rate")), F.when(rated, at)).alias("latest_rate"),
    )


def _recent_facts(runs: DataFrame, last: int = 10) -> DataFrame:
    """What the rules need of the last `last` + 1 finished runs of all days, per pipeline, from one pass."""
    newest, older, in_last = F.col("recency") == 1, F.col("recency") > 1, F.col("recency") <= last
    return (
        base.recent_runs(runs, last + 1)
        .groupBy("pipeline_id")
        .agg(
            F.max(F.when(newest, F.col("run_id"))).alias("run_id"),
            F.max("execution_date").alias("execution_date"),
            F.max(F.when(newest, or_zero("duration_seconds"))).alias("current_duration"),
            F.max(F.when(newest, F.col("row_count"))).alias("rows"),
            F.avg(F.when(older, F.col("row_count"))).alias("mean_rows"),
            F.count_if(older).alias("earlier"),
            F.count_if(in_last).alias("runs"),
            (F.lit(100.0) * F.count_if(in_last & is_state("success")) / F.count_if(in_last)).cast("double").alias("success_pct"),
        )
    )


def all_rule_hits(runs: DataFrame, as_of: str, limits: DataFrame | None = None, days: int = WINDOW_DAYS) -> DataFrame:
    """One row per pipeline and rule that fired; the limits' rules only where `limits` (`pipeline_id`, `limit_seconds`) are given.

    The runs are read once: the seven columns that rules look at are stored, without messages. Four passes over these serve all
    rules: the window by pipeline and day, the window's percentiles, the last runs of all days, and the streaks. What the
    first three find is stored as well, one row per pipeline (and day), and the rules are read from that.
    """
    slim = base.finished_runs(runs).select(
        "id", "pipeline_id", "run_id", "execution_date", "state", "duration_seconds", "row_count"
    )
    runs = cut_lineage(slim, "rule-runs")
    facts = cut_lineage(_window_facts(runs, as_of, days), "rule-window")
    recent = cut_lineage(_recent_facts(runs), "rule-recent")
    window = base.runs_in_window(base.finished_runs(runs), as_of, days)
    marks = exact_percentiles(window, "pipeline_id", "duration_seconds", {"median_duration": 0.5, "p95_duration": 0.95})
    marks = cut_lineage(marks, "rule-marks")
    whole = facts.filter("day IS NULL").filter(F.col("total_runs") >= MIN_RUNS)
    judged = whole.select("*", "latest.*").withColumn("deviation_pct", F.round(deviation_pct("current_duration", "avg_duration"), 1))
    judged = judged.withColumn("is_anomaly", (F.col("current_duration") > F.col("upper_threshold")) & (F.col("upper_threshold") > 0))
    drift = _drift(facts.filter("day IS NOT NULL").select("pipeline_id", "day", "mean"))
    hits = baseline_rule_hits(judged)
    for part in (
        _above_median(judged, marks),
        _off_rate(facts.filter("day IS NULL")),
        _off_row_count(recent.filter("earlier >= 5"), 0.3),
        recent.filter("runs >= 10 AND success_pct < 80").select(*_hit("low_success", "success_pct", F.lit(80.0), F.col("success_pct") - 80.0)),
        _last_spike(_spikes(facts.filter("day IS NOT NULL AND failure_count > 0").select("pipeline_id", "day", F.col("failure_count").alias("failures")), as_of, days, 7)),
        _longest_streak(failure_streaks(runs)),
        _drifting(drift, facts.filter("day IS NULL")),
    ):
        hits = hits.unionByName(part)
    return hits if limits is None else hits.unionByName(_over_limit(limits, recent, marks, drift))


def _above_median(judged: DataFrame, marks: DataFrame, ratio: float = 1.8) -> DataFrame:
    expected = ratio * F.col("median_duration")
    now = F.col("current_duration")
    return judged.join(marks, "pipeline_id").filter(now > expected).select(
        *_hit("above_median", "current_duration", expected, F.round(deviation_pct("current_duration", "median_duration"), 1))
    )


def _off_rate(facts: DataFrame) -> DataFrame:
    rated = facts.filter(F.col("rated") >= MIN_RUNS).select("pipeline_id", "latest_rate.*", "mean_rate", "sigma_rate")
    return rated.filter(F.abs(F.col("rate") - F.col("mean_rate")) > SIGMAS * F.col("sigma_rate")).select(
        *_hit("throughput", "rate", "mean_rate", F.round(deviation_pct("rate", "mean_rate"), 1))
    )


def _last_spike(spikes: DataFrame) -> DataFrame:
    last = spikes.groupBy("pipeline_id").agg(F.max(F.struct("execution_date", "failures", "limit")).alias("day"))
    return last.select("pipeline_id", F.lit(None).cast("string").alias("run_id"), "day.*").select(
        *_hit("failure_spike", "failures", "limit", F.lit(None))
    )


def _longest_streak(streaks: DataFrame) -> DataFrame:
    longest = streaks.groupBy("pipeline_id").agg(F.max("last_failure").alias("execution_date"), F.max("length").alias("longest"))
    return longest.withColumn("run_id", F.lit(None).cast("string")).select(*_hit("failure_streak", "longest", F.lit(3.0), F.lit(None)))


def _drifting(drift: DataFrame, facts: DataFrame) -> DataFrame:
    dated = drift.filter("is_drifting").join(facts.select("pipeline_id", F.col("last_run").alias("execution_date")), "pipeline_id")
    return dated.withColumn("run_id", F.lit(None).cast("string")).select(*_hit("drift", "slope_pct", F.lit(PCT_PER_DAY), F.lit(None)))


def _over_limit(limits: DataFrame, recent: DataFrame, marks: DataFrame, drift: DataFrame) -> DataFrame:
    """`sla_breach`: the latest run is over its limit. `sla_warning`: else, tomorrow's mean or the 95th percentile is."""
    next_mean = drift.select("pipeline_id", (F.col("mean_duration") + F.col("slope_per_day")).alias("next_mean"))
    known = limits.join(recent, "pipeline_id").join(marks, "pipeline_id", "left").join(next_mean, "pipeline_id", "left")
    soon = F.greatest(F.coalesce("next_mean", F.lit(0.0)), F.coalesce("p95_duration", F.lit(0.0)))
    breach = F.col("current_duration") > F.col("limit_seconds")
    seen = known.withColumn("seen", F.when(breach, F.col("current_duration")).otherwise(soon)).withColumn("breach", breach)
    pct = F.round(deviation_pct("seen", "limit_seconds"), 1)
    over = seen.filter(F.col("seen") > F.col("limit_seconds")).select("breach", *_hit("", "seen", "limit_seconds", pct))
    return over.withColumn("rule", F.when(F.col("breach"), "sla_breach").otherwise("sla_warning")).drop("breach")
