"""Registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from runpulse import schemas
from runpulse.functions.measures import grade, seconds_between
from runpulse.functions.text import safe_id
from runpulse.operators import (
    alerts, baselines, diagnosis, differences, incident_index, lineage, quality, rule_table, rules, sketches, text,
)
from runpulse.operators import timeseries as ts
from runpulse.plans.anomaly_check import anomaly_check, explained_anomalies as with_explanations, explanations
from runpulse.plans.failure_diagnosis import diagnose_failures, diagnosed_runs
from runpulse.session import apply_settings, cut_lineage, fresh_dir
from runpulse.sources import derived, run_store, sinks, tables
from runpulse.sources.derived import AS_OF, COUNTER, TIES_AS_OF
from runpulse.streaming import jobs
from runpulse.streaming.upserts import Upserts

Query = Callable[[SparkSession, str], DataFrame]

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]
GRID = ts.Grid("2024-01-01 00:00:00", "2024-01-31 00:00:00", 3600)
SPAN = 6 * 3600
HALF = "2024-01-16 00:00:00"


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to four places, so that the order of a sum does not show."""
    def tidy(field: T.StructField) -> Column:
        return F.round(field.name, 4).alias(field.name) if isinstance(field.dataType, T.DoubleType) else F.col(field.name)

    return df.select(*[tidy(f) for f in df.schema.fields])


def _events(spark, d):
    return derived.source_table(spark, d, "events")


def _runs(spark, d):
    return derived.runs_from_events(_events(spark, d))


def _ties(spark, d):
    return derived.runs_from_orders(derived.source_table(spark, d, "orders"))


def _responses(spark, d):
    return derived.responses_from_runs(_runs(spark, d))


def _parsed(spark, d):
    return diagnosis.parsed_diagnoses(_responses(spark, d))


def _diagnosed(spark, d):
    return diagnosed_runs(_runs(spark, d), _responses(spark, d))


def _gauges(spark, d):
    return derived.samples_from_events(_events(spark, d), with_counter=False)


def _samples(spark, d):
    return derived.samples_from_events(_events(spark, d))


def _registry(spark, d):
    """Known pipelines: one per customer."""
    customers = derived.source_table(spark, d, "customer")
    return customers.select(F.concat(F.lit("dag_"), F.col("c_custkey").cast("string")).alias("pipeline_id"))


def _failing_now(spark, d):
    return baselines.latest_runs(_runs(spark, d)).filter(F.col("state") == "failed")


def _labels_as_columns(samples):
    return samples.select(
        "ts", "metric", *[F.col("labels")[n].alias(n) for n in ("node", "mode", "pipeline", "namespace")], "value"
    )


# --- sources, filters -------------------------------------------------------------------------------


def scan_runs(spark, d):
    return _runs(spark, d).select(
        "id", "pipeline_id", "task_id", "run_id", "execution_date", "end_date", "duration_seconds", "state", "error_type"
    )


def append_runs(spark, d):
    path = fresh_dir(spark, "runs")
    new = _runs(spark, d).select(*schemas.RUN_FACTS.fieldNames())
    sinks.append_runs(new, path)
    back = spark.read.schema(T.StructType([*schemas.RUN_FACTS.fields, T.StructField("run_date", T.DateType())])).parquet(path)
    return back.select(
        "id", "pipeline_id", F.date_format("run_date", "yyyy-MM-dd").alias("run_date"), "state", "duration_seconds",
        F.length("error_message").cast("bigint").alias("message_length"),
    )


def merge_diagnoses(spark, d):
    return _diagnosed(spark, d).select(
        "id", "state", "rca_root_cause", "rca_category", "rca_confidence", "rca_immediate_fix", "rca_prevention",
        "rca_severity", "rca_retry_recommended", "rca_estimated_fix_minutes", "rca_generated_at", "rca_model_used",
    )


def stored_diagnoses(spark, d):
    """Each write runs twice under its name, and once more under another; the table stays the same."""
    path, runs = fresh_dir(spark, "store"), _runs(spark, d)
    filled = diagnosis.with_fallback(_parsed(spark, d))
    found = diagnosis.as_diagnosis_columns(filled)
    for write in ("one", "one", "two"):
        run_store.append_once(runs, path, f"runs-{write}")
        run_store.store_diagnoses(found, path, f"diagnoses-{write}")
    return run_store.read_store(spark, path).select(
        "id", F.date_format("run_date", "yyyy-MM-dd").alias("run_date"), "state", "rca_root_cause", "rca_category", "rca_confidence",
        "rca_immediate_fix", "rca_prevention", "rca_severity", "rca_retry_recommended", "rca_estimated_fix_minutes", "rca_generated_at",
        "rca_model_used",
    )


def _run_folder(spark, d, parts: int) -> str:
    """The runs in files that arrive in the order of time, the given number of them."""
    path = fresh_dir(spark, "arrivals")
    runs = _runs(spark, d).select(*schemas.RUN_FACTS.fieldNames())
    day = F.datediff("execution_date", F.lit("2024-01-01"))
    span = 30 // parts
    for i in range(parts):
        low = F.lit(True) if i == 0 else day >= span * i
        high = F.lit(True) if i == parts - 1 else day < span * (i + 1)
        runs.filter(low & high).coalesce(1).write.mode("append").parquet(path)  # one file, one batch
    return path


def current_rows_stream(spark, d):
    """Runs arrive, every third is changed later; the log of segments keeps the newest row of each."""
    path, target = _run_folder(spark, d, 6), fresh_dir(spark, "upserts")
    changed = _runs(spark, d).select(*schemas.RUN_FACTS.fieldNames()).filter("id % 3 = 0").withColumn("state", F.lit("reviewed"))
    for k in range(3):
        changed.filter(F.col("id") % 9 == 3 * k).coalesce(1).write.mode("append").parquet(path)
    store = Upserts(target, schemas.RUN_FACTS, ["id"], ["execution_date"], fan=4)
    source = jobs.read_run_stream(spark, path, files_per_trigger=1)
    jobs.start(source.writeStream.foreachBatch(store.store), fresh_dir(spark, "progress")).awaitTermination()
    return store.current(spark).select("id", "pipeline_id", "execution_date", "state", "duration_seconds")


def running_anomalies_stream(spark, d):
    """Each run judged as it arrives, against all runs of its pipeline before it."""
    target = fresh_dir(spark, "detector")
    source = jobs.read_run_stream(spark, _run_folder(spark, d, 5), files_per_trigger=1)
    judge = jobs.running_detector(target)
    jobs.start(source.writeStream.foreachBatch(judge), fresh_dir(spark, "progress")).awaitTermination()
    return spark.read.parquet(f"{target}/hits").select("pipeline_id", "id", "run_id", "duration_seconds", "prior_rows", "mean", "upper")


def late_rows_stream(spark, d):
    """The runs of the first days arrive once more after all others; they are set aside and counted per day."""
    path, target = _run_folder(spark, d, 3), fresh_dir(spark, "late")
    again = _runs(spark, d).select(*schemas.RUN_FACTS.fieldNames()).filter(F.datediff("execution_date", F.lit("2024-01-01")) < 4)
    again.coalesce(1).write.mode("append").parquet(path)
    source = jobs.read_run_stream(spark, path, files_per_trigger=1)
    jobs.start(source.writeStream.foreachBatch(jobs.late_rows(source, target)), fresh_dir(spark, "progress")).awaitTermination()
    late = spark.read.parquet(f"{target}/late")
    return late.groupBy(F.date_format("execution_date", "yyyy-MM-dd").alias("day")).agg(
        F.count("*").alias("runs"), F.count_if(F.col("state") == "failed").alias("failures")
    )


def ordered_baselines(spark, d):
    return baselines.ordered_baselines(_runs(spark, d), AS_OF)


def explained_anomalies(spark, d):
    anomalies = anomaly_check(_runs(spark, d), AS_OF)["anomalies"]
    prompts = diagnosis.anomaly_prompts(anomalies, _runs(spark, d))
    given = explanations(prompts, derived.sample_explainer)
    both = with_explanations(anomalies, given)
    return both.select(
        "pipeline_id", "anomaly.run_id", "anomaly.current_duration", "explanation.likely_cause", "explanation.severity",
        "explanation.escalate_to_oncall",
    )


def scan_samples(spark, d):
    return _labels_as_columns(_samples(spark, d))


def retained_samples(spark, d):
    return _labels_as_columns(ts.retained(_gauges(spark, d), AS_OF))


def copy_differences(spark, d):
    """Orders against a copy that lacks some, has other prices for some, and some of its own."""
    orders = derived.source_table(spark, d, "orders")
    key = F.col("o_orderkey")
    price = F.when(key % 991 == 2, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    kept = orders.filter(key % 997 != 1).withColumn("o_totalprice", price)
    copy = kept.unionByName(orders.filter(key % 983 == 3).withColumn("o_orderkey", -key))
    return differences.copy_differences(orders, copy, ["o_orderkey"])


def copy_tables_report(spark, d):
    return quality.copy_tables(spark, d, fresh_dir(spark, "copy"), TABLES)


def finished_runs(spark, d):
    return baselines.finished_runs(_runs(spark, d)).select("id", "pipeline_id", "state", "duration_seconds")


def runs_in_window(spark, d):
    return baselines.runs_in_window(_runs(spark, d), AS_OF, 10).select("id", "pipeline_id", "execution_date", "state")


def sanitized_run_ids(spark, d):
    raw = F.concat(F.lit("Manual__"), F.date_format("execution_date", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00_"), F.col("run_id"))
    return _runs(spark, d).select("id", safe_id(raw).alias("safe_run_id"))


def run_durations(spark, d):
    return _runs(spark, d).select(
        "id", seconds_between("start_date", "end_date").alias("seconds"),
        F.date_format("start_date", "yyyy-MM-dd HH:mm 'UTC'").alias("started"),
    )


# --- joins ------------------------------------------------------------------------------------------


def recorded_pipelines(spark, d):
    return baselines.recorded_pipelines(_registry(spark, d), _runs(spark, d))


def uncovered_pipelines(spark, d):
    return baselines.uncovered_pipelines(_registry(spark, d), _runs(spark, d))


def failures_with_history(spark, d):
    return diagnosis.failures_with_history(_runs(spark, d)).select(
        "id", "pipeline_id", "total_runs", "avg_duration", diagnosis.list_text("recent_statuses").alias("recent_statuses")
    )


def failures_with_history_ties(spark, d):
    return diagnosis.failures_with_history(_ties(spark, d), days=365).select(
        "id", "pipeline_id", "total_runs", "avg_duration", diagnosis.list_text("recent_statuses").alias("recent_statuses")
    )


def unsent_alerts(spark, d):
    sent = derived.sent_log_from_runs(_runs(spark, d))
    return alerts.unsent_alerts(alerts.failure_alerts(_diagnosed(spark, d)), sent).select("alert_id", "subject")


def asof_baseline(spark, d):
    return rules.asof_baselines(_runs(spark, d)).drop("state", "execution_date", "run_id")


def asof_baseline_ties(spark, d):
    return rules.asof_baselines(_ties(spark, d), days=365, min_runs=2).drop("state", "execution_date", "run_id")


def asof_baseline_outliers(spark, d):
    """One run in fifty lasts a billion seconds: the windows that it has left must show no trace of it.

    Deviations of windows that hold one are too large to be equal to four places in two engines.
    """
    odd = (F.col("id") % 50 == 0) & F.col("duration_seconds").isNotNull()
    runs = _runs(spark, d).withColumn("duration_seconds", F.when(odd, 1e9).otherwise(F.col("duration_seconds")))
    found = rules.asof_baselines(runs, days=3, min_runs=2).filter("prior_avg < 1e6")
    return found.drop("state", "execution_date", "run_id")


def upstream_impact(spark, d):
    return lineage.upstream_impact(_failing_now(spark, d), derived.edges_from_events(_events(spark, d)))


def downstream_impact(spark, d):
    return lineage.downstream_impact(_failing_now(spark, d), derived.edges_from_events(_events(spark, d)))


# --- aggregations -----------------------------------------------------------------------------------


def duration_baselines(spark, d):
    return baselines.duration_baselines(_runs(spark, d), AS_OF)


def duration_baselines_success_only(spark, d):
    return baselines.duration_baselines(_runs(spark, d), AS_OF, days=2, min_runs=3, states=("success",), task_id="task_1")


def run_history(spark, d):
    return baselines.run_history(_runs(spark, d), AS_OF).withColumn(
        "recent_statuses", diagnosis.list_text("recent_statuses")
    )


def robust_baselines(spark, d):
    return baselines.robust_baselines(_runs(spark, d), AS_OF)


def rca_distribution(spark, d):
    return baselines.rca_distribution(_diagnosed(spark, d))


def top_failing(spark, d):
    return baselines.top_failing(_runs(spark, d))


def anomalies_per_day(spark, d):
    return rules.anomalies_per_day(rules.rolling_anomalies(_runs(spark, d)))


def rca_quality_trend(spark, d):
    stored = cut_lineage(
        _diagnosed(spark, d).select("rca_generated_at", "rca_response_time_seconds", "rca_confidence"), "diagnosed"
    )
    return baselines.rca_quality_trend(stored)


def seven_day_trend(spark, d):
    return baselines.seven_day_trend(_runs(spark, d), AS_OF)


def rollup_health(spark, d):
    return baselines.rollup_health(_runs(spark, d))


def runtime_attribution(spark, d):
    return baselines.runtime_attribution(_runs(spark, d))


def _daily(spark, d):
    return cut_lineage(sketches.daily_sketches(_runs(spark, d)), "daily-sketches")


def sketched_baselines(spark, d):
    return sketches.sketched_baselines(_daily(spark, d), AS_OF)


def sketched_signatures(spark, d):
    return sketches.sketched_signatures(_daily(spark, d))


def distinct_signatures(spark, d):
    return baselines.distinct_signatures(_runs(spark, d))


# --- ordered and ranked -----------------------------------------------------------------------------


def latest_runs(spark, d):
    return baselines.latest_runs(_runs(spark, d))


def latest_runs_ties(spark, d):
    return baselines.latest_runs(_ties(spark, d))


def recent_runs(spark, d):
    return baselines.recent_runs(_runs(spark, d), 10).select(
        "pipeline_id", F.col("recency").cast("bigint").alias("recency"), "run_id", "execution_date", "duration_seconds", "state"
    )


def low_success_last10(spark, d):
    return rules.low_success(_runs(spark, d))


def failure_streaks(spark, d):
    return rules.failure_streaks(_runs(spark, d))


def failure_streaks_ties(spark, d):
    return rules.failure_streaks(_ties(spark, d), min_length=2)


def flaky_pipelines(spark, d):
    return rules.flaky_pipelines(_runs(spark, d))


def run_over_run_change(spark, d):
    return rules.run_over_run_change(_runs(spark, d)).drop("run_id")


def run_over_run_change_ties(spark, d):
    return rules.run_over_run_change(_ties(spark, d)).drop("run_id")


def duration_drift(spark, d):
    return rules.duration_drift(_runs(spark, d), AS_OF)


def anomaly_rank(spark, d):
    judged = rules.judged_runs(_runs(spark, d), AS_OF).select("pipeline_id", "deviation_pct")
    return rules.anomaly_rank(cut_lineage(judged, "judged"))


def recent_rca_summary(spark, d):
    return baselines.recent_rca_summary(_diagnosed(spark, d))


def last_diagnoses(spark, d):
    return baselines.recent_rca_summary(_diagnosed(spark, d), 5)


def log_tail(spark, d):
    return text.log_tail(tables.document_lines(derived.source_table(spark, d, "documents")))


# --- rules ------------------------------------------------------------------------------------------


def duration_anomalies(spark, d):
    return rules.duration_anomalies(_runs(spark, d), AS_OF)


def duration_anomalies_ties(spark, d):
    return rules.duration_anomalies(_ties(spark, d), TIES_AS_OF, days=3650)


def judged_runs(spark, d):
    return rules.judged_runs(_runs(spark, d), AS_OF)


def rolling_anomalies(spark, d):
    return rules.rolling_anomalies(_runs(spark, d)).drop("state")


def fast_run_anomalies(spark, d):
    return rules.fast_run_anomalies(_runs(spark, d), AS_OF)


def fast_run_anomalies_ties(spark, d):
    return rules.baseline_rule_hits(rules.judged_runs(_ties(spark, d), TIES_AS_OF, days=3650)).filter(
        F.col("rule") == "fast_run"
    )


def drift_anomalies(spark, d):
    return rules.drift_anomalies(_runs(spark, d), AS_OF)


def median_ratio_anomalies(spark, d):
    return rules.median_ratio_anomalies(_runs(spark, d), AS_OF)


def failure_spikes(spark, d):
    return rules.failure_spikes(_runs(spark, d), AS_OF)


def row_count_deviation(spark, d):
    return rules.row_count_deviation(_runs(spark, d))


def throughput_anomalies(spark, d):
    return rules.throughput_anomalies(_runs(spark, d), AS_OF)


def sla_status(spark, d):
    runs = _runs(spark, d)
    return rules.sla_status(runs, derived.sla_limits(runs), AS_OF)


def health_grade(spark, d):
    ratios = ts.success_ratio(_gauges(spark, d), ["pipeline"], GRID, SPAN)
    return ratios.select("step", "ratio", grade("ratio").alias("grade"), grade("ratio", invert=True).alias("health"))


def all_rule_hits(spark, d):
    runs = _runs(spark, d)
    return rules.all_rule_hits(runs, AS_OF, derived.sla_limits(runs))


# --- sets -------------------------------------------------------------------------------------------


def newly_failing(spark, d):
    return baselines.newly_failing(_runs(spark, d), AS_OF, 1)


def still_failing(spark, d):
    return baselines.still_failing(_runs(spark, d), AS_OF, 1)


def _feed(spark, d):
    checked = anomaly_check(_runs(spark, d), AS_OF)
    return alerts.alert_feed(alerts.failure_alerts(_diagnosed(spark, d)), checked["alerts"])


def alert_feed(spark, d):
    return _feed(spark, d)


def alert_routes(spark, d):
    return alerts.alert_routes(_feed(spark, d)).select("kind", "alert_id", "pipeline_id", "severity", "route")


# --- diagnosis --------------------------------------------------------------------------------------


def rca_prompts(spark, d):
    return diagnosis.diagnosis_prompts(diagnosis.failures_with_history(_runs(spark, d))).select("id", "prompt", "prompt_length")


def anomaly_prompts(spark, d):
    return anomaly_check(_runs(spark, d), AS_OF)["prompts"].select("pipeline_id", "prompt")


def parsed_diagnoses(spark, d):
    return _parsed(spark, d).drop("model", "response_seconds", "generated_at")


def diagnosis_violations(spark, d):
    return diagnosis.diagnosis_violations(_parsed(spark, d)).select(
        "id", "status", F.size("violations").cast("bigint").alias("n_violations"), F.array_join("violations", ", ").alias("violations")
    )


def diagnoses_with_fallback(spark, d):
    return diagnosis.with_fallback(_parsed(spark, d)).select(
        "id", "status", "root_cause", "root_cause_category", "confidence", "severity", "retry_recommended", "estimated_fix_time_minutes"
    )


def diagnosed_failures(spark, d):
    runs = _runs(spark, d)
    return diagnose_failures(runs, AS_OF).select(
        "id", "rca_root_cause", "rca_category", "rca_confidence", "rca_severity", "rca_retry_recommended", "rca_generated_at"
    )


def failure_alerts(spark, d):
    return alerts.failure_alerts(_diagnosed(spark, d))


def anomaly_alerts(spark, d):
    return anomaly_check(_runs(spark, d), AS_OF)["alerts"]


def classified_errors(spark, d):
    return diagnosis.classified_errors(_runs(spark, d))


def classified_by_table(spark, d):
    return rule_table.classified_by_table(_runs(spark, d), rule_table.rule_rows(spark))


def similar_incidents(spark, d):
    return diagnosis.similar_incidents(_runs(spark, d))


def similar_incidents_lsh(spark, d):
    """Failures of the second half of the month, looked up in an index of the failures before."""
    runs, path = _runs(spark, d), fresh_dir(spark, "incident-index")
    half = F.lit(HALF).cast("timestamp_ntz")
    incident_index.build_index(runs.filter(F.col("execution_date") < half), path)
    return incident_index.look_up(runs.filter(F.col("execution_date") >= half), path)


def near_incidents(spark, d):
    return diagnosis.near_incidents(_runs(spark, d))


def grouped_alerts(spark, d):
    runs = _runs(spark, d)
    events = cut_lineage(alerts.alert_events(runs, rules.rolling_anomalies(runs)), "alert-events")
    return alerts.grouped_alerts(events)


def recommended_actions(spark, d):
    return diagnosis.recommended_actions(_diagnosed(spark, d), diagnosis.runbook_table(spark))


# --- time series ------------------------------------------------------------------------------------


def counter_rate(spark, d):
    points = ts.series(_samples(spark, d), COUNTER, ["node", "mode"])
    return ts.counter_rate(points, ["node", "mode"], GRID, SPAN)


def cpu_utilization(spark, d):
    return ts.cpu_utilization(_samples(spark, d), GRID, SPAN)


def gauge_difference(spark, d):
    return ts.gauge_difference(_gauges(spark, d), "node_memory_total", "node_memory_available", ["node"], GRID, SPAN)


def success_ratio(spark, d):
    return ts.success_ratio(_gauges(spark, d), ["pipeline"], GRID, SPAN)


def active_failures(spark, d):
    return ts.active_failures(_gauges(spark, d), ["pipeline"], GRID, SPAN)


def avg_task_duration(spark, d):
    return ts.avg_task_duration(_gauges(spark, d), ["pipeline", "namespace"], GRID, SPAN)


def matching_series_count(spark, d):
    return ts.matching_series_count(
        _gauges(spark, d), "run_duration", ["pipeline", "namespace"], {"namespace": "ns_1"}, GRID, SPAN
    )


def series_range(spark, d):
    points = ts.series(_gauges(spark, d), "run_duration", ["pipeline", "namespace"])
    return ts.series_range(points, ["pipeline", "namespace"], "2024-01-15 00:00:00", "2024-01-15 12:00:00")


def last_values(spark, d):
    return ts.last_values(ts.series(_gauges(spark, d), "run_duration", ["pipeline"]), ["pipeline"])


def resampled_series(spark, d):
    points = ts.series(_gauges(spark, d), "node_memory_available", ["node"])
    return ts.resampled_series(points, ["node"], GRID, SPAN)


def tumbling_health(spark, d):
    return ts.tumbling_health(_runs(spark, d))


def sliding_stats(spark, d):
    return ts.sliding_stats(_runs(spark, d))


def incident_sessions(spark, d):
    return alerts.incident_sessions(_runs(spark, d))


# --- text, jobs, tables -----------------------------------------------------------------------------


def word_count(spark, d):
    return text.word_count(derived.source_table(spark, d, "documents"))


def incomplete_jobs(spark, d):
    return quality.incomplete_jobs(derived.job_status_from_orders(derived.source_table(spark, d, "orders")))


def row_count_validation(spark, d):
    runs = _runs(spark, d)
    return quality.row_count_validation(runs, runs.filter(F.col("state") != "running"))


def partition_gaps(spark, d):
    return quality.partition_gaps(_runs(spark, d), "2024-01-01 00:00:00", "2024-01-30 00:00:00")


ALL: list[Query] = [
    scan_runs, append_runs, merge_diagnoses, stored_diagnoses, explained_anomalies, ordered_baselines,
    current_rows_stream, running_anomalies_stream, late_rows_stream, scan_samples, retained_samples, copy_tables_report, finished_runs,
    runs_in_window, sanitized_run_ids, run_durations, recorded_pipelines, uncovered_pipelines, failures_with_history,
    failures_with_history_ties, unsent_alerts, asof_baseline, asof_baseline_ties, asof_baseline_outliers, downstream_impact,
    duration_baselines, duration_baselines_success_only, run_history, robust_baselines, rca_distribution, top_failing,
    anomalies_per_day, rca_quality_trend, seven_day_trend, rollup_health, runtime_attribution, distinct_signatures,
    latest_runs, latest_runs_ties, recent_runs, low_success_last10, failure_streaks, failure_streaks_ties,
    flaky_pipelines, run_over_run_change, run_over_run_change_ties, duration_drift, anomaly_rank, recent_rca_summary,
    last_diagnoses, log_tail, duration_anomalies, duration_anomalies_ties, judged_runs, rolling_anomalies,
    fast_run_anomalies, fast_run_anomalies_ties, drift_anomalies, median_ratio_anomalies, failure_spikes,
    row_count_deviation, throughput_anomalies, sla_status, health_grade, all_rule_hits, newly_failing, still_failing,
    alert_feed, alert_routes, rca_prompts, anomaly_prompts, parsed_diagnoses, diagnosis_violations,
    diagnoses_with_fallback, diagnosed_failures, failure_alerts, anomaly_alerts, classified_errors, similar_incidents,
    near_incidents, grouped_alerts, recommended_actions, counter_rate, cpu_utilization, gauge_difference, success_ratio,
    active_failures, avg_task_duration, matching_series_count, series_range, last_values, resampled_series,
    tumbling_health, sliding_stats, incident_sessions, word_count, incomplete_jobs, row_count_validation,
    partition_gaps, upstream_impact, copy_differences, sketched_baselines, sketched_signatures, similar_incidents_lsh,
    classified_by_table,
]


UNROUNDED = {run_durations}  # quotients of whole numbers, equal in every engine


def _registered(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = query(apply_settings(spark), sf_dir)
        return found if query in UNROUNDED else _rounded(found)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES: dict[str, Query] = {q.__name__: _registered(q) for q in ALL}
