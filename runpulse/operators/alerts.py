"""Alert rows: failure and anomaly alerts, routing, unsent alerts, grouping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from runpulse.functions.measures import or_zero
from runpulse.functions.text import cut, fixed, lookup, signature, title, yes_no
from runpulse.operators.baselines import is_state
from runpulse.operators.diagnosis import ANOMALY_FALLBACK
from runpulse.operators.slices import add_slices, micros, previous_row, running_totals

# Marks and colours by severity.
EMOJI = {
    "CRITICAL": ":red_circle:",
    "HIGH": ":large_orange_circle:",
    "MEDIUM": ":large_yellow_circle:",
    "LOW": ":large_green_circle:",
}
NO_EMOJI = ":white_circle:"
COLOUR = {"CRITICAL": "#d32f2f", "HIGH": "#e65100", "MEDIUM": "#f57c00", "LOW": "#388e3c"}
NO_COLOUR = "#616161"
ANOMALY_COLOUR = "#e65100"

LINK = "/pipelines/"
GAP_US = 30 * 60 * 1_000_000


def _or(name: str, default: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(default))


def failure_alerts(diagnosed: DataFrame, excerpt_length: int | None = None) -> DataFrame:
    """One alert per diagnosed failure: subject, severity, colour, body fields and message blocks."""
    level = F.upper(_or("rca_severity", "unknown"))
    confidence = (or_zero("rca_confidence") * 100).cast("int")  # cut, not rounded
    rows = diagnosed.filter(is_state("failed") & F.col("rca_root_cause").isNotNull()).select(
        F.col("id").alias("alert_id"),
        "pipeline_id", "task_id", "execution_date",
        level.alias("severity"),
        lookup(level, EMOJI, NO_EMOJI).alias("emoji"),
        lookup(level, COLOUR, NO_COLOUR).alias("colour"),
        confidence.alias("confidence_pct"),
        title(_or("rca_category", "unknown")).alias("category"),
        _or("rca_root_cause", "not known").alias("root_cause"),
        _or("rca_immediate_fix", "not known").alias("immediate_fix"),
        _or("rca_prevention", "not known").alias("prevention"),
        _or("rca_estimated_fix_minutes", "?").alias("fix_minutes"),
        yes_no("rca_retry_recommended").alias("retry"),
        _or("rca_model_used", "unknown").alias("model"),
        cut("error_message", excerpt_length).alias("error_excerpt"),
        F.date_format("created_at", "yyyy-MM-dd HH:mm 'UTC'").alias("generated"),
    )
    subject = F.concat_ws(" / ", F.lower("severity"), "pipeline_id", "task_id", "category")
    link = F.concat(F.lit(LINK), "pipeline_id")
    return (
        rows.withColumn("subject", subject)
        .withColumn("link", link)
        .withColumn("blocks", _failure_blocks())
    )


def _failure_blocks() -> Column:
    """The message as a JSON list: one block per part, each with what stands in the alert's columns."""
    part = lambda name, *columns: F.struct(F.lit(name).alias("part"), *columns)
    blocks = [
        part("what", "emoji", "severity", "pipeline_id", _or("task_id", "").alias("task_id"), "link"),
        part("why", "category", "root_cause", F.col("confidence_pct").cast("string").alias("confidence_pct"), "model"),
        part("then", "immediate_fix", "prevention", "fix_minutes", "retry"),
    ]
    return F.concat(F.lit("["), F.concat_ws(",", *[F.to_json(b) for b in blocks]), F.lit("]"))


def anomaly_alerts(
    anomalies: DataFrame, explanations: DataFrame | None = None, text_length: int | None = None
) -> DataFrame:
    """One alert per duration anomaly.

    `explanations` (pipeline_id and the anomaly diagnosis keys) is optional; anomalies without one get the
    fixed fallback.
    """
    names = ["anomaly_explanation", "likely_cause", "recommended_action", "severity", "escalate_to_oncall"]
    if explanations is None:
        joined = anomalies.select("*", *[F.lit(None).cast("string").alias(f"_{c}") for c in names])
    else:
        given = explanations.select("pipeline_id", *[F.col(c).cast("string").alias(f"_{c}") for c in names])
        joined = anomalies.join(given, "pipeline_id", "left")
    level = F.upper(F.coalesce("_severity", F.lit(ANOMALY_FALLBACK["severity"])))
    explanation = F.coalesce("_anomaly_explanation", F.lit("not explained"))
    text = F.concat_ws(
        " ", fixed("current_duration", 0), F.lit("s instead of"), fixed("avg_duration", 0), F.lit("s:"), cut(explanation, text_length)
    )
    return joined.select(
        "pipeline_id", "run_id", "execution_date",
        level.alias("severity"),
        F.lit(ANOMALY_COLOUR).alias("colour"),
        F.concat_ws(" / ", F.lower(level), "pipeline_id", F.lit("slow run")).alias("subject"),
        text.alias("text"),
        F.coalesce("_likely_cause", F.lit(ANOMALY_FALLBACK["likely_cause"])).alias("likely_cause"),
        F.coalesce("_recommended_action", F.lit(ANOMALY_FALLBACK["recommended_action"])).alias("recommended_action"),
        F.coalesce(F.col("_escalate_to_oncall").cast("boolean"), F.lit(False)).alias("escalate_to_oncall"),
        yes_no(F.col("_escalate_to_oncall").cast("boolean")).alias("escalate"),
        "current_duration", "avg_duration", "deviation_pct",
        F.concat(F.lit(LINK), "pipeline_id").alias("link"),
    )


def alert_feed(failures: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Both kinds of alert in one table; columns a kind does not have are null."""
    return failures.select(
        F.lit("failure").alias("kind"), "alert_id", "pipeline_id", "task_id", "execution_date", "severity", "subject",
    ).unionByName(
        anomalies.select(
            F.lit("anomaly").alias("kind"), "pipeline_id", "run_id", "execution_date", "severity", "subject",
            "escalate_to_oncall",
        ),
        allowMissingColumns=True,
    )


def alert_routes(feed: DataFrame) -> DataFrame:
    """On-call for high, critical and explicitly escalated alerts, the team channel for the rest."""
    urgent = F.col("severity").isin("HIGH", "CRITICAL") | F.coalesce("escalate_to_oncall", F.lit(False))
    return feed.withColumn("route", F.when(urgent, "oncall").otherwise("channel"))


def unsent_alerts(alerts: DataFrame, sent: DataFrame) -> DataFrame:
    """Alerts whose id is not in the log of sent alerts."""
    return alerts.join(sent.select("alert_id"), "alert_id", "left_anti")


def alert_events(runs: DataFrame, slow_runs: DataFrame) -> DataFrame:
    """Failures and slow runs as one table of alert events for grouping."""
    failures = runs.filter(is_state("failed")).select(
        "id", "pipeline_id", "execution_date",
        F.lit("failure").alias("rule"), F.md5(signature("error_message")).alias("fingerprint"),
        F.lit(3).alias("rank"), F.lit(0.0).alias("deviation_pct"),
    )
    slow = slow_runs.select(
        "id", "pipeline_id", "execution_date",
        F.lit("slow_run").alias("rule"), F.lit("-").alias("fingerprint"), F.lit(2).alias("rank"), "deviation_pct",
    )
    return failures.unionByName(slow)


def sessions(events: DataFrame, keys: list[str], gap_us: int = GAP_US) -> DataFrame:
    """Add `session`, the running number of the event's session: a new one begins after a gap above `gap_us`.

    `events` has `id` and `execution_date` and is read several times, so it must be a stored table or a
    repeatable projection of one.
    """
    sliced = add_slices(events.withColumn("_at", micros("execution_date")), keys, "_at", "id")
    linked = previous_row(sliced, keys, "_at", "id", ["_at"], "_prev")
    before = F.col("_prev._at")
    begins = F.when(before.isNull() | (F.col("_at") - before > gap_us), 1).otherwise(0)
    marked = linked.withColumn("_begins", begins).drop("_prev")
    return running_totals(marked, keys, "_at", "id", {"session": F.col("_begins")}).drop(
        "_begins", "_cut", "_slice"
    )


def grouped_alerts(events: DataFrame) -> DataFrame:
    """Repeated alerts of one pipeline, rule and signature as one row each, with size and priority."""
    keys = ["pipeline_id", "rule", "fingerprint"]
    return (
        sessions(events, keys)
        .groupBy(*keys, "session")
        .agg(
            F.min("execution_date").alias("first_seen"),
            F.max("execution_date").alias("last_seen"),
            F.count("*").alias("alerts"),
            F.max("rank").alias("rank"),
            F.max("deviation_pct").alias("deviation_pct"),
        )
        .withColumn("priority", F.col("rank") * 1000.0 + F.least("deviation_pct", F.lit(999.0)))
        .drop("session", "rank")
    )


def incident_sessions(runs: DataFrame, gap_us: int = GAP_US) -> DataFrame:
    """Runs of a pipeline no more than the gap apart as one session."""
    return (
        sessions(runs.select("id", "pipeline_id", "execution_date", "state"), ["pipeline_id"], gap_us)
        .groupBy("pipeline_id", "session")
        .agg(
            F.min("execution_date").alias("first_seen"),
            F.max("execution_date").alias("last_seen"),
            F.count("*").alias("runs"),
            F.count_if(is_state("failed")).alias("failures"),
        )
        .drop("session")
    )
