"""Schemas of the tables this library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _L, _I, _B = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType()
_N = T.TimestampNTZType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


RUN_FACTS = _struct(
    ("id", _L, False),
    ("pipeline_id", _S, False),
    ("task_id", _S, True),
    ("run_id", _S, False),
    ("execution_date", _N, False),
    ("start_date", _N, True),
    ("end_date", _N, True),
    ("duration_seconds", _D, True),
    ("state", _S, True),
    ("error_message", _S, True),
    ("error_type", _S, True),
)

DIAGNOSIS_COLUMNS = _struct(
    ("rca_root_cause", _S, True),
    ("rca_category", _S, True),
    ("rca_confidence", _D, True),
    ("rca_immediate_fix", _S, True),
    ("rca_prevention", _S, True),
    ("rca_severity", _S, True),
    ("rca_retry_recommended", _B, True),
    ("rca_affected_downstream", _S, True),
    ("rca_similar_past_incidents", _S, True),
    ("rca_estimated_fix_minutes", _I, True),
    ("rca_generated_at", _N, True),
    ("rca_model_used", _S, True),
    ("rca_response_time_seconds", _D, True),
)

RUNS = T.StructType(
    RUN_FACTS.fields
    + DIAGNOSIS_COLUMNS.fields
    + _struct(
        ("notification_sent", _B, True),
        ("notification_channels", T.ArrayType(_S), True),
        ("created_at", _N, True),
    ).fields
)

# Keys of a structured diagnosis, in the order a generator is asked for them.
DIAGNOSIS = _struct(
    ("root_cause", _S, True),
    ("root_cause_category", _S, True),
    ("confidence", _D, True),
    ("immediate_fix", _S, True),
    ("prevention", _S, True),
    ("retry_recommended", _B, True),
    ("estimated_fix_time_minutes", _I, True),
    ("severity", _S, True),
    ("affected_downstream", _S, True),
    ("similar_past_incidents", _S, True),
)

ANOMALY_DIAGNOSIS = _struct(
    ("anomaly_explanation", _S, True),
    ("likely_cause", _S, True),
    ("confidence", _D, True),
    ("recommended_action", _S, True),
    ("severity", _S, True),
    ("escalate_to_oncall", _B, True),
    ("estimated_resolution_minutes", _I, True),
)

SAMPLES = _struct(
    ("ts", _N, False),
    ("metric", _S, False),
    ("labels", T.MapType(_S, _S), False),
    ("value", _D, True),
)

# The categories, severities and causes a diagnosis may name.
CATEGORIES = (
    "data_issue",
    "resource_exhaustion",
    "connectivity",
    "configuration",
    "code_error",
    "dependency_failure",
    "permission_denied",
    "timeout",
)
SEVERITIES = ("low", "medium", "high", "critical")
ANOMALY_CAUSES = (
    "data_volume_spike",
    "resource_contention",
    "network_latency",
    "dependency_slowness",
    "memory_pressure",
    "configuration_drift",
    "external_system",
)
ANOMALY_SEVERITIES = ("low", "medium", "high")
FINISHED = ("success", "failed")
