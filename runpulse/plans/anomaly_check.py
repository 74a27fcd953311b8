"""The periodic check: baselines, anomalies, prompts and alerts, as one chain of DataFrames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from runpulse import schemas
from runpulse.operators import alerts, diagnosis, rules
from runpulse.operators.diagnosis import Generator


def anomaly_check(runs: DataFrame, as_of: str, explanations: DataFrame | None = None) -> dict[str, DataFrame]:
    """Anomalies with their prompts and alerts. Without baselines all three are empty."""
    anomalies = rules.duration_anomalies(runs, as_of)
    return {
        "anomalies": anomalies,
        "prompts": diagnosis.anomaly_prompts(anomalies, runs),
        "alerts": alerts.anomaly_alerts(anomalies, explanations),
    }


def explanations(prompts: DataFrame, make_generator: Callable[[], Generator]) -> DataFrame:
    """Explanation of each prompted anomaly by a plug-in generator, the fixed one where it gives none."""
    keyed = prompts.select("pipeline_id", F.xxhash64("pipeline_id").alias("id"), "prompt")
    answers = diagnosis.generated_answers(keyed, make_generator)
    parsed = diagnosis.parsed_diagnoses(answers, schemas.ANOMALY_DIAGNOSIS)
    names = keyed.select("pipeline_id", "id")
    return names.join(diagnosis.with_anomaly_fallback(parsed), "id").drop("id")


def explained_anomalies(anomalies: DataFrame, explanations: DataFrame) -> DataFrame:
    """Anomaly and its explanation as two nested records; `explanation` is null where none was given."""
    record = F.struct(*[c for c in anomalies.columns if c != "pipeline_id"])
    given = F.struct(*[c for c in explanations.columns if c != "pipeline_id"])
    return anomalies.select("pipeline_id", record.alias("anomaly")).join(
        explanations.select("pipeline_id", given.alias("explanation")), "pipeline_id", "left"
    )
