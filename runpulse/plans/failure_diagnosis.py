"""Diagnosis of failures: history, prompts, answers, fallbacks, write-back and alerts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from runpulse.operators import diagnosis
from runpulse.operators.baselines import is_state
from runpulse.operators.diagnosis import Generator
from runpulse.sources.sinks import merge_diagnoses

RULE_MODEL = "rules-1"


def diagnose_failures(
    runs: DataFrame, as_of: str, make_generator: Callable[[], Generator] | None = None, model: str = RULE_MODEL, **limits
) -> DataFrame:
    """Diagnoses of all failed runs, one row per id, under the column names of the run table.

    Without a generator the classification rules decide, as expressions. With one each failure is prompted with its history;
    `limits` are those of `generated_answers`.
    """
    if make_generator is None:
        filled = diagnosis.ruled_diagnoses(runs.filter(is_state("failed")))
    else:
        prompts = diagnosis.diagnosis_prompts(diagnosis.failures_with_history(runs))
        answers = diagnosis.generated_answers(prompts, make_generator, **limits)
        filled = diagnosis.with_fallback(diagnosis.parsed_diagnoses(answers))
    return diagnosis.as_diagnosis_columns(
        filled.withColumns({"model": F.lit(model), "generated_at": F.lit(as_of).cast("timestamp_ntz")})
    )


def diagnosed_runs(runs: DataFrame, responses: DataFrame) -> DataFrame:
    """Run table with the given raw answers parsed, filled and written back."""
    filled = diagnosis.with_fallback(diagnosis.parsed_diagnoses(responses))
    return merge_diagnoses(runs, diagnosis.as_diagnosis_columns(filled))
