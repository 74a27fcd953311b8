"""Failure diagnosis in batch: history, prompts, answers, fallbacks, validation, known fixes."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from runpulse import schemas
from runpulse.functions.measures import or_zero
from runpulse.functions.text import cut, error_class, fixed, signature
from runpulse.operators.baselines import WINDOW_DAYS, is_state, recent_run_lists
from runpulse.operators.components import connected_components
from runpulse.operators.joins import salted_join
from runpulse.operators.slices import DAY_US, add_slices, micros, previous_row, previous_rows, running_totals, trailing_moments
from runpulse.session import cut_lineage

# Classification rules, first match wins (pattern, category, severity).
ERROR_RULES = (
    (r"(?i)out ?of ?memory|heap space|memory", "resource_exhaustion", "high"),
    (r"(?i)connection slots|too many connections", "resource_exhaustion", "high"),
    (r"(?i)permission|access denied|forbidden", "permission_denied", "high"),
    (r"(?i)no such file|not found", "data_issue", "high"),
    (r"(?i)connect|refused|unreachable", "connectivity", "high"),
    (r"(?i)timed? ?out", "timeout", "medium"),
    (r"(?i)import|syntax|type ?error", "code_error", "medium"),
)
DEFAULT_RULE = ("configuration", "medium")

# What stands in for a missing diagnosis (status, category, severity, minutes to fix, retry).
FALLBACKS = (
    ("parse_error", "configuration", "medium", 10, True),
    ("timeout", "resource_exhaustion", "medium", 5, True),
    ("unreachable", "connectivity", "high", 15, False),
    ("job_error", "configuration", "medium", 15, True),
)
FALLBACK_SCHEMA = "status string, category string, severity string, minutes int, retry boolean"
# The stand-in for a missing anomaly explanation.
ANOMALY_FALLBACK = {
    "likely_cause": "unknown",
    "confidence": 0.5,
    "recommended_action": "compare this run with the ones before it",
    "severity": "medium",
    "escalate_to_oncall": False,
    "estimated_resolution_minutes": 30,
}

# Runbook: one known action per category (category, action, is_safe).
RUNBOOK = (
    ("data_issue", "check upstream delivery and backfill the missing input", True),
    ("resource_exhaustion", "raise executor memory or the connection pool and retry", True),
    ("connectivity", "wait for the service and retry", True),
    ("configuration", "compare the configuration with the last good run", True),
    ("code_error", "roll back to the last released version", False),
    ("dependency_failure", "rerun the failed upstream pipeline", True),
    ("permission_denied", "request the missing grant from the owner", False),
    ("timeout", "raise the task time limit and retry", True),
)


def classify(message: Column | str) -> Column:
    """Struct (category, severity) of an error text by the first rule that matches."""
    text = F.coalesce(F.col(message) if isinstance(message, str) else message, F.lit(""))
    pair = lambda c, s: F.struct(F.lit(c).alias("category"), F.lit(s).alias("severity"))
    ladder = None
    for pattern, category, severity in ERROR_RULES:
        hit = text.rlike(pattern)
        ladder = F.when(hit, pair(category, severity)) if ladder is None else ladder.when(hit, pair(category, severity))
    return ladder.otherwise(pair(*DEFAULT_RULE))


def classified_errors(runs: DataFrame) -> DataFrame:
    """Failed runs with error class, category and severity."""
    return (
        runs.filter(is_state("failed"))
        .select("id", "pipeline_id", error_class("error_message").alias("error_type"), classify("error_message").alias("c"))
        .select("id", "pipeline_id", "error_type", "c.category", "c.severity")
    )


def failures_with_history(runs: DataFrame, days: int = WINDOW_DAYS, last: int = 3) -> DataFrame:
    """Failed runs with run count, mean and last states of their pipeline as they were before the failure.

    Earlier means by (date, id), any state, inside the window; without earlier runs the counts are 0.
    """
    timed = runs.withColumn("_at", micros("execution_date"))
    seen = previous_rows(
        add_slices(timed, ["pipeline_id"], "_at", "id"), ["pipeline_id"], "_at", "id", ["_at", "state"], last, "_before"
    ).drop("_cut", "_slice")
    known = trailing_moments(
        seen, ["pipeline_id"], "_at", "id", "duration_seconds", days * DAY_US, with_ties=True, like=timed
    )
    in_window = F.filter("_before", lambda r: r["_at"] > F.col("_at") - days * DAY_US)
    return (
        known.filter(is_state("failed"))
        .withColumn("recent_statuses", in_window["state"])
        .withColumn("total_runs", F.coalesce("prior_rows", F.lit(0)).cast("bigint"))
        .withColumn("avg_duration", F.round(or_zero("prior_avg"), 1))
        .drop("_at", "_before", "prior_rows", "prior_avg", "prior_stddev")
    )


def list_text(items: Column | str) -> Column:
    """Array as `a, b`, missing entries shown as `None`."""
    col = F.col(items) if isinstance(items, str) else items
    return F.array_join(col, ", ", "None")


def diagnosis_prompts(
    failures: DataFrame, log_length: int | None = None, message_length: int | None = None
) -> DataFrame:
    """One prompt per failure: a line that asks for a JSON object, and what is known as JSON; texts are whole unless lengths are given."""
    known = F.struct(
        F.struct(
            "pipeline_id",
            F.coalesce("task_id", F.lit("")).alias("task_id"),
            F.date_format("execution_date", "yyyy-MM-dd HH:mm:ss").alias("execution_date"),
            fixed(or_zero("duration_seconds")).alias("duration_seconds"),
            F.coalesce("error_type", F.lit("")).alias("error_type"),
            F.coalesce(cut("error_message", message_length), F.lit("")).alias("error_message"),
        ).alias("run"),
        F.struct(
            F.col("total_runs").cast("string").alias("total_runs"),
            fixed("avg_duration").alias("avg_duration"),
            list_text("recent_statuses").alias("recent_statuses"),
        ).alias("before"),
        F.coalesce(cut("error_message", log_length), F.lit("")).alias("log"),
        _wanted(schemas.DIAGNOSIS, root_cause_category=schemas.CATEGORIES, severity=schemas.SEVERITIES).alias("answer"),
    )
    prompt = F.concat(F.lit(DIAGNOSIS_TASK + "\n"), F.to_json(known))
    return failures.withColumn("prompt", prompt).withColumn("prompt_length", F.length("prompt").cast("bigint"))


#: First lines of the prompts.
DIAGNOSIS_TASK = "Why did `run` fail? Reply with nothing but a JSON object that has the keys of `answer`."
ANOMALY_TASK = "Why did `run` take so long? Reply with nothing but a JSON object that has the keys of `answer`."


def _wanted(schema: T.StructType, **choices) -> Column:
    """Keys of the wanted answer and, for each of `choices`, the values to choose from, as one struct."""
    text = lambda values: F.lit(", ".join(values))
    return F.struct(text(schema.fieldNames()).alias("keys"), *[text(values).alias(name) for name, values in choices.items()])


def anomaly_prompts(anomalies: DataFrame, runs: DataFrame, last: int = 5) -> DataFrame:
    """One prompt per anomaly with its last runs, newest first: a line that asks for a JSON object, and what is known as JSON."""
    lists = recent_run_lists(runs, last)
    seen = F.transform("recent_runs", lambda r: F.concat_ws(" ", fixed(r["duration_seconds"]), F.coalesce(r["state"], F.lit("unknown"))))
    numbers = ("current_duration", "avg_duration", "stddev_duration", "deviation_pct", "upper_threshold", "success_rate_pct")
    known = F.struct(
        F.struct("pipeline_id", *[fixed(c).alias(c) for c in numbers], F.col("total_runs").cast("string").alias("total_runs")).alias("run"),
        F.coalesce(F.array_join(seen, "; "), F.lit("")).alias("last_runs"),
        _wanted(schemas.ANOMALY_DIAGNOSIS, likely_cause=schemas.ANOMALY_CAUSES).alias("answer"),
    )
    prompt = F.concat(F.lit(ANOMALY_TASK + "\n"), F.to_json(known))
    return anomalies.join(lists, "pipeline_id", "left").withColumn("prompt", prompt).drop("recent_runs")


_END = "end-of-answer-7c41"


def _strict_object(text: Column) -> Column:
    """Variant `[object, end mark]` of a text that is exactly one JSON object, else null.

    The parser stops after the first value and would accept trailing words. Put into a list before an end
    mark, such a text is not valid or the mark is not the second entry. One parse decides and gives the values.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_END}"]')))
    whole = text.rlike(r"^\s*\{") & (F.try_variant_get(listed, "$[1]", "string") == _END)
    return F.when(whole, listed)


def parsed_diagnoses(responses: DataFrame, schema: T.StructType = schemas.DIAGNOSIS) -> DataFrame:
    """Raw answers as the columns of `schema` and a `status`.

    ok: the whole text is an object. extracted: the part from the first `{` to the last `}` is one.
    parse_error: neither, or no text. A `status` column in the input (timeout, unreachable, job_error)
    is kept for rows without an answer. Valid JSON that is no object counts as parse_error.
    """
    text = F.col("response")
    given = F.col("status") if "status" in responses.columns else F.lit(None).cast("string")
    inner = F.regexp_extract("response", r"(?s)\{.*\}", 0)
    tried = responses.withColumn("_whole", _strict_object(text)).withColumn(
        "_inner", F.when(F.col("_whole").isNull(), _strict_object(inner))
    )
    status = (
        F.when(F.col("_whole").isNotNull(), "ok")
        .when(F.col("_inner").isNotNull(), "extracted")
        .otherwise(F.coalesce(given, F.lit("parse_error")))
    )
    value = F.coalesce("_whole", "_inner")
    kept = [c for c in responses.columns if c not in ("response", "status")]
    return tried.select(
        *kept,
        status.alias("status"),
        *[
            F.try_variant_get(value, f"$[0].{f.name}", f.dataType.simpleString()).alias(f.name)
            for f in schema.fields
        ],
    )


def diagnosis_violations(parsed: DataFrame) -> DataFrame:
    """Parsed diagnoses with the list of rules they break; no row is dropped."""
    names = schemas.DIAGNOSIS.fieldNames()
    missing = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in names]
    outside = [
        F.when(F.col("root_cause_category").isNotNull() & ~F.col("root_cause_category").isin(*schemas.CATEGORIES), "unknown category"),
        F.when(F.col("severity").isNotNull() & ~F.col("severity").isin(*schemas.SEVERITIES), "unknown severity"),
        F.when(~F.col("confidence").between(0, 1), "confidence outside 0..1"),
    ]
    answered = F.col("status").isin("ok", "extracted")
    found = F.array_compact(F.array(*missing, *outside))
    return parsed.withColumn("violations", F.when(answered, found).otherwise(F.array(F.lit("no answer"))))


def with_fallback(parsed: DataFrame) -> DataFrame:
    """Fill the rows without an answer from the fixed record of their status; an unknown status counts as job_error."""
    spark = parsed.sparkSession
    records = spark.createDataFrame(list(FALLBACKS), FALLBACK_SCHEMA)  # four fixed rows
    records = records.withColumnsRenamed({"severity": "level", "status": "_known"})
    known = F.col("status").isin(*[r[0] for r in FALLBACKS], "ok", "extracted")
    kind = F.when(F.coalesce(known, F.lit(False)), F.col("status")).otherwise("job_error")
    joined = parsed.join(F.broadcast(records), kind == F.col("_known"), "left")
    lost = F.col("category").isNotNull()
    none = F.lit("not known")
    filled = {
        "root_cause": F.concat(F.lit("no diagnosis ("), "_known", F.lit(")")),
        "root_cause_category": F.col("category"),
        "confidence": F.lit(0.0),
        "immediate_fix": F.lit("read the messages of the run itself"),
        "prevention": none,
        "retry_recommended": F.col("retry"),
        "estimated_fix_time_minutes": F.col("minutes"),
        "severity": F.col("level"),
        "affected_downstream": none,
        "similar_past_incidents": none,
    }
    return joined.select(
        *[F.when(lost, filled[c]).otherwise(F.col(c)).alias(c) if c in filled else F.col(c) for c in parsed.columns]
    )


def with_anomaly_fallback(parsed: DataFrame) -> DataFrame:
    """Fill the anomaly explanations without an answer from the fixed record."""
    lost = ~F.col("status").isin("ok", "extracted")
    fixed_values = {**ANOMALY_FALLBACK, "anomaly_explanation": "not explained"}
    return parsed.withColumns(
        {c: F.when(lost, F.lit(v)).otherwise(F.col(c)) for c, v in fixed_values.items()}
    )


def as_diagnosis_columns(diagnoses: DataFrame) -> DataFrame:
    """Diagnoses under the column names of the run table."""
    return diagnoses.select(
        "id",
        F.col("root_cause").alias("rca_root_cause"),
        F.col("root_cause_category").alias("rca_category"),
        F.col("confidence").alias("rca_confidence"),
        F.col("immediate_fix").alias("rca_immediate_fix"),
        F.col("prevention").alias("rca_prevention"),
        F.col("severity").alias("rca_severity"),
        F.col("retry_recommended").alias("rca_retry_recommended"),
        F.col("affected_downstream").alias("rca_affected_downstream"),
        F.col("similar_past_incidents").alias("rca_similar_past_incidents"),
        F.col("estimated_fix_time_minutes").alias("rca_estimated_fix_minutes"),
        F.col("generated_at").alias("rca_generated_at"),
        F.col("model").alias("rca_model_used"),
        F.col("response_seconds").alias("rca_response_time_seconds"),
    )


Generator = Callable[[pd.DataFrame], pd.Series]

#: Status of the rows of a batch by what the generator raised; anything else is a job_error.
RAISED = ((TimeoutError, "timeout"), (ConnectionError, "unreachable"))


def _status(error: BaseException | None) -> str | None:
    return None if error is None else next((status for kind, status in RAISED if isinstance(error, kind)), "job_error")


def _call(generate: Generator, part: pd.DataFrame, seconds: float | None):
    """Start a call in a thread of its own; the function returned waits for it: (texts, status, error, seconds taken)."""
    box: dict = {}
    begin = time.monotonic()

    def work():
        try:
            box["texts"] = list(generate(part))
        except Exception as error:  # the plug-in is foreign code: whatever it raises must not fail the job
            box["error"] = error
        box["took"] = time.monotonic() - begin

    thread = threading.Thread(target=work, daemon=True)
    thread.start()

    def result():
        thread.join(None if seconds is None else max(0.0, begin + seconds - time.monotonic()))
        if thread.is_alive():
            return None, "timeout", f"no answer within {seconds:g} s", time.monotonic() - begin
        error, texts = box.get("error"), box.get("texts")
        if error is None and len(texts) != len(part):
            error, texts = ValueError(f"{len(texts)} answers to {len(part)} prompts"), None
        return texts, _status(error), None if error is None else f"{type(error).__name__}: {error}", box["took"]

    return result


def generated_answers(
    prompts: DataFrame, make_generator: Callable[[], Generator], seconds: float | None = None, calls: int = 1, rows: int | None = None
) -> DataFrame:
    """Answers of a plug-in text generator: `id`, `response`, `status`, `response_seconds`, `error`.

    `make_generator` runs once per partition and returns a function from a batch (id, prompt) to the
    answers. Batches hold at most `rows` prompts (an Arrow batch if not given); up to `calls` of them are asked for at the same
    time, and each is waited for no longer than `seconds`. A `TimeoutError` or `ConnectionError` it raises, or that deadline, marks the batch's
    rows `timeout` or `unreachable`, any other error marks them `job_error`; `error` says what happened and `response_seconds` how
    long the batch took. No row is lost. A call that is given up may go on in the background, so after `calls` of them in a partition
    the generator counts as gone and the rest is marked `timeout` without asking.
    """

    def frame(part: pd.DataFrame, texts, status, error, took) -> pd.DataFrame:
        return pd.DataFrame(
            {"id": part["id"].to_numpy(), "response": texts, "status": status, "response_seconds": took, "error": error},
            columns=["id", "response", "status", "response_seconds", "error"],
        )

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generate, broken, given_up = None, None, 0
        try:
            generate = make_generator()
        except Exception as error:  # foreign code, as above
            broken = (None, _status(error), f"{type(error).__name__}: {error}", None)
        for batch in batches:
            size = rows or max(1, len(batch))
            parts = [batch.iloc[at : at + size] for at in range(0, len(batch), size)]
            while parts:
                if broken is None and given_up >= calls:
                    broken = (None, "timeout", "the generator stopped answering", None)
                if broken is not None:
                    yield from (frame(part, *broken) for part in parts)
                    break
                now, parts = parts[: calls - given_up], parts[calls - given_up :]
                for part, result in [(part, _call(generate, part, seconds)) for part in now]:
                    texts, status, error, took = result()
                    given_up += status == "timeout" and error.startswith("no answer within")
                    yield frame(part, texts, status, error, took)

    schema = "id bigint, response string, status string, response_seconds double, error string"
    return prompts.select("id", "prompt").mapInPandas(answer, schema)


def ruled_diagnoses(failures: DataFrame) -> DataFrame:
    """What the classification rules say of each failed run, under the keys of a diagnosis, without any generator."""
    kind = classify("error_message")
    return failures.select(
        "id",
        F.lit("ok").alias("status"),
        F.substring_index(F.coalesce("error_message", F.lit("")), "\n", 1).alias("root_cause"),
        kind["category"].alias("root_cause_category"),
        F.lit(0.6).alias("confidence"),
        F.concat(F.lit("see the runbook entry for "), kind["category"]).alias("immediate_fix"),
        F.concat(F.lit("monitor for "), kind["category"]).alias("prevention"),
        kind["category"].isin("connectivity", "timeout").alias("retry_recommended"),
        F.lit(15).alias("estimated_fix_time_minutes"),
        kind["severity"].alias("severity"),
        F.lit("unknown").alias("affected_downstream"),
        F.lit("none").alias("similar_past_incidents"),
        F.lit(None).cast("double").alias("response_seconds"),
    )


def similar_incidents(runs: DataFrame) -> DataFrame:
    """Failed runs with the number and last date of earlier failures of the same signature.

    The signature is compared by its md5, so its text is not shuffled.
    """
    failed = runs.filter(is_state("failed")).select(
        "id", "pipeline_id", "execution_date",
        F.md5(signature("error_message")).alias("fingerprint"), micros("execution_date").alias("_at"),
    )
    sliced = add_slices(failed, ["fingerprint"], "_at", "id")
    counted = running_totals(
        sliced, ["fingerprint"], "_at", "id", {"earlier": F.lit(1)}, include_current=False
    )
    return previous_row(counted, ["fingerprint"], "_at", "id", ["execution_date"], "_prev").select(
        "id", "pipeline_id", "execution_date", "fingerprint",
        F.col("earlier").cast("bigint").alias("earlier"),
        F.col("_prev.execution_date").alias("last_seen"),
    )


def signature_families(failed: DataFrame, bands: int = 8, least: float = 0.6) -> DataFrame:
    """Fingerprint and family of every failure signature: the smallest fingerprint it is linked with, directly or through others.

    Works on the distinct signatures; two are linked if their words overlap by `least` or more (Jaccard). Signatures that
    share a minimal word hash in a band are first compared with the smallest fingerprint that has it, which groups most
    near-equal ones with one comparison per band. All linked pairs of different groups are then found: they share a word
    among the rarest ones of both, as many as leave fewer than a link needs.
    """
    words = F.array_distinct(F.split("signature", " "))
    known = cut_lineage(
        failed.select(signature("error_message").alias("signature"))
        .filter(F.col("signature").isNotNull())
        .distinct()
        .select(F.md5("signature").alias("fingerprint"), words.alias("words")),
        "signatures",
    )
    overlap = lambda a, b: F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))
    hashes = F.array(*[F.array_min(F.transform("words", lambda w, b=b: F.xxhash64(w, F.lit(b)))) for b in range(bands)])
    banded = known.select("fingerprint", "words", F.posexplode(hashes).alias("band", "hash"))
    first = banded.groupBy("band", "hash").agg(F.min(F.struct("fingerprint", "words")).alias("first"))
    stars = (
        salted_join(banded, first, ["band", "hash"], "fingerprint")
        .filter((F.col("fingerprint") != F.col("first.fingerprint")) & (overlap("words", "first.words") >= least))
        .select(F.col("fingerprint").alias("u"), F.col("first.fingerprint").alias("v"))
    )
    stars = cut_lineage(stars.distinct(), "stars")
    parts = connected_components(stars)
    grouped = cut_lineage(
        known.join(parts, F.col("fingerprint") == F.col("node"), "left").select(
            "fingerprint", "words", F.size("words").alias("n"), F.coalesce("component", "fingerprint").alias("grp")
        ),
        "grouped",
    )
    each = grouped.select("fingerprint", "grp", "n", F.explode("words").alias("word"))
    spread = each.groupBy("word").agg(F.count("*").alias("df"), F.min("grp").alias("low"), F.max("grp").alias("high"))
    rarest = Window.partitionBy("fingerprint").orderBy("df", "word")
    prefix = (
        each.join(spread, "word")
        .withColumn("at", F.row_number().over(rarest))
        .filter(F.col("at") <= F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1)
        .filter("low <> high")
    )
    prefix = cut_lineage(prefix.select("word", "fingerprint", "grp", "n"), "prefix")
    side = lambda mark: prefix.select("word", *[F.col(c).alias(f"{c}_{mark}") for c in ("fingerprint", "grp", "n")])
    pairs = (
        side("u").join(side("v"), "word")
        .filter((F.col("grp_u") < F.col("grp_v")) & (F.least("n_u", "n_v") >= F.greatest("n_u", "n_v") * least - 1e-9))
        .select(F.col("fingerprint_u").alias("u"), F.col("fingerprint_v").alias("v"))
        .distinct()
    )
    of = lambda name, at: known.select(F.col("fingerprint").alias(at), F.col("words").alias(name))
    across = pairs.join(of("a", "u"), "u").join(of("b", "v"), "v").filter(overlap("a", "b") >= least).select("u", "v")
    families = connected_components(stars.unionByName(across))
    return known.join(families, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", F.coalesce("component", "fingerprint").alias("family")
    )


def near_incidents(runs: DataFrame) -> DataFrame:
    """Failed runs with the number of earlier failures of the same family of signatures.

    A failure without a message has none and no earlier ones.
    """
    failed = runs.filter(is_state("failed"))
    rows = failed.select(
        "id", "pipeline_id", F.md5(signature("error_message")).alias("fingerprint"), micros("execution_date").alias("_at")
    )
    families = cut_lineage(signature_families(failed), "families")  # one row per signature, read several times
    named = salted_join(rows, families, ["fingerprint"], "id", "left")
    named = named.withColumn("family", F.coalesce("family", "fingerprint"))
    earlier = F.when(F.col("family").isNull(), 0).otherwise(F.col("earlier"))
    return running_totals(
        add_slices(named, ["family"], "_at", "id"), ["family"], "_at", "id", {"earlier": F.lit(1)}, include_current=False
    ).select("id", "pipeline_id", "fingerprint", "family", earlier.cast("bigint").alias("earlier"))


def recommended_actions(diagnosed: DataFrame, runbook: DataFrame) -> DataFrame:
    """Known action for each diagnosed failure, whether it is safe, and what to do. Nothing is executed."""
    known = diagnosed.filter(is_state("failed") & F.col("rca_category").isNotNull()).join(
        runbook, F.col("rca_category") == F.col("category"), "left"
    )
    decision = (
        F.when(F.col("action").isNull(), "escalate")
        .when(~F.col("is_safe"), "needs_approval")
        .when(F.col("rca_retry_recommended"), "propose_retry")
        .otherwise("propose_fix")
    )
    return known.select(
        "id", "pipeline_id", "run_id", "rca_category", "action", "is_safe", decision.alias("decision"),
        F.col("rca_generated_at").alias("decided_on"),
    )


def runbook_table(spark) -> DataFrame:
    return spark.createDataFrame(list(RUNBOOK), "category string, action string, is_safe boolean")
