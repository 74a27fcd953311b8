"""Answers, fallbacks, write-back, alerts and the generator hook."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from runpulse.operators import alerts, diagnosis, lineage, text
from runpulse.operators import timeseries as ts
from runpulse.plans.anomaly_check import explained_anomalies, explanations
from runpulse.plans.failure_diagnosis import diagnose_failures, diagnosed_runs
from runpulse.sources import derived, sinks
from runpulse.sources.derived import AS_OF, ERROR_TEXTS


def parse(spark, *texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id bigint, response string")
    return [r for r in diagnosis.parsed_diagnoses(frame).orderBy("id").collect()]


def test_answers_are_classed(spark):
    good = '{"root_cause": "a", "confidence": 0.5}'
    rows = parse(
        spark, good, f" \n{good}\n", f"before\n{good}\nafter", f"{good} trailing", "[1]", "", None, f"{good} and {good}",
        "{'root_cause': 1}", f"{good},{good}", "no braces", '{"a": {"b": 1}}',
    )
    assert [r.status for r in rows] == [
        "ok", "ok", "extracted", "extracted", "parse_error", "parse_error", "parse_error", "parse_error", "parse_error",
        "parse_error", "parse_error", "ok",
    ]
    assert [r.root_cause for r in rows[:4]] == ["a"] * 4 and rows[0].confidence == 0.5


def test_wrong_types_become_null(spark):
    row = parse(spark, '{"confidence": "high", "retry_recommended": true, "estimated_fix_time_minutes": 7}')[0]
    assert row.confidence is None and row.retry_recommended is True and row.estimated_fix_time_minutes == 7


@pytest.mark.parametrize("status", ["timeout", "unreachable", "job_error", "parse_error"])
def test_fallback_follows_the_status(spark, status):
    frame = spark.createDataFrame([(1, None, status)], "id bigint, response string, status string")
    row = diagnosis.with_fallback(diagnosis.parsed_diagnoses(frame)).first()
    kept = next(f for f in diagnosis.FALLBACKS if f[0] == status)
    assert (row.root_cause_category, row.severity, row.estimated_fix_time_minutes, row.retry_recommended) == kept[1:5]
    assert row.confidence == 0.0


def test_all_sample_errors_are_classified(spark):
    frame = spark.createDataFrame([(t,) for t in ERROR_TEXTS], "m string").select(diagnosis.classify("m")["category"])
    assert [r[0] for r in frame.collect()] == [
        "resource_exhaustion", "configuration", "timeout", "permission_denied", "data_issue", "connectivity",
    ]


@pytest.fixture(scope="module")
def runs(spark, sf_dir):
    return derived.runs_from_events(derived.source_table(spark, sf_dir, "events"))


def test_merge_is_repeatable_and_sets_nulls(spark, runs):
    merged = diagnosed_runs(runs, derived.responses_from_runs(runs))
    assert merged.count() == runs.count()
    empty = merged.filter("rca_severity = 'high'").select("id", *[F.lit(None).alias(c) for c in merged.columns if c.startswith("rca_")])
    once = sinks.merge_diagnoses(merged, empty)
    assert once.filter("rca_severity = 'high'").count() == 0
    twice = sinks.merge_diagnoses(once, empty)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


@pytest.mark.parametrize(
    "error, category", [(TimeoutError, "resource_exhaustion"), (ConnectionError, "connectivity"), (KeyError, "configuration")]
)
def test_generator_errors_never_lose_rows(runs, error, category):
    def broken():
        def generate(batch):
            raise error("down")

        return generate

    found = diagnose_failures(runs, AS_OF, broken)
    failed = runs.filter("state = 'failed'").count()
    assert found.count() == failed == found.filter(F.col("rca_category") == category).count()


def test_slow_and_failing_calls_keep_their_rows(spark):
    prompts = spark.range(40).select("id", F.lit("p").alias("prompt")).coalesce(1)

    def make():
        def generate(batch):
            first = int(batch["id"].iloc[0])
            if first == 10:
                raise ConnectionError("line 7 is down")
            if first == 20:
                time.sleep(60)
            return batch["prompt"] + batch["id"].astype(str) if first != 30 else batch["prompt"].head(1)

        return generate

    found = {r.id: r for r in diagnosis.generated_answers(prompts, make, seconds=1.0, calls=2, rows=10).collect()}
    assert len(found) == 40
    assert [found[k].response for k in (0, 9, 10, 25, 39)] == ["p0", "p9", None, None, None]
    assert [found[k].status for k in (0, 10, 25, 39)] == [None, "unreachable", "timeout", "job_error"]
    assert found[10].error == "ConnectionError: line 7 is down" and "within 1 s" in found[25].error and "1 answers to 10" in found[39].error
    assert found[0].error is None and found[0].response_seconds < 1 <= found[25].response_seconds < 30


def test_a_generator_that_stops_is_not_asked_for_ever(spark):
    prompts = spark.range(30).select("id", F.lit("p").alias("prompt")).coalesce(1)
    begin = time.monotonic()
    make = lambda: lambda batch: time.sleep(120)
    found = diagnosis.generated_answers(prompts, make, seconds=0.5, calls=2, rows=1).collect()
    assert len(found) == 30 and {r.status for r in found} == {"timeout"} and time.monotonic() - begin < 60


def test_rules_need_no_python(runs):
    plan = diagnose_failures(runs, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_confidence_is_cut_not_rounded(spark, runs):
    merged = diagnosed_runs(runs, derived.responses_from_runs(runs)).filter("state = 'failed'").limit(1)
    frame = merged.withColumns({"rca_root_cause": F.lit("x"), "rca_confidence": F.lit(0.876)})
    assert alerts.failure_alerts(frame).first().confidence_pct == 87


def test_rate_of_a_counter_that_resets(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(seconds=60 * i), "c", {"n": "a"}, v) for i, v in enumerate([10.0, 40.0, 5.0, 35.0])]
    samples = spark.createDataFrame(rows, "ts timestamp_ntz, metric string, labels map<string,string>, value double")
    grid = ts.Grid("2024-01-01 00:00:00", "2024-01-01 00:10:00", 60)
    rates = ts.counter_rate(ts.series(samples, "c", ["n"]), ["n"], grid, 300).collect()
    at = {r.step.minute: r.rate for r in rates}
    assert at[3] == pytest.approx(65 / 180) and at[4] == pytest.approx(65 / 180)
    assert at[1] == pytest.approx(30 / 60)
    assert at[6] == pytest.approx(30 / 60)  # only the samples at 120 s and 180 s are left
    assert 8 not in at and all(r.rate >= 0 for r in rates)


def test_impact_follows_long_chains_and_cycles(spark):
    pairs = [(f"n{i}", f"n{i + 1}") for i in range(14)] + [("n14", "n0")]
    edges = spark.createDataFrame(pairs, "upstream string, downstream string")
    roots = spark.createDataFrame([("n0",)], "pipeline_id string")
    found = {r.downstream: r.depth for r in lineage.downstream_impact(roots, edges).collect()}
    assert found == {f"n{i}": i for i in range(1, 15)}


def test_tails(spark):
    lines = spark.range(250).select(F.lit("t").alias("task"), F.col("id").alias("line_no"), F.lit("x").alias("line"))
    assert [r[0] for r in text.log_tail(lines).agg(F.min("line_no"), ).collect()] == [150]
    frame = spark.createDataFrame([("a\nb\nc",), ("z",)], "t string")
    assert [r[0] for r in frame.select(text.text_tail("t", 2)).collect()] == ["b\nc", "z"]


def test_near_signatures_share_a_family(spark):
    texts = [
        "ConnectionError: could not reach host 10.0.0.1 on port 80 after 3 retries",
        "ConnectionError: could not reach host 10.9.8.7 on port 443 after 5 retries now",
        "FileNotFoundError: /a/b.csv: No such file or directory",
    ]
    frame = spark.createDataFrame([(t,) for t in texts], "error_message string")
    rows = diagnosis.signature_families(frame).collect()
    families = [r.family for r in rows]
    assert len(rows) == 3 and len(set(families)) == 2
    assert all(r.family <= r.fingerprint for r in rows)


def test_near_incidents_count_earlier_members_of_the_family(spark, runs):
    rows = diagnosis.near_incidents(runs).collect()
    at = {r.id: r.execution_date for r in runs.select("id", "execution_date").collect()}
    seen = {}
    for row in sorted(rows, key=lambda r: (at[r.id], r.id)):
        assert row.earlier == seen.get(row.family, 0)
        seen[row.family] = row.earlier + 1
    assert len(rows) == runs.filter("state = 'failed'").count()


def test_near_incidents_keep_failures_without_a_message(spark, runs):
    failed = runs.filter("state = 'failed'")
    third = F.when(F.col("id") % 3 > 0, F.col("error_message"))
    rows = diagnosis.near_incidents(failed.withColumn("error_message", third)).collect()
    assert len(rows) == failed.count()
    bare = [r for r in rows if r.fingerprint is None]
    assert bare and all(r.family is None and r.earlier == 0 for r in bare)


def test_anomalies_are_explained_or_get_the_fixed_record(spark):
    prompts = spark.createDataFrame([("a", "p"), ("b", "q")], "pipeline_id string, prompt string")

    def make():
        text = '{"anomaly_explanation": "more rows", "likely_cause": "data_volume_spike", "severity": "high", "escalate_to_oncall": true}'
        return lambda batch: batch["prompt"].map(lambda p: text if p == "p" else "none")

    given = explanations(prompts, make)
    rows = {r.pipeline_id: r for r in given.collect()}
    assert rows["a"].severity == "high" and rows["a"].escalate_to_oncall is True
    assert rows["b"].likely_cause == "unknown" and rows["b"].confidence == 0.5
    nested = explained_anomalies(prompts, given).filter("pipeline_id = 'a'").first()
    assert nested.anomaly.prompt == "p" and nested.explanation.likely_cause == "data_volume_spike"
