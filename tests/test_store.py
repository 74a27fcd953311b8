"""Repeatable appends and write-backs of a run table."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from runpulse.operators import diagnosis
from runpulse.plans.failure_diagnosis import diagnose_failures
from runpulse.sources import derived, run_store
from runpulse.sources.derived import AS_OF


@pytest.fixture(scope="module")
def runs(spark, sf_dir):
    return derived.runs_from_events(derived.source_table(spark, sf_dir, "events"))


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def rows(spark, path):
    return sorted(map(str, run_store.read_store(spark, path).collect()))


def test_appends_repeat_without_a_trace(spark, runs, fresh):
    path = fresh()
    assert run_store.append_once(runs, path, "a")
    once, kept = rows(spark, path), files(path)
    assert not run_store.append_once(runs, path, "a") and files(path) == kept
    half = runs.filter("id % 2 = 0").unionByName(runs.filter("id % 2 = 0")).unionByName(runs.limit(1).withColumn("id", F.lit(10**9).cast("bigint")))
    assert run_store.append_once(half, path, "b")  # a job that died before its marker, with one row more
    assert len(rows(spark, path)) == len(once) + 1 == runs.count() + 1


def test_write_back_touches_only_its_days(spark, runs, fresh):
    path = fresh()
    run_store.append_once(runs, path, "a")
    day = runs.filter("state = 'failed'").agg(F.min(F.to_date("execution_date"))).first()[0]
    found = diagnose_failures(runs.filter(F.to_date("execution_date") == day), AS_OF)
    before = files(path)
    assert run_store.store_diagnoses(found, path, "d") and not run_store.store_diagnoses(found, path, "d")
    after = files(path)
    moved = set(before.items()) ^ set(after.items())
    assert moved and all(f"run_date={day}" in name for name, _ in moved)
    stored = run_store.read_store(spark, path)
    assert stored.count() == runs.count() and stored.filter("rca_category IS NOT NULL").count() == found.count()
    once = rows(spark, path)
    run_store.store_diagnoses(found.withColumn("run_date", F.lit(day)), path, "again")
    assert rows(spark, path) == once
    untouched = files(path)
    assert run_store.store_diagnoses(found.withColumn("id", F.lit(-5).cast("bigint")), path, "nobody") and files(path) == untouched


def test_runs_without_a_day_or_an_id(spark, runs, fresh):
    path = fresh()
    odd = runs.limit(4).withColumn("execution_date", F.lit(None).cast("timestamp_ntz"))
    run_store.append_once(odd, path, "a")
    run_store.append_once(odd, path, "b")
    assert len(rows(spark, path)) == 4
    found = odd.select("id", F.lit("why").alias("root_cause"), *[F.lit(None).cast(t).alias(c) for c, t in (
        ("root_cause_category", "string"), ("confidence", "double"), ("immediate_fix", "string"), ("prevention", "string"), ("severity", "string"),
        ("retry_recommended", "boolean"), ("affected_downstream", "string"), ("similar_past_incidents", "string"),
        ("estimated_fix_time_minutes", "int"), ("generated_at", "timestamp_ntz"), ("model", "string"), ("response_seconds", "double"))])
    run_store.store_diagnoses(diagnosis.as_diagnosis_columns(found), path, "d")
    assert [r.rca_root_cause for r in run_store.read_store(spark, path).collect()] == ["why"] * 4
    nameless = runs.limit(2).withColumn("id", F.lit(None).cast("bigint")).withColumn("execution_date", F.lit(dt.datetime(2024, 5, 1)).cast("timestamp_ntz"))
    run_store.append_once(nameless, path, "c")
    assert len(rows(spark, path)) == 6 and not run_store.append_once(nameless, path, "c")
    run_store.append_once(runs.limit(0), path, "none")
    assert len(rows(spark, path)) == 6
