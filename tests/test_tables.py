"""Readers, writers and views."""

import datetime as dt

from pyspark.sql import functions as F

from runpulse import schemas
from runpulse.operators import alerts, baselines, rules
from runpulse.operators.joins import salted_join
from runpulse.plans.failure_diagnosis import diagnosed_runs
from runpulse.sources import derived, sinks, tables
from runpulse.sources.derived import AS_OF


def runs_of(spark, sf_dir):
    return derived.runs_from_events(derived.source_table(spark, sf_dir, "events"))


def test_runs_are_appended_and_read_back(spark, sf_dir, fresh):
    path = fresh()
    runs = runs_of(spark, sf_dir).withColumn("error_message", F.when(F.col("error_id") == 0, F.repeat(F.lit("x"), 3000)))
    sinks.append_runs(runs.select(*schemas.RUN_FACTS.fieldNames()), path)
    sinks.append_runs(runs.limit(3).select(*schemas.RUN_FACTS.fieldNames()), path)
    back = tables.read_runs(spark, path, schemas.RUN_FACTS)
    assert back.count() == 1003
    assert back.agg(F.max(F.length("error_message"))).first()[0] == 3000  # messages are stored whole


def test_baselines_are_a_view(spark, sf_dir):
    view = tables.register_baselines_view(baselines.duration_baselines(runs_of(spark, sf_dir), AS_OF))
    assert spark.sql("SELECT count(*) FROM run_baselines").first()[0] == view.count() == 15


def test_samples_are_read_from_json(spark, fresh):
    path = fresh()
    rows = [(dt.datetime(2024, 1, 1), "m", {"node": "1", "mode": "idle"}, 2.5)]
    spark.createDataFrame(rows, schemas.SAMPLES).write.mode("overwrite").json(path)
    row = tables.read_samples(spark, path, "json").first()
    assert row.labels == {"node": "1", "mode": "idle"} and row.value == 2.5


def test_alerts_are_stored_by_day_and_severity(spark, sf_dir, fresh):
    path = fresh()
    runs = runs_of(spark, sf_dir)
    found = alerts.failure_alerts(diagnosed_runs(runs, derived.responses_from_runs(runs)))
    sinks.write_alerts(found, path)
    back = spark.read.json(path)
    assert back.count() == found.count() == 201
    assert {"alert_date", "severity", "subject", "blocks"} <= set(back.columns)


def test_salted_join_equals_a_plain_join(spark, sf_dir):
    runs = runs_of(spark, sf_dir)
    per_key = baselines.duration_baselines(runs, AS_OF).select("pipeline_id", "avg_duration")
    salted = salted_join(runs.select("id", "pipeline_id"), per_key, ["pipeline_id"], "id", "left")
    plain = runs.select("id", "pipeline_id").join(per_key, "pipeline_id", "left")
    count = lambda f: f.agg(F.count("*"), F.count("avg_duration"), F.sum("id")).first()
    assert count(salted) == count(plain)


def test_hot_pipeline_gives_the_same_answers(spark, sf_dir):
    """A third of all runs on one pipeline: the sliced rules equal those on plain windows."""
    from pyspark.sql import Window

    runs = runs_of(spark, sf_dir).withColumn("pipeline_id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("pipeline_id")))
    done = baselines.finished_runs(runs)
    w = Window.partitionBy("pipeline_id").orderBy("execution_date", "id")
    expected = done.select("id", F.lag("duration_seconds").over(w).alias("previous_duration"))
    found = rules.run_over_run_change(runs).select("id", "previous_duration")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)
    streak = (
        done.withColumn("g", F.row_number().over(w) - F.row_number().over(Window.partitionBy("pipeline_id", "state").orderBy("execution_date", "id")))
        .filter("state = 'failed'").groupBy("pipeline_id", "g").count().filter("count >= 3")
    )
    lengths = lambda f, c: sorted((r.pipeline_id, r[c]) for r in f.collect())
    assert lengths(rules.failure_streaks(runs), "length") == lengths(streak, "count")
