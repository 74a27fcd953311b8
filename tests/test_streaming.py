"""Streams give what the batch forms give on closed windows."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runpulse import schemas
from runpulse.operators import alerts, baselines, rules, timeseries
from runpulse.sources import derived
from runpulse.sources.derived import AS_OF
from runpulse.streaming import jobs
from runpulse.streaming.upserts import Upserts

SENTINEL = "2024-03-01 00:00:00"


@pytest.fixture(scope="module")
def runs(spark, sf_dir):
    return derived.runs_from_events(derived.source_table(spark, sf_dir, "events")).select(*schemas.RUN_FACTS.fieldNames()).cache()


@pytest.fixture(scope="module")
def folder(spark, runs, tmp_path_factory):
    """Six files of five days each in time order, one late file, one replayed file, one row far ahead."""
    path = str(tmp_path_factory.mktemp("stream"))
    day = F.datediff("execution_date", F.lit("2024-01-01"))
    for i in range(6):
        part = runs.filter((day >= 5 * i) & (day < 5 * i + 5) if i < 5 else day >= 25)
        part.coalesce(1).write.mode("append").parquet(path)
    late = runs.limit(5).withColumn("id", F.col("id") + 1_000_000)
    late.coalesce(1).write.mode("append").parquet(path)
    runs.orderBy(F.desc("execution_date")).limit(3).coalesce(1).write.mode("append").parquet(path)
    far = F.lit(SENTINEL).cast("timestamp_ntz")
    ahead = runs.limit(1).withColumns({"id": F.lit(-1).cast("bigint"), "pipeline_id": F.lit("sentinel"), "execution_date": far})
    ahead.coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture
def collect(spark, fresh):
    def run(frame, name):
        query = jobs.start(frame.writeStream.format("memory").queryName(name).outputMode("append"), fresh())
        query.awaitTermination()
        return spark.table(name)

    return run


@pytest.fixture
def stream(spark, folder):
    return jobs.deduplicated(jobs.read_run_stream(spark, folder, files_per_trigger=1))


def as_set(frame, *cols):
    tidy = [F.col(c).cast("timestamp") if t.startswith("timestamp") else F.col(c) for c, t in frame.select(*cols).dtypes]
    return {tuple(round(v, 6) if isinstance(v, float) else v for v in row) for row in frame.select(*tidy).collect()}


def test_duplicates_and_late_rows_are_dropped(runs, stream, collect):
    found = collect(stream, "dedup").filter("id >= 0")
    assert found.count() == runs.count() == found.select("id").distinct().count()
    assert found.filter("id >= 1000000").count() == 0


def test_window_health(runs, stream, collect):
    cols = ("pipeline_id", "window_start", "runs", "failures", "avg_duration")
    found = collect(jobs.window_health(stream), "health").filter("pipeline_id <> 'sentinel'")
    assert as_set(found, *cols) == as_set(timeseries.tumbling_health(runs), *cols)


def test_sliding_windows(runs, stream, collect):
    cols = ("pipeline_id", "window_start", "runs", "failures", "avg_duration")
    found = collect(jobs.window_health(stream, "7 days", "1 day"), "sliding").filter("pipeline_id <> 'sentinel'")
    assert as_set(found, *cols) == as_set(timeseries.sliding_stats(runs), *cols)


def test_incident_sessions(runs, stream, collect):
    cols = ("pipeline_id", "first_seen", "last_seen", "runs", "failures")
    found = collect(jobs.incident_sessions(stream), "sessions").filter("pipeline_id <> 'sentinel'")
    assert as_set(found, *cols) == as_set(alerts.incident_sessions(runs), *cols)
    assert found.count() == 946


def test_judged_against_published_baselines(spark, runs, stream, collect):
    published = baselines.duration_baselines(runs, AS_OF).cache()
    found = collect(jobs.judged_stream(stream, published), "judged")
    expected = (
        baselines.finished_runs(runs).join(published, "pipeline_id").filter("duration_seconds > upper_threshold")
    )
    assert as_set(found, "id") == as_set(expected, "id") and expected.count() > 0


@pytest.fixture(scope="module")
def ordered(spark, runs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ordered"))
    day = F.datediff("execution_date", F.lit("2024-01-01"))
    for i in range(3):
        runs.filter((day >= 10 * i) & (day < 10 * i + 10)).coalesce(1).write.mode("append").parquet(path)
    return path


def test_running_detector_equals_unbounded_batch_and_survives_replay(spark, runs, ordered, fresh):
    target = fresh()
    batches = []
    judge = jobs.running_detector(target)

    def keep(batch, batch_id):
        batches.append(batch_id)
        judge(batch, batch_id)
        judge(batch, batch_id)  # the same batch again, as after a lost driver

    source = jobs.read_run_stream(spark, ordered, files_per_trigger=1)
    jobs.start(source.writeStream.foreachBatch(keep), fresh()).awaitTermination()
    found = spark.read.parquet(f"{target}/hits")
    expected = rules.rolling_anomalies(runs, days=None)
    assert batches == [0, 1, 2]
    assert {r.id for r in found.select("id").collect()} == {r.id for r in expected.select("id").collect()}
    assert found.count() == expected.count() == 45


def test_change_log_keeps_the_newest_row(spark, runs, fresh):
    path = fresh()
    store = jobs.change_log(path)
    first = runs.limit(10).cache()
    store(first, 0)
    update = first.limit(4).withColumn("state", F.lit("changed"))
    store(update, 1)
    store(update, 1)
    now = jobs.current_rows(spark, path, first.schema)
    assert now.count() == 10 and now.filter("state = 'changed'").count() == 4


def test_state_is_forgotten(spark, runs, fresh):
    target = fresh()
    judge = jobs.running_detector(target, forget_days=30)
    one = runs.filter("pipeline_id = 'dag_1'").limit(5)
    judge(one, 0)
    judge(one.withColumns({"pipeline_id": F.lit("other"), "execution_date": F.col("execution_date") + F.expr("INTERVAL 90 DAYS")}), 1)
    kept = Upserts(f"{target}/state", jobs.STATE, ["pipeline_id"], expire=("last_run", 30)).current(spark).collect()
    assert [r.pipeline_id for r in kept] == ["other"]


def test_upserts_merge_and_repeat(spark, fresh):
    path, want = fresh(), {}
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()), T.StructField("at", T.LongType())])
    store = Upserts(path, schema, ["id"], ["at"], fan=3)
    for k in range(14):
        rows = [(i, f"{k}-{i}-{a}", a) for i in (k % 5, k % 3, k, None) for a in (2, 1)]
        frame = spark.createDataFrame(rows, schema)
        store.store(frame, k)
        if k in (2, 8, 13):
            store.store(frame, k)  # again, as after a lost driver
        want |= {i: f"{k}-{i}-2" for i, _, _ in rows}
        assert {r.id: r.v for r in store.current(spark).collect()} == want
    assert sorted(store.segments(spark)) == [(0, 12), (0, 13), (1, 11), (2, 8)]
    text = store.current(spark)._jdf.queryExecution().executedPlan().toString()
    names = sorted(f.getPath().getName() for f in store._fs(spark, "segments")[0].listStatus(store._fs(spark, "segments")[1]))
    assert names == ["0-12", "0-13", "1-11", "2-8"] and "segments/2-8" in text
    assert store.current(spark, before=13).filter("id = 13").count() == 0


def test_late_rows_are_kept_apart(spark, runs, folder, fresh):
    target, source = fresh(), jobs.read_run_stream(spark, folder, files_per_trigger=1)
    divide = jobs.late_rows(source, target)

    def twice(batch, batch_id):
        divide(batch, batch_id)
        divide(batch, batch_id)

    jobs.start(source.writeStream.foreachBatch(twice), fresh()).awaitTermination()
    late, on_time = (spark.read.parquet(f"{target}/{name}") for name in ("late", "on_time"))
    assert late.filter("id >= 1000000").count() == 5 and on_time.filter("id >= 1000000").count() == 0
    assert late.count() + on_time.count() == spark.read.parquet(folder).count()
