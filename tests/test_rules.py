"""Hand cases and properties of baselines and rules."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from runpulse.functions.measures import grade
from runpulse.operators import baselines, rules
from runpulse.sources.derived import AS_OF

SCHEMA = (
    "id bigint, pipeline_id string, task_id string, run_id string, execution_date timestamp_ntz, "
    "duration_seconds double, state string, row_count bigint"
)
NOON = dt.datetime(2024, 1, 30, 12)


def table(spark, rows):
    """Rows (pipeline, hours before noon, duration, state)."""
    full = [
        (i, p, "t", f"run_{i}", NOON - dt.timedelta(hours=h), None if d is None else float(d), s, 1000)
        for i, (p, h, d, s) in enumerate(rows)
    ]
    return spark.createDataFrame(full, SCHEMA)


def series(durations, pipeline="p", state="success"):
    """The last duration is the newest run."""
    return [(pipeline, len(durations) - i, d, state) for i, d in enumerate(durations)]


def flagged(runs):
    return {r.pipeline_id for r in rules.duration_anomalies(runs, AS_OF).collect()}


def test_five_runs_never_flag(spark):
    assert flagged(table(spark, series([100, 100, 100, 100, 100_000]))) == set()


def test_six_runs_can_flag(spark):
    assert flagged(table(spark, series([100] * 5 + [100_000]))) == {"p"}


def test_equal_durations_do_not_flag(spark):
    assert flagged(table(spark, series([100] * 9))) == set()


def test_missing_latest_duration_reads_zero(spark):
    runs = table(spark, series([100, 110, 120, 130, 140, None]))
    assert flagged(runs) == set()
    assert rules.judged_runs(runs, AS_OF).first().current_duration == 0.0


def test_deviation_of_the_worked_example(spark):
    frame = spark.createDataFrame([(240.0, 145.0)], "current double, mean double")
    assert frame.select(F.round(rules.deviation_pct("current", "mean"), 1)).first()[0] == 65.5


def test_running_rows_count_in_history_only(spark):
    rows = series([100] * 6) + [("p", 0, 500, "running"), ("p", 0.5, 100, None)]
    runs = table(spark, rows)
    assert baselines.duration_baselines(runs, AS_OF).first().total_runs == 6
    history = baselines.run_history(runs, AS_OF).first()
    assert history.total_runs == 8
    assert history.recent_statuses == ["running", None, "success"]


def test_edge_of_the_window_is_outside(spark):
    edge = dt.datetime(2024, 1, 1)
    runs = table(spark, [("p", 0, 1, "success")]).withColumn("execution_date", F.lit(edge).cast("timestamp_ntz"))
    inside = runs.withColumn("execution_date", F.lit(edge + dt.timedelta(microseconds=1)).cast("timestamp_ntz"))
    assert baselines.runs_in_window(runs, AS_OF).count() == 0
    assert baselines.runs_in_window(inside, AS_OF).count() == 1


def test_latest_run_of_a_tie_has_the_larger_id(spark):
    runs = table(spark, [("p", 1, 10, "success"), ("p", 1, 20, "failed")])
    assert baselines.latest_runs(runs).first().run_id == "run_1"


def test_success_rate_is_rounded(spark):
    runs = table(spark, series([1] * 4) + series([1, 1], state="failed"))
    assert baselines.duration_baselines(runs, AS_OF).first().success_rate_pct == 66.67


def test_grade_steps(spark):
    frame = spark.createDataFrame([(0.79,), (0.8,), (0.9,)], "r double")
    assert [r[0] for r in frame.select(grade("r")).collect()] == ["green", "yellow", "red"]
    assert [r[0] for r in frame.select(grade("r", invert=True)).collect()] == ["red", "yellow", "green"]


def test_streak_is_found_and_ends_at_a_success(spark):
    states = ["failed", "failed", "success", "failed", "failed", "failed"]
    runs = table(spark, [("p", 6 - i, 1, s) for i, s in enumerate(states)])
    assert [r.length for r in rules.failure_streaks(runs).collect()] == [3]


@pytest.fixture(scope="module")
def noisy(spark):
    rnd = random.Random(5)
    rows = []
    for p in range(30):
        n = rnd.randint(2, 40)
        rows += series([rnd.choice([None, rnd.expovariate(0.02), 1000 * rnd.random()]) for _ in range(n)], f"p{p}")
    return table(spark, rows).cache()


def test_bounds_hold(noisy):
    for row in baselines.duration_baselines(noisy, AS_OF).collect():
        assert 0 <= row.lower_threshold <= row.avg_duration <= row.upper_threshold


def test_no_deviation_exceeds_its_bound(noisy):
    judged = rules.judged_runs(noisy, AS_OF).filter("stddev_duration > 0").collect()
    assert judged
    for row in judged:
        z = (row.current_duration - row.avg_duration) / row.stddev_duration
        assert z <= (row.total_runs - 1) / math.sqrt(row.total_runs) + 1e-9


def test_anomalies_equal_a_plain_loop(noisy):
    runs = {}
    for r in noisy.collect():
        runs.setdefault(r.pipeline_id, []).append(r)
    expected = set()
    for name, mine in runs.items():
        values = [r.duration_seconds for r in mine if r.duration_seconds is not None]
        if len(mine) < 5 or len(values) < 2:
            continue
        mean = sum(values) / len(values)
        sigma = math.sqrt(sum((v - mean) ** 2 for v in values) / (len(values) - 1))
        latest = max(mine, key=lambda r: (r.execution_date, r.id)).duration_seconds or 0.0
        if latest > mean + 2 * sigma > 0:
            expected.add(name)
    assert flagged(noisy) == expected


def test_success_only_baseline_still_judges_the_latest_finished_run(spark):
    runs = table(spark, series([100] * 6) + [("p", 0, 900, "failed")])
    row = rules.judged_runs(runs, AS_OF, states=("success",)).first()
    assert row.total_runs == 6 and row.current_duration == 900.0 and row.is_anomaly
