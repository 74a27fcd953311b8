"""Sketches, the rule table, the incident index, lineage both ways and differences of copies, against plain versions."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from checks.queries import _runs
from runpulse.functions.text import signature
from runpulse.operators import differences, incident_index, lineage, quality, rule_table, sketches
from runpulse.operators.diagnosis import classified_errors
from runpulse.sources.derived import AS_OF

RUN = "id bigint, pipeline_id string, state string, execution_date timestamp_ntz, duration_seconds double, error_message string"
START = datetime(2024, 1, 1)


def test_quantiles_of_merged_days_keep_their_rank(spark):
    rng = random.Random(3)
    rows = [
        (k, f"p{k % 3}", "success", START + timedelta(hours=rng.randrange(24 * 30)), rng.lognormvariate(3, 2), None)
        for k in range(60_000)
    ]
    rows += [(-k, "empty", "success", START + timedelta(days=k), None, None) for k in range(5)]
    daily = sketches.daily_sketches(spark.createDataFrame(rows, RUN).repartition(7))
    found = {r.pipeline_id: r for r in sketches.sketched_baselines(daily, AS_OF).collect()}
    assert found["empty"].median_duration is None and found["empty"].total_runs == 5
    for p in ("p0", "p1", "p2"):
        values = sorted(r[4] for r in rows if r[1] == p and r[3] >= START)
        assert found[p].total_runs == len(values) and found[p].failure_rate_pct == 0
        for got, rank in ((found[p].median_duration, 0.5), (found[p].p95_duration, 0.95)):
            below = sum(v < got for v in values) / len(values)
            assert abs(below - rank) <= 2 * sketches.RANK_ERROR


def test_sketched_signatures_are_within_three_percent(spark):
    letters = "abcdefghijklmnop"
    name = lambda k: "".join(letters[k >> s & 15] for s in (12, 8, 4, 0))
    rows = [
        (k, "many", "failed", START + timedelta(hours=k % 700), 1.0, f"Error: {name(k % 20_000)} broke") for k in range(40_000)
    ]
    rows += [(-1, "none", "failed", START, 1.0, None), (-2, "fine", "success", START, 1.0, None)]
    found = {
        r.pipeline_id: (r.failures, r.signatures)
        for r in sketches.sketched_signatures(sketches.daily_sketches(spark.createDataFrame(rows, RUN))).collect()
    }
    assert found.keys() == {"many", "none"} and found["none"] == (1, 0)
    assert found["many"][0] == 40_000 and abs(found["many"][1] - 20_000) <= 600


def test_rule_table_equals_the_ladder(spark):
    texts = [
        "OutOfMemory", "Out of Memory", "java heap space", "too many connections", "ACCESS DENIED", "File Not Found", "cannot connect",
        "Timed out", "time  out", "timeout", "TypeError: x", "type error", "syntax", "it", "", None, "memory: connection refused", "ti",
    ]
    runs = spark.createDataFrame([(k, "p", "failed", START, 1.0, t) for k, t in enumerate(texts * 3)], RUN)
    ours = sorted(map(tuple, rule_table.classified_by_table(runs, rule_table.rule_rows(spark)).collect()))
    assert ours == sorted(map(tuple, classified_errors(runs).collect()))
    own = spark.createDataFrame([(2, "^it$", None, "a", "low"), (1, "i", ["i"], "b", "high"), (0, None, [], "c", "low")], rule_table.RULE_SCHEMA)
    found = {r.id: r.category for r in rule_table.classified_by_table(runs, own, ("d", "low")).collect()}
    assert found[13] == "b" and found[17] == "b" and found[14] == found[15] == "d"
    none = rule_table.classified_by_table(runs, own.limit(0)).select("category").distinct().collect()
    assert [r.category for r in none] == ["configuration"]
    assert rule_table.classified_by_table(runs.limit(0), own).count() == 0


def test_incident_index_finds_the_nearest_known_signature(spark, fresh):
    rng = random.Random(5)
    pool = ["".join(rng.choice("bcdfghklm") + rng.choice("aeiou") for _ in range(4)) for _ in range(80)]
    old, new = [], []
    for _ in range(60):
        base = rng.sample(pool, rng.randint(4, 14))
        for many in (old, new):
            for _ in range(4):
                words = list(base)
                for _ in range(rng.randint(0, 3)):
                    words[rng.randrange(len(words))] = rng.choice(pool)
                many.append(" ".join(words))
    frame = lambda many: spark.createDataFrame(
        [(k, "p", "failed", START + timedelta(hours=k), 1.0, t) for k, t in enumerate(many)], RUN
    )
    path = fresh()
    incident_index.build_index(frame([*old, *old[:5], None]), path)
    found = {r.id: r for r in incident_index.look_up(frame([*new, old[0], None]), path).collect()}
    prints = {r.s: r.f for r in frame(old + new).select(signature("error_message").alias("s"), F.md5(signature("error_message")).alias("f")).collect()}
    overlap = lambda a, b: len(set(a.split()) & set(b.split())) / len(set(a.split()) | set(b.split()))
    hits = wanted = 0
    for k, text in enumerate([*new, old[0]]):
        near = sorted((-overlap(text, o), prints[o]) for o in set(old) if overlap(text, o) >= 0.6)
        assert (found[k].nearest is None) or -found[k].overlap >= near[0][0] - 1e-12
        wanted += bool(near)
        hits += bool(near) and found[k].nearest == near[0][1]
        assert near or found[k].incidents == 0
    assert wanted > 100 and hits >= 0.99 * wanted
    assert found[len(new)].incidents >= 2 and found[len(new) + 1].nearest is None
    assert incident_index.look_up(frame([]), path).count() == 0


def test_lineage_both_ways_over_long_chains_and_cycles(spark):
    steps = [(k, k + 1) for k in range(11)] + [(11, 3), (2, 20), (20, 21), (None, 5)]
    name = lambda k: None if k is None else f"n{k}"
    edges = spark.createDataFrame([(name(a), name(b)) for a, b in steps] * 2, "upstream string, downstream string")
    roots = spark.createDataFrame([("n0",), ("n9",), ("alone",)], "pipeline_id string")

    def plain(turned):
        out = set()
        for root in ("n0", "n9"):
            depth, at = {root: 0}, [root]
            for node in at:
                for a, b in steps:
                    a, b = (b, a) if turned else (a, b)
                    if name(a) == node and b is not None and name(b) not in depth:
                        depth[name(b)] = depth[node] + 1
                        at.append(name(b))
            out |= {(root, node, d) for node, d in depth.items() if d}
        return out

    assert {tuple(r) for r in lineage.downstream_impact(roots, edges).collect()} == plain(False)
    assert {tuple(r) for r in lineage.upstream_impact(roots, edges).collect() if r.upstream is not None} == plain(True)


def test_differences_name_the_keys(spark, sf_dir):
    runs = _runs(spark, sf_dir).select("id", "pipeline_id", "duration_seconds")
    assert differences.copy_differences(runs, runs.repartition(3), ["id"]).isEmpty()
    odd = spark.createDataFrame([(1, "a", 1.0), (None, "b", 2.0), (3, "c", None), (3, "c", None), (4, "d", 4.0)], runs.schema)
    copy = spark.createDataFrame([(1, "a", 1.0), (None, "b", 2.5), (3, "c", None), (5, "e", 4.0)], runs.schema).select(
        "duration_seconds", "pipeline_id", "id"
    )
    found = {r.id: (r.status, r.source_rows, r.copy_rows) for r in differences.copy_differences(odd, copy, ["id"]).collect()}
    assert found == {None: ("changed", 1, 1), 3: ("changed", 2, 1), 4: ("missing", 1, 0), 5: ("extra", 0, 1)}
    assert differences.copy_differences(odd.limit(0), copy.limit(0), ["id"]).isEmpty()
    assert differences.copy_differences(odd, copy.limit(0), ["id", "pipeline_id"]).count() == 4


def test_copies_are_counted_while_they_are_written(spark, fresh):
    source, target = fresh(), fresh()
    spark.range(1000).write.parquet(f"{source}/t.parquet")
    spark.range(0).write.parquet(f"{source}/e.parquet")
    report = {r.table_name: tuple(r)[1:] for r in quality.copy_tables(spark, source, target, ["t", "e"]).collect()}
    assert report == {"t": (1000, 1000, True), "e": (0, 0, True)}


def test_impact_rounds_send_no_table_through_the_driver(spark, monkeypatch):
    plans = []

    def noted(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut_lineage(df, label)

    cut_lineage = lineage.cut_lineage
    monkeypatch.setattr(lineage, "cut_lineage", noted)
    edges = spark.createDataFrame([(f"n{k}", f"n{k + 1}") for k in range(7)], "upstream string, downstream string")
    roots = spark.createDataFrame([("n0",), ("n5",)], "pipeline_id string")
    assert lineage.downstream_impact(roots, edges).count() == 7 + 2
    assert len(plans) > 7 and not any("Broadcast" in p for p in plans)
