"""The physical plans are the ones we want."""

import re

import pytest
from pyspark.sql import functions as F

from runpulse.operators import baselines, rules
from runpulse.sources import derived, sinks, tables
from runpulse.sources.derived import AS_OF


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def runs(spark, sf_dir):
    return derived.runs_from_events(derived.source_table(spark, sf_dir, "events"))


def test_anomalies_need_one_shuffle(runs):
    text = plan(rules.duration_anomalies(runs, AS_OF))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_all_rules_read_the_runs_once(runs, monkeypatch):
    """Counted are the scans of the runs in the plans of what is stored and of the result; the windows' facts take one pass."""
    seen, keep = {}, rules.cut_lineage

    def noted(df, label):
        seen[label] = plan(df)
        return keep(df, label)

    monkeypatch.setattr(rules, "cut_lineage", noted)
    seen["hits"] = plan(rules.all_rule_hits(runs, AS_OF))
    of_runs = {label: len(re.findall(r"FileScan parquet [^\n]*events\.parquet", text)) for label, text in seen.items()}
    assert of_runs == {"rule-runs": 1, "rule-window": 0, "rule-recent": 0, "rule-marks": 0, "hits": 0}
    assert seen["rule-window"].count("FileScan") == 1 and seen["rule-recent"].count("FileScan") == 1


def test_baselines_can_be_ordered(runs):
    names = [r[0] for r in baselines.ordered_baselines(runs, AS_OF).select("pipeline_id").collect()]
    assert names and names == sorted(names)


def test_top_runs_are_limited_before_the_shuffle(runs):
    text = plan(baselines.recent_runs(runs, 5))
    assert text.count("WindowGroupLimit") == 2


def test_scan_reads_needed_columns_and_pushes_the_window(runs):
    text = plan(baselines.duration_baselines(runs, AS_OF))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "props" not in schema and "event_id" not in schema
    assert "GreaterThan(ts" in text


def test_day_folders_outside_the_window_are_skipped(spark, runs, fresh):
    path = fresh()
    sinks.append_runs(runs, path)
    stored = spark.read.parquet(path)
    recent = baselines.runs_in_window(stored, AS_OF, 3)
    assert "PartitionFilters: [isnotnull(run_date" in plan(recent)
    assert recent.count() == baselines.runs_in_window(runs, AS_OF, 3).count()


@pytest.mark.parametrize("rule", [rules.rolling_anomalies, rules.run_over_run_change, rules.failure_streaks])
def test_no_window_over_rows_is_keyed_by_pipeline_alone(runs, rule):
    """Every window over raw rows is inside a slice or a block of time that was counted and is not hot; windows by
    pipeline see one row per slice."""
    from runpulse.operators.slices import SLICE

    for line in plan(rule(runs)).splitlines():
        if "Window [" in line and "windowspecdefinition(pipeline_id" in line and SLICE not in line:
            block = re.search(r"windowspecdefinition\(pipeline_id#\d+L?, _block#", line)
            assert "_cut" in line or "unboundedfollowing" in line or block


def test_lines_of_documents(spark, sf_dir):
    docs = derived.source_table(spark, sf_dir, "documents")
    lines = tables.document_lines(docs)
    assert lines.count() == docs.select(F.sum(F.size(F.split("text", "\n")))).first()[0]
