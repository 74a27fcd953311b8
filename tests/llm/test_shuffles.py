"""Texts that a join has no use for are not shuffled, and what is joined stays the same."""

import pytest

from runpulse.llm.bit_filters import shuffled_join
from runpulse.llm.jaccard import keep_one
from runpulse.llm.quality import keep_good


def _texts_shuffled(df):
    """Rows written by the exchanges of a collected frame that carry a column named text."""

    def walk(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if name == "ShuffleQueryStageExec":
            return walk(plan.plan())
        own = 0
        if name == "ShuffleExchangeExec" and "text#" in plan.output().mkString(","):
            own = plan.metrics().apply("shuffleRecordsWritten").value()
        return own + sum(walk(plan.children().apply(i)) for i in range(plan.children().size()))

    return walk(df._jdf.queryExecution().executedPlan())


@pytest.fixture
def plain_joins(spark):
    """No broadcast joins, as between large tables."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("kinds", [("long", "long"), ("int", "long"), ("string", "string"), ("double", "double")])
@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_the_join_gives_what_a_plain_one_gives(spark, kinds, how):
    values = [None, 0, 0, 1, 5, 5, 7, 99]
    rows = spark.createDataFrame([(v, f"t{i}") for i, v in enumerate(values)], "k long, text string")
    keys = spark.createDataFrame([(0,), (5,), (42,), (None,)], "k long")
    rows, keys = (d.withColumn("k", d.k.cast(kind) * (-1 if kind == "double" else 1) if kind != "string" else d.k.cast(kind)) for d, kind in zip((rows, keys), kinds))
    if kinds[0] == "double":  # -0.0 on one side, 0.0 on the other
        keys = keys.withColumn("k", keys.k + 0.0)
    got, plain = shuffled_join(rows, keys, "k", how), rows.join(keys, "k", how)
    assert sorted(got.collect()) == sorted(plain.collect()) and len(got.collect()) == 4


def test_only_texts_with_a_key_are_shuffled(spark):
    rows = spark.range(1000).selectExpr("id AS k", "concat('text ', id) AS text")
    got = shuffled_join(rows, spark.createDataFrame([(3,), (5,)], "k long"), "k", "inner")
    assert {r.text for r in got.collect()} == {"text 3", "text 5"}
    assert _texts_shuffled(got) <= 4


def test_only_texts_in_doubt_are_shuffled_when_one_is_kept(spark, plain_joins, fresh):
    rows = [(i, f"a{i} b{i} c{i} d{i} e{i} f{i}", "en") for i in range(300)]
    rows = [(None, None, None), (None, None, None), (901, "", "en"), *rows, rows[7], rows[7], (900, rows[8][1], "en")]
    path = fresh() + "/docs"
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(path)
    got = keep_one(spark.read.parquet(path))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted({str(r) for r in rows if r[0] != 900})
    assert _texts_shuffled(got) < 30


def test_only_texts_in_doubt_are_shuffled_when_bad_ones_go(spark, plain_joins, fresh):
    rows = [(i, f"ab{i % 7} cd{i % 11} ef", "en") for i in range(300)] + [(7, "ab0 cd7 ef", "en"), (900, "щщщ ъъъъ", "en"), (900, "щщщ ъъъъ", "en")]
    path = fresh() + "/docs"
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(path)
    labels = spark.createDataFrame([(i, 1) for i in range(250)], "doc_id long, quality int")
    got = keep_good(spark.read.parquet(path), labels)
    assert sorted(map(tuple, got.collect())) == sorted(r for r in rows if r[0] != 900)
    assert _texts_shuffled(got) < 30
