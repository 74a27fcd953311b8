"""Sliced operators give what the plain windows give, with hot keys, ties and any number of slices."""

import pytest
from pyspark.sql import Window, functions as F

from runpulse.operators.percentiles import exact_percentiles
from runpulse.operators.slices import (
    CUT, SLICE, add_slices, previous_row, previous_rows, running_totals, trailing_moments,
)

HOUR = 3_600_000_000


@pytest.fixture(scope="module")
def rows(spark):
    """3,000 rows: a third has key `hot`, a third of the moments is one and the same, some values are null."""
    spread = lambda k, n: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n))
    frame = spark.range(3000).select(
        "id",
        F.when(spread(1, 3) == 0, "hot").otherwise(F.concat(F.lit("k"), spread(2, 20).cast("string"))).alias("key"),
        F.when(spread(3, 3) == 0, F.lit(50 * HOUR)).otherwise(spread(4, 100) * HOUR).alias("at"),
        F.when(spread(5, 10) > 0, spread(6, 1000) / 7.0).alias("x"),
    )
    return frame.cache()


def rounded(frame, cols):
    return sorted(
        tuple(round(v, 6) if isinstance(v, float) else v for v in row) for row in frame.select("id", *cols).collect()
    )


def test_no_group_exceeds_its_share(rows):
    sliced = add_slices(rows, ["key"], "at", "id", slices=16)
    biggest = sliced.groupBy("key", SLICE).count().agg(F.max("count")).first()[0]
    assert biggest <= 1.5 * 3000 / 16
    hot = sliced.filter("key = 'hot'")
    order = Window.orderBy("at", "id")
    assert hot.withColumn("p", F.lag(SLICE).over(order)).filter(F.col(SLICE) < F.col("p")).count() == 0
    assert hot.select(SLICE).distinct().count() > 8
    assert sliced.filter(F.col("key") != "hot").select(SLICE).distinct().collect() == [(-1,)]


@pytest.mark.parametrize("slices", [2, 7, 64])
def test_previous_rows(rows, slices):
    sliced = add_slices(rows, ["key"], "at", "id", slices=slices)
    w = Window.partitionBy("key").orderBy("at", "id")
    expected = rows.select("id", *[F.lag("id", i).over(w).alias(f"p{i}") for i in (1, 2, 3)])
    found = previous_rows(sliced, ["key"], "at", "id", ["id"], 3, "prev")
    found = found.select("id", *[F.get("prev", F.lit(i - 1))["id"].alias(f"p{i}") for i in (1, 2, 3)])
    assert sorted(found.collect(), key=str) == sorted(expected.collect(), key=str)
    one = previous_row(sliced, ["key"], "at", "id", ["id"], "prev").select("id", F.col("prev.id").alias("p1"))
    assert sorted(one.collect(), key=str) == sorted(expected.select("id", "p1").collect(), key=str)


@pytest.mark.parametrize("slices", [2, 16])
@pytest.mark.parametrize("current", [True, False])
def test_running_totals(rows, slices, current):
    w = Window.partitionBy("key").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, 0 if current else -1)
    expected = rows.withColumn("n", F.coalesce(F.sum(F.lit(1)).over(w), F.lit(0)))
    found = running_totals(add_slices(rows, ["key"], "at", "id", slices), ["key"], "at", "id", {"n": F.lit(1)}, current)
    assert rounded(found, ["n"]) == rounded(expected, ["n"])


MOMENTS = ["prior_rows", "prior_avg", "prior_stddev"]


@pytest.mark.parametrize("span", [20 * HOUR, None])
@pytest.mark.parametrize("slices", [3, 32])
def test_trailing_moments_before_the_moment(rows, span, slices):
    low = Window.unboundedPreceding if span is None else -span
    w = Window.partitionBy("key").orderBy("at").rangeBetween(low, -1)
    expected = rows.select(
        "id", F.count("*").over(w).alias("prior_rows"), F.avg("x").over(w).alias("prior_avg"),
        F.stddev_samp("x").over(w).alias("prior_stddev"),
    )
    found = trailing_moments(rows, ["key"], "at", "id", "x", span, slices=slices)
    assert rounded(found, MOMENTS) == rounded(expected, MOMENTS)


@pytest.mark.parametrize("slices", [3, 32])
def test_trailing_moments_with_ties(rows, slices):
    span = 20 * HOUR
    e = rows.select(F.col("id").alias("eid"), F.col("key").alias("ekey"), F.col("at").alias("eat"), F.col("x").alias("ex"))
    earlier = (F.col("eat") < F.col("at")) | ((F.col("eat") == F.col("at")) & (F.col("eid") < F.col("id")))
    expected = (
        rows.join(e, (F.col("key") == F.col("ekey")) & (F.col("eat") > F.col("at") - span) & earlier, "left")
        .groupBy("id")
        .agg(F.count("eid").alias("prior_rows"), F.avg("ex").alias("prior_avg"), F.stddev_samp("ex").alias("prior_stddev"))
    )
    found = trailing_moments(rows, ["key"], "at", "id", "x", span, with_ties=True, slices=slices)
    assert rounded(found, MOMENTS) == rounded(expected, MOMENTS)


def test_constant_values_have_no_spread(spark):
    flat = spark.range(50).select("id", F.lit("k").alias("key"), F.col("id").alias("at"), F.lit(100.0).alias("x"))
    found = trailing_moments(flat, ["key"], "at", "id", "x", 10).filter("prior_rows > 1")
    assert found.filter("prior_stddev <> 0 or prior_avg <> 100").count() == 0


@pytest.mark.parametrize("with_ties", [False, True])
def test_what_leaves_the_frame_is_gone(spark, with_ties):
    """Rows whose frame no longer holds the outlier, NaN or infinity have the moments of the plain frame."""
    odd = [1e6, 1e8, 1e9, 1e12, float("nan"), float("inf"), float("-inf")]
    data = [
        (k * 100 + i, f"k{k}" if k else "hot", i, odd[k % len(odd)] if i == 2 else 50 + (i * 7 % 5) / 64)
        for k in range(14) for i in range(60 if k else 900)
    ]
    data = [(n, key, at, x) for n, (_, key, at, x) in enumerate(data)]
    rows = spark.createDataFrame(data, "id bigint, key string, at bigint, x double")
    found = trailing_moments(rows, ["key"], "at", "id", "x", 10, with_ties=with_ties, slices=8).collect()
    by_key = {}
    for _, key, at, x in data:
        by_key.setdefault(key, {})[at] = x
    late = [r for r in found if r["at"] > 13]
    assert late
    for r in late:
        frame = [by_key[r.key][t] for t in range(r["at"] - 10 + with_ties, r["at"])]
        mean = sum(frame) / len(frame)
        spread = (sum((v - mean) ** 2 for v in frame) / (len(frame) - 1)) ** 0.5
        assert r.prior_rows == len(frame)
        assert abs(r.prior_avg - mean) < 1e-9 and abs(r.prior_stddev - spread) < 1e-9


def test_hot_null_key_has_its_history(spark):
    rows = spark.range(600).select(
        "id", F.when(F.col("id") % 3 > 0, F.lit("k")).alias("key"), F.col("id").alias("at"), F.lit(1.0).alias("x")
    )
    found = trailing_moments(rows, ["key"], "at", "id", "x", None, slices=8).filter("key IS NULL")
    assert sorted(r.prior_rows for r in found.collect()) == list(range(200))
    sliced = add_slices(rows, ["key"], "at", "id", slices=8)
    before = previous_row(sliced, ["key"], "at", "id", ["id"], "p").filter("key IS NULL AND p IS NULL")
    assert [r.id for r in before.collect()] == [0]


@pytest.mark.parametrize("slices", [2, 40])
def test_percentiles(rows, slices):
    found = exact_percentiles(rows, "key", "x", {"mid": 0.5, "high": 0.95}, slices)
    expected = rows.groupBy("key").agg(F.percentile("x", 0.5).alias("mid"), F.percentile("x", 0.95).alias("high"))
    tidy = lambda f: sorted((r.key, round(r.mid, 9), round(r.high, 9)) for r in f.collect())
    assert tidy(found) == tidy(expected)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "id bigint, key string, at bigint, x double")
    assert previous_row(add_slices(empty, ["key"], "at", "id"), ["key"], "at", "id", ["x"], "p").count() == 0
    assert trailing_moments(empty, ["key"], "at", "id", "x", HOUR).count() == 0
    assert exact_percentiles(empty, "key", "x", {"mid": 0.5}).count() == 0
    assert CUT in add_slices(empty, [], "at").columns


def test_partition_count_does_not_matter(spark, rows):
    seen = set()
    for n in ("1", "4", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found = trailing_moments(rows, ["key"], "at", "id", "x", 20 * HOUR)
        seen.add(tuple(rounded(found, MOMENTS)))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(seen) == 1
