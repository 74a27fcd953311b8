"""Ordered calculations per key that stay spread out when one key is hot.

`lag`, running sums and trailing frames over `Window.partitionBy(key)` put all rows of a key into one
task. That is right for most keys. A key with more than its share of the rows is cut into slices at
quantiles of its time axis, so no group (key, slice) holds more than about one slice's share of the table.
Each calculation runs inside the groups, and for hot keys a carry of one row per slice brings in what the
earlier slices contribute. The results are the same as those of the plain window. Without a hot key the
carry is empty and the plan is the plain window.

Collected are the hot keys and the cut points, both bounded by `slice_count`; rows never are.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

CUT, SLICE = "_cut", "_slice"
DAY_US = 86_400_000_000


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch of a timestamp with or without zone, as bigint."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp"))


def slice_count(spark: SparkSession) -> int:
    """Twice the shuffle partitions, so a slice is half of an average partition, and 16 at least."""
    return max(16, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))


def _hot_keys(like: DataFrame, keys: list[str], k: int) -> list:
    """Keys with more than one k-th of all rows, with their row counts: fewer than k."""
    total = like.agg(F.count("*")).scalar()
    return like.groupBy(*keys).agg(F.count("*").alias("_rows")).filter(F.col("_rows") * k > total).collect()


def add_slices(
    df: DataFrame,
    keys: list[str],
    order: str,
    tie: str | None = None,
    slices: int | None = None,
    like: DataFrame | None = None,
) -> DataFrame:
    """Add `_cut` and `_slice`: both ascending along the numeric column `order` for hot keys, -1 for others.

    A value of `order` that fills more than one slice on its own gets a cut to itself. Its rows are
    divided further along the numeric column `tie`, so `_slice` ascends along (order, tie). `like` is a
    cheaper table with the same keys, `order` and `tie` to look at, for when `df` itself costs a join.
    Without `keys` the whole table is one hot key.
    """
    like = df if like is None else like
    k = slices or slice_count(df.sparkSession)
    if keys:
        hot = _hot_keys(like, keys, k)
        if not hot:
            return df.withColumns({CUT: F.lit(-1), SLICE: F.lit(-1)})
        names = df.sparkSession.createDataFrame([tuple(r)[:-1] for r in hot], like.select(*keys).schema)
        marked = [F.col(c).alias(f"_mark_{i}") for i, c in enumerate(keys)]
        marks = F.broadcast(names.select(*marked, F.lit(True).alias("_hot")))  # fewer than k rows

        def mark(rows: DataFrame, how: str) -> DataFrame:
            """A key that is null can be hot as well, so keys are compared null-safe."""
            same = [rows[c].eqNullSafe(F.col(f"_mark_{i}")) for i, c in enumerate(keys)]
            return rows.join(marks, reduce(and_, same), how).drop(*[f"_mark_{i}" for i in range(len(keys))])

        like, df = mark(like, "inner"), mark(df, "left")
    else:
        df = df.withColumn("_hot", F.lit(True))
    accuracy = 20 * k  # a slice is at most a tenth larger than its share
    shares = [i / k for i in range(1, k)]
    cuts = like.agg(F.percentile_approx(order, shares, accuracy).alias("cuts")).first().cuts or []
    repeats = {v: n for v, n in Counter(cuts).items() if n > 1}
    points = {float(v) for v in cuts} | {math.nextafter(float(v), math.inf) for v in repeats}
    if not points:
        return df.withColumns({CUT: F.lit(-1), SLICE: F.lit(-1)}).drop("_hot")
    bucketizer = Bucketizer(
        splits=[-math.inf, *sorted(points), math.inf],
        inputCol="_order",
        outputCol=CUT,
        handleInvalid="keep",
    )
    cut = bucketizer.transform(df.withColumn("_order", F.col(order).cast("double")))
    cut = cut.withColumn(CUT, F.when(F.col("_hot"), F.col(CUT).cast("int")).otherwise(-1)).drop("_order", "_hot")
    if not (tie and repeats):
        return cut.withColumn(SLICE, F.col(CUT))
    # a table of the cuts, fewer than k numbers in all, so the plan does not grow with the number of slices
    found = list(_tie_cuts(like, order, tie, repeats, accuracy))
    kinds = f"_value {like.schema[order].dataType.simpleString()}, _ids array<{like.schema[tie].dataType.simpleString()}>"
    ties = F.broadcast(df.sparkSession.createDataFrame(found, kinds))
    cut = cut.join(ties, F.col(order) == F.col("_value"), "left")
    part = F.coalesce(F.size(F.filter("_ids", lambda i: i <= F.col(tie))), F.lit(0))
    part = F.when(F.col("_ids").isNull(), 0).otherwise(part)
    cut = cut.withColumn("_part", part).drop("_value", "_ids")
    part = F.col("_part")
    return cut.withColumn(SLICE, F.when(F.col(CUT) < 0, -1).otherwise(F.col(CUT) * F.lit(k + 1) + part)).drop("_part")


def in_hot_key() -> Column:
    return F.col(SLICE) >= 0


def _tie_cuts(like, order, tie, repeats, accuracy):
    """For each over-full value of `order`: points along `tie` that divide its rows evenly."""
    most = max(repeats.values()) + 1  # a value between n cuts fills n + 1 slices at most
    shares = [i / most for i in range(1, most)]
    found = (
        like.filter(F.col(order).isin(list(repeats)))
        .groupBy(F.col(order).alias("value"))
        .agg(F.percentile_approx(tie, shares, accuracy).alias("ids"))
        .collect()
    )
    for row in found:
        wanted = repeats[row.value] + 1
        picks = {row.ids[min(len(shares) - 1, j * most // wanted - 1)] for j in range(1, wanted)}
        yield row.value, sorted(picks)


def _with_carry(sliced: DataFrame, carry: DataFrame, group: list[str]) -> DataFrame:
    """Rows with the carry of their group; a key that is null has one as well."""
    marks = [f"_on_{i}" for i in range(len(group))]
    named = carry.withColumnsRenamed(dict(zip(group, marks)))
    same = [F.col(c).eqNullSafe(F.col(m)) for c, m in zip(group, marks)]
    return sliced.join(named, reduce(and_, same), "left").drop(*marks)


def previous_row(
    sliced: DataFrame, keys: list[str], order: str, tie: str, cols: list[str], name: str
) -> DataFrame:
    """Add struct column `name`: the `cols` of the row before of the same key, null for the first row."""
    group = [*keys, SLICE]
    item = F.struct(*cols)
    last = sliced.filter(in_hot_key()).groupBy(*group).agg(F.max_by(item, F.struct(order, tie)).alias("_last"))
    before = Window.partitionBy(*keys).orderBy(SLICE)
    carry = last.select(*group, F.lag("_last").over(before).alias("_carry"))
    inside = Window.partitionBy(*group).orderBy(order, tie)
    return (
        _with_carry(sliced, carry, group)
        .withColumn(name, F.coalesce(F.lag(item).over(inside), "_carry"))
        .drop("_carry")
    )


def previous_rows(
    sliced: DataFrame, keys: list[str], order: str, tie: str, cols: list[str], n: int, name: str
) -> DataFrame:
    """Add array column `name`: the `cols` of up to `n` earlier rows of the same key, newest first."""
    group = [*keys, SLICE]
    item = F.struct(*cols)
    newest = Window.partitionBy(*group).orderBy(F.desc(order), F.desc(tie))
    tails = (
        sliced.filter(in_hot_key())
        .select(*group, order, tie, item.alias("_item"))
        .withColumn("_n", F.row_number().over(newest))
        .filter(F.col("_n") <= n)
        .groupBy(*group)
        .agg(F.sort_array(F.collect_list(F.struct("_n", "_item"))).alias("_tail"))
    )
    # every earlier slice of a key holds at least one row, so n of them are enough
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(-n, -1)
    carry = tails.select(
        *group,
        F.slice(F.flatten(F.reverse(F.collect_list("_tail").over(before)))["_item"], 1, n).alias("_carry"),
    )
    inside = Window.partitionBy(*group).orderBy(order, tie)
    local = F.array_compact(F.array(*[F.lag(item, i).over(inside) for i in range(1, n + 1)]))
    return (
        _with_carry(sliced, carry, group)
        .withColumn(name, F.slice(F.concat(local, F.coalesce("_carry", F.array())), 1, n))
        .drop("_carry")
    )


def running_totals(
    sliced: DataFrame,
    keys: list[str],
    order: str,
    tie: str,
    sums: dict[str, Column],
    include_current: bool = True,
) -> DataFrame:
    """Add running sums per key along (order, tie), one column per entry of `sums`."""
    group = [*keys, SLICE]
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    inside = (
        Window.partitionBy(*group)
        .orderBy(order, tie)
        .rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    )
    carry = (
        sliced.filter(in_hot_key())
        .groupBy(*group)
        .agg(*[F.sum(expr).alias(f"_c_{name}") for name, expr in sums.items()])
        .select(*group, *[F.sum(f"_c_{name}").over(before).alias(f"_c_{name}") for name in sums])
    )
    joined = _with_carry(sliced, carry, group)
    added = {
        name: F.coalesce(F.col(f"_c_{name}"), F.lit(0)) + F.coalesce(F.sum(expr).over(inside), F.lit(0))
        for name, expr in sums.items()
    }
    return joined.withColumns(added).drop(*[f"_c_{name}" for name in sums])


def _merged(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    """Rows, count, mean and squared deviations of two sets of values together, by additions only."""
    rows, n = a["r"] + b["r"], a["n"] + b["n"]
    apart = (b["m"] - a["m"]) * (b["m"] - a["m"]) * a["n"] * b["n"] / n

    def pick(both: Column, name: str) -> Column:
        return F.when(b["n"] == 0, a[name]).when(a["n"] == 0, b[name]).otherwise(both)

    mean = pick((a["n"] * a["m"] + b["n"] * b["m"]) / n, "m")
    return {"r": rows, "n": n, "m": mean, "v": pick(a["v"] + b["v"] + apart, "v")}


STATE = {"r": "bigint", "n": "bigint", "m": "double", "v": "double"}


def _state(of: str) -> dict[str, Column]:
    return {c: F.coalesce(F.col(f"{of}{c}"), F.lit(0).cast(t)) for c, t in STATE.items()}


def _summary(over=None) -> list[Column]:
    """Rows, count, mean and squared deviations of `_x` where `_in` is set, of a group or a window."""
    def ranged(c: Column) -> Column:
        return c if over is None else c.over(over)

    n, x = ranged(F.count("_x")), F.col("_x").cast("double")
    return [
        F.coalesce(ranged(F.sum("_in")), F.lit(0)).cast("bigint").alias("r"),
        n.alias("n"),
        ranged(F.avg(x)).alias("m"),
        (ranged(F.var_pop(x)) * n).alias("v"),
    ]


def _moments_before(
    entries: DataFrame, spread: DataFrame, parts: list[str], name: str, by_row: bool, backwards: bool, slices: int | None
) -> DataFrame:
    """Add struct `name`: the summary of the entries of the same part that come before, along (`_at`, `_tie`) or against it.

    By row, an entry sees all before it in that order; otherwise those at an earlier moment. The slices of a hot part
    are summed up once and merged in order: one list of at most `slice_count` summaries per part.
    """
    level = SLICE if by_row else CUT
    sliced = add_slices(entries, parts, "_at", "_tie", slices, like=spread)
    kind = ", ".join(f"{c}: {t}" for c, t in STATE.items())
    empty = F.struct(*[F.lit(0).cast(t).alias(c) for c, t in STATE.items()])
    start = F.struct(empty.alias("state"), F.array().cast(f"array<struct<at: int, state: struct<{kind}>>>").alias("seen"))

    def add(acc: Column, part: Column) -> Column:
        own = {c: F.coalesce(part[c], F.lit(0).cast(t)) for c, t in STATE.items()}
        both = _merged({c: acc["state"][c] for c in STATE}, own)
        state = F.struct(*[c.cast(STATE[k]).alias(k) for k, c in both.items()])
        before = F.struct(part["at"].alias("at"), acc["state"].alias("state"))
        return F.struct(state.alias("state"), F.concat(acc["seen"], F.array(before)).alias("seen"))

    carry = (
        sliced.filter(in_hot_key())
        .groupBy(*parts, F.col(level).cast("int").alias("at"))
        .agg(*_summary())
        .groupBy(*parts)
        .agg(F.sort_array(F.collect_list(F.struct("at", *STATE)), asc=not backwards).alias("list"))
        .select(*parts, F.explode(F.aggregate("list", start, add, lambda acc: acc["seen"])).alias("of"))
        .select(*parts, F.col("of.at").alias(level), *[F.col(f"of.state.{c}").alias(f"_c{c}") for c in STATE])
    )
    order = [F.desc("_at"), F.desc("_tie")] if backwards else ["_at", "_tie"]
    inside = Window.partitionBy(*parts, SLICE)
    if by_row:
        inside = inside.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    else:
        inside = inside.orderBy(order[0]).rangeBetween(Window.unboundedPreceding, -1)
    local = sliced.select("*", F.struct(*_summary(inside)).alias("_local"))
    local = local.select("*", *[F.col(f"_local.{c}").alias(f"_l{c}") for c in STATE])
    joined = _with_carry(local, carry, [*parts, level])
    both = F.struct(*[c.alias(k) for k, c in _merged(_state("_c"), _state("_l")).items()])
    return joined.select(*entries.columns, both.alias(name))


def trailing_moments(
    df: DataFrame,
    keys: list[str],
    order: str,
    tie: str,
    value: str,
    span: int | None,
    with_ties: bool = False,
    slices: int | None = None,
    like: DataFrame | None = None,
) -> DataFrame:
    """Add `prior_rows`, `prior_avg` and `prior_stddev` of `value` over earlier rows of the same key.

    `order` is a bigint. Without ties the frame is [order - span, order): rows at the same moment do not
    see each other. With ties it is (order - span, order], where rows at the same moment count when their
    `tie` is smaller. `span` None means no lower bound.

    Time is cut into blocks as long as the span. A frame is then the first part of the row's own block and the last part of
    the block before, where the row stands as a second, narrow entry one span earlier. Both parts are running merges
    that only add, so an outlier, a NaN or an infinity is gone when it leaves the frame. A row without a moment sees none.
    """
    like = df if like is None else like
    payload = [c for c in df.columns if c not in keys]
    moment, rank = F.col(order).cast("bigint"), F.col(tie).cast("bigint")
    block = F.lit(0).cast("bigint") if span is None else moment - F.pmod(moment, F.lit(span))
    place = [*keys, block.alias("_block"), moment.alias("_at"), rank.alias("_tie")]
    parts = [*keys, "_block"]
    rows = df.select(*place, F.col(value).alias("_x"), F.lit(1).alias("_in"), F.struct(*payload).alias("_row"))
    spread = like.select(*place)
    found = _moments_before(rows, spread, parts, "_own", with_ties, False, slices)
    if span is not None:
        # going back in time, entries come after the rows of their moment if these count, else before them
        low = F.lit(-(2**62)) + F.pmod(F.xxhash64("_tie"), F.lit(2**40))
        earlier = {"_block": F.col("_block") - span, "_at": F.col("_at") - span, "_tie": -low if with_ties else low}
        asked = found.withColumns({**earlier, "_x": F.lit(None).cast(rows.schema["_x"].dataType), "_in": F.lit(0)})
        entries = rows.drop("_row").unionByName(asked, allowMissingColumns=True)
        spread = spread.unionByName(spread.withColumns(earlier))
        found = _moments_before(entries, spread, parts, "_before", True, True, slices).filter("_in = 0")
        before, own = ({c: F.col(f"{of}.{c}") for c in STATE} for of in ("_before", "_own"))
        found = found.select(*keys, "_at", "_row", F.struct(*[c.alias(k) for k, c in _merged(before, own).items()]).alias("_own"))
    known = F.col("_at").isNotNull()
    n, deviations = F.col("_own.n"), F.col("_own.v")
    return found.select(
        *keys,
        "_row.*",
        F.when(known, F.col("_own.r")).otherwise(0).cast("bigint").alias("prior_rows"),
        F.when(known & (n > 0), F.col("_own.m")).alias("prior_avg"),
        F.when(known & (n > 1), F.sqrt(deviations / (n - 1))).alias("prior_stddev"),
    )
