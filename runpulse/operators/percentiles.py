"""Exact percentiles per key without holding the values of a key in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from runpulse.operators.slices import SLICE, add_slices, in_hot_key


def exact_percentiles(
    df: DataFrame, key: str, value: str, shares: dict[str, float], slices: int | None = None
) -> DataFrame:
    """One row per key with the linearly interpolated percentile for each entry of `shares`.

    `percentile` keeps every distinct value of a key in one buffer, which is right for all but hot keys.
    For those the value axis is cut into slices, a count per (key, slice) shows which slices hold the
    wanted ranks, and only those are ordered.
    """
    sliced = add_slices(df.filter(F.col(value).isNotNull()).select(key, value), [key], value, slices=slices)
    plain = (
        sliced.filter(~in_hot_key())
        .groupBy(key)
        .agg(*[F.percentile(value, share).alias(name) for name, share in shares.items()])
    )
    values = sliced.filter(in_hot_key())
    upto = Window.partitionBy(key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        values.groupBy(key, SLICE)
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
        .withColumn("_total", F.sum("_n").over(Window.partitionBy(key)))
    )
    ranks = {}
    for name, share in shares.items():
        position = F.lit(share) * (F.col("_total") - 1)
        ranks[name] = (position, F.floor(position), F.ceil(position))
    end = F.col("_before") + F.col("_n")
    holds = F.lit(False)
    for _, low, high in ranks.values():
        for rank in (low, high):
            holds = holds | ((rank >= F.col("_before")) & (rank < end))
    wanted = counts.filter(holds).select(key, SLICE, "_before", "_total")
    inside = Window.partitionBy(key, SLICE).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        values.join(wanted, [key, SLICE])
        .groupBy(key, SLICE, "_before", "_total", value)
        .agg(F.count("*").alias("_copies"))
        .withColumn("_upto", F.col("_before") + F.sum("_copies").over(inside))
    )
    found = ranked.groupBy(key, "_total").agg(
        *[
            F.min(F.when(F.col("_upto") > rank, F.col(value))).alias(f"_{name}_{side}")
            for name, (_, low, high) in ranks.items()
            for side, rank in (("low", low), ("high", high))
        ]
    )
    hot = found.select(
        key,
        *[
            (
                F.col(f"_{name}_low")
                + (position - low) * (F.col(f"_{name}_high") - F.col(f"_{name}_low"))
            ).alias(name)
            for name, (position, low, _) in ranks.items()
        ],
    )
    return plain.unionByName(hot)
