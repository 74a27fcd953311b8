"""Word count and log tails."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def word_count(texts: DataFrame, column: str = "text") -> DataFrame:
    """Occurrences of every word; words are what stands between single spaces, empty ones are dropped."""
    return (
        texts.select(F.explode(F.split(column, " ")).alias("word"))
        .filter(F.col("word") != "")
        .groupBy("word")
        .agg(F.count("*").alias("occurrences"))
    )


def log_tail(lines: DataFrame, last: int = 100) -> DataFrame:
    """The last `last` lines of every task."""
    newest = Window.partitionBy("task").orderBy(F.desc("line_no"))
    return lines.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= last).drop("_n")


def text_tail(text: str, last: int = 100):
    """Column: the last `last` lines of a text that holds a whole log."""
    lines = F.split(text, "\n")
    return F.array_join(F.slice(lines, F.greatest(F.size(lines) - last + 1, F.lit(1)), F.lit(last)), "\n")
