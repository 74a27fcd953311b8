"""Labelled rows and folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from runpulse.llm.columns import column


def in_fold(doc_id: Column, remainder: int, folds: int = 5) -> Column:
    """Whether crc32 of the id as text leaves `remainder`; a null id is in no fold."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == remainder, F.lit(False))


def row_key(df: DataFrame) -> Column:
    """A hash of all columns that names a row; equal rows share it."""
    return F.xxhash64(*[F.struct(column(c)) for c in df.columns])


def labelled_ids(labels: DataFrame, label: str, doc_id: str = "doc_id") -> DataFrame:
    """(`_id`, `_label`) of all labelled ids.

    An id labelled more than once counts as 1 if any label is 1; null ids and labels are left out.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    return known.groupBy(F.col(doc_id).alias("_id")).agg(F.max((F.col(label) == 1).cast("int")).alias("_label"))
