"""The corpus pipeline: toxicity, quality, near duplicates, benchmark passages, packing.

`STAGES` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last return the columns of documents.

Nulls, empty and very long texts, ties, repeated rows, empty tables and extra columns are handled as the operators
say: a null or empty text is not toxic, is dropped by the quality stage like any text the model finds improbable where
trusted texts exist, and is a near copy of nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from runpulse.llm.decontamination import decontaminated
from runpulse.llm.jaccard import keep_one
from runpulse.llm.packing import pack_documents
from runpulse.llm.quality import keep_good
from runpulse.llm.queries import PACK_FILE, table, tokenizer_path
from runpulse.llm.toxicity import keep_civil
from runpulse.session import cut_lineage


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic."""
    return keep_civil(docs, table(spark, sf_dir, "labels"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is usual for their language and length."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces in training sequences."""
    return pack_documents(docs, tokenizer_path(PACK_FILE))


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Trained models and tokenizers are beyond SQL; the tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
