"""Columns named like those the operators use inside are passed on."""

import pytest
from pyspark.sql import functions as F

from runpulse.llm import queries as Q
from runpulse.llm.decontamination import decontaminated
from runpulse.llm.jaccard import keep_one
from runpulse.llm.license_scan import scan_licenses
from runpulse.llm.quality import keep_good, quality_scores
from runpulse.llm.token_counts import token_counts
from runpulse.llm.toxicity import keep_civil, toxicity_scores
from runpulse.llm.url_filter import judge_urls

NAMES = [
    "node", "component", "_rule", "_node", "_alias", "fit", "allow", "_id", "_text", "_lang", "_band", "_l", "_k1", "_k2", "pieces", "base", "post",
    "block", "head", "log2p", "_label", "_row", "_row_", "word", "cid", "grp", "n", "u", "v", "hash", "is_key", "other column 1", "a.b",
]


def crowded(table):
    return table.select("*", *[F.lit(f"own {c}").alias(c) for c in NAMES])


def same_names(frame, result):
    kept = result.select(*[F.col(f"`{c}`") for c in NAMES]).distinct().collect()
    assert [tuple(r) for r in kept] == [tuple(f"own {c}" for c in NAMES)]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return crowded(Q.table(spark, sf_dir, "documents")).withColumn("Score", F.lit(1))


@pytest.mark.parametrize("name", ["toxicity", "quality", "tokens", "licenses"])
def test_operators(spark, sf_dir, docs, name):
    labels = Q.table(spark, sf_dir, "labels")
    run = {
        "toxicity": lambda d: toxicity_scores(d, labels), "quality": lambda d: quality_scores(d, labels),
        "tokens": lambda d: token_counts(d, Q.tokenizer_path(Q.COUNT_FILE)), "licenses": scan_licenses,
    }[name]
    result = run(docs)
    same_names(docs, result)
    assert result.count() == docs.count()


def test_urls(spark, sf_dir):
    pages = crowded(Q.table(spark, sf_dir, "pages"))
    result = judge_urls(pages, Q.URL_RULES)
    same_names(pages, result)
    plain = judge_urls(Q.table(spark, sf_dir, "pages"), Q.URL_RULES)
    assert sorted(map(tuple, result.select("page_id", "verdict").collect())) == sorted(map(tuple, plain.select("page_id", "verdict").collect()))


@pytest.mark.parametrize("name", ["toxicity", "quality", "near_duplicates", "decontamination"])
def test_stages_keep_columns_and_names(spark, sf_dir, docs, name):
    labels = Q.table(spark, sf_dir, "labels")
    run = {
        "toxicity": lambda d: keep_civil(d, labels), "quality": lambda d: keep_good(d, labels), "near_duplicates": keep_one,
        "decontamination": lambda d: decontaminated(d, Q.table(spark, sf_dir, "benchmark")),
    }[name]
    result = run(docs)
    assert result.columns == docs.columns
    same_names(docs, result)
