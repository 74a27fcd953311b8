"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from runpulse.llm.ann import nearest_neighbours
from runpulse.llm.chat_format import conversation_digests, pack_trees, read_turns
from runpulse.llm.decontamination import contained_items
from runpulse.llm.jaccard import jaccard_components
from runpulse.llm.license_scan import scan_licenses
from runpulse.llm.lm_scoring import score_documents
from runpulse.llm.packing import pack_documents
from runpulse.llm.prefix_trie import shared_openings
from runpulse.llm.quality import quality_scores
from runpulse.llm.spelling_variants import damaged_runs, variant_forms
from runpulse.llm.statements import ORACLES  # noqa: F401
from runpulse.llm.token_counts import token_counts
from runpulse.llm.toxicity import toxicity_scores
from runpulse.llm.url_filter import judge_urls

#: The rules of the URL query (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Tokenizer files of the queries that need one; `tokenizer_path` says where they are.
COUNT_FILE, PACK_FILE = "byte_bpe_50k.json", "word_bpe_49k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "lang", "n_grams", "perplexity", "threshold", "keep")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(PACK_FILE))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path(COUNT_FILE))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scanned.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.filter("vec_id % 50 = 0"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = damaged_runs(table(spark, sf_dir, "documents"))
    return variant_forms(runs.groupBy("word").agg(F.count("*").alias("n")).filter("n >= 2"))


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    tokenizer = tokenizer_path(COUNT_FILE)
    packed = pack_trees(conversations.unionByName(more), tokenizer)
    return conversation_digests(read_turns(packed, tokenizer))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_openings(table(spark, sf_dir, "conversations")).drop("node", "parent")


QUERIES = {
    f.__name__: f
    for f in (
        op1_benchmark_decontamination, op2_quality_classifier, op3_toxicity, op4_ngram_jaccard_join, op5_best_fit_packing,
        op6_url_filters, op7_token_counts, op8_lm_scoring, op9_license_scans, op10_nearest_neighbours, op11_spelling_variants,
        op12_chat_formatting, op13_conversation_trie,
    )
}
