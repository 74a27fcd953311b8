"""Classification of error texts by rules in a table: any number of them, changed without changing code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from runpulse.functions.text import error_class
from runpulse.operators.baselines import is_state
from runpulse.operators.diagnosis import DEFAULT_RULE, ERROR_RULES
from runpulse.operators.joins import salted_join
from runpulse.session import cut_lineage

#: Letters of an index entry.
GRAM = 3
RULE_SCHEMA = "priority int, pattern string, needs array<string>, category string, severity string"
# Per classification rule, in its order, literals one of which every text that it matches holds (in lower case).
RULE_NEEDS = (
    ("memory", "heap space"),
    ("connection slots", "too many connections"),
    ("permission", "access denied", "forbidden"),
    ("no such file", "not found"),
    ("connect", "refused", "unreachable"),
    ("time",),
    ("import", "syntax", "type"),
)


def rule_rows(spark: SparkSession) -> DataFrame:
    """The classification rules as a table."""
    rows = [(at, rule[0], list(needs), *rule[1:]) for at, (rule, needs) in enumerate(zip(ERROR_RULES, RULE_NEEDS))]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def _grams(text: Column) -> Column:
    """The different stretches of GRAM letters of a text, and the empty one, under which rules for any text are listed."""
    places = F.sequence(F.lit(1), F.greatest(F.length(text) - (GRAM - 1), F.lit(1)))
    return F.array_union(F.array(F.lit("")), F.transform(places, lambda i: F.substr(text, i, F.lit(GRAM))))


def classified_by_table(runs: DataFrame, rules: DataFrame, default: tuple[str, str] = DEFAULT_RULE) -> DataFrame:
    """Failed runs with error class, and category and severity of the matching rule of lowest `priority`, else `default`.

    `rules` has one row per priority: a Java regular expression, and in `needs` lower-case literals one of which every text
    that it matches holds in any case; a rule without them (null, empty, or a literal of fewer than GRAM letters) is tried on every
    text. Only different texts are looked at. They meet the rules through an index of each literal's first letters, so a text is
    tried against the rules that can match it, and the result goes back to the runs by the text's md5, the many runs of
    one text dealt over several tasks. A null message is an empty text. A null pattern matches nothing.
    """
    failed = runs.filter(is_state("failed")).select(
        "id", "pipeline_id", "error_message", F.coalesce("error_message", F.lit("")).alias("message")
    )
    failed = failed.withColumn("fingerprint", F.md5("message"))
    texts = cut_lineage(failed.select("fingerprint", "message").distinct(), "messages")
    anything = F.size(F.filter(F.coalesce("needs", F.array()), lambda n: F.length(n) >= GRAM)) < F.size(F.coalesce("needs", F.array()))
    listed = F.when(F.coalesce(F.size("needs") <= 0, F.lit(True)) | anything, F.array(F.lit(""))).otherwise(F.col("needs"))
    index = rules.select("priority", F.explode(F.transform(listed, lambda n: F.substring(n, 1, GRAM))).alias("gram")).distinct()
    grams = texts.select("fingerprint", F.explode(_grams(F.lower("message"))).alias("gram"))
    tried = grams.join(index, "gram").select("fingerprint", "priority").distinct()
    hits = (
        tried.join(texts, "fingerprint")
        .join(rules.select("priority", "pattern", "category", "severity"), "priority")
        .filter(F.rlike("message", F.col("pattern")))
    )
    first = hits.groupBy("fingerprint").agg(F.min_by(F.struct("category", "severity"), "priority").alias("rule"))
    named = salted_join(failed, first, ["fingerprint"], "id", "left")
    category, severity = default
    return named.select(
        "id", "pipeline_id", error_class("error_message").alias("error_type"),
        F.when(F.col("rule").isNull(), category).otherwise(F.col("rule.category")).alias("category"),
        F.when(F.col("rule").isNull(), severity).otherwise(F.col("rule.severity")).alias("severity"),
    )
