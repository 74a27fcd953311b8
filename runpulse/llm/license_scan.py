"""License phrases and notices in texts by diagonal voting. SQL only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from runpulse.llm.columns import passing_on
from runpulse.operators.joins import salted_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words are runs of digits, ASCII letters and characters beyond ASCII.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases whose places are counted, with their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
#: Usual wordings of notices, with their labels; at most 63 words each.
NOTICES = [
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is "
     "distributed on an as is basis without warranties or conditions of any kind", "apache-2.0"),
    ("licensed under gnu general public license version 3", "gpl-3.0"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license", "gpl-grant"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("released under the mit license", "mit-notice"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files", "mit-grant"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that "
     "the following conditions are met", "bsd-grant"),
]
#: Diagonals this near are one span (words put in or left out), and the share of a notice that must be found if it has several edits.
NEAR, SHARE = 2, 0.85


def license_words(text: Column) -> Column:
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(low, BETWEEN), lambda w: w != "")


def _templates(phrases, notices) -> list[tuple]:
    """One row per pair of neighbouring words of a template: its words, place, template size, label, first and last word."""
    rows = []
    for number, (kind, text, label) in enumerate([(True, *p) for p in phrases] + [(False, *n) for n in notices]):
        words = text.split()
        if not 2 <= len(words) <= 63:
            raise ValueError(f"a template has 2 to 63 words: {text}")
        ends = words[0], words[-1]
        rows += [(number, kind, label, len(words) - 1, k, *words[k : k + 2], *ends) for k in range(len(words) - 1)]
    return rows


_TEMPLATE = "template int, base boolean, label string, size int, place int, t1 string, t2 string, first string, last string"
#: Where only one side of an edit has pairs, the word beyond it must stand: next but one before or after a pair (a word put in), or next to it.
_ENDS = """CASE WHEN place = 1 AND before2 = first THEN 1 ELSE 0 END | CASE WHEN place = 2 AND before1 = first THEN 2 ELSE 0 END
    | CASE WHEN place = size - 2 AND after2 = last THEN 4 ELSE 0 END | CASE WHEN place = size - 3 AND after1 = last THEN 8 ELSE 0 END"""
#: A notice with one edit: its beginning on a diagonal and the rest on the next one (a word put in) or the one before (a word left out).
_VARIED = """filter(array(
    CASE WHEN d0 = diagonal - 1 AND head0 >= 1 AND tail >= 1 AND head0 + tail >= size - 1 THEN struct(d0 AS start, (size - 1) / size AS score) END,
    CASE WHEN d0 = diagonal - 1 AND head >= 1 AND tail0 >= 1 AND head + tail0 >= size - 2 THEN struct(diagonal AS start, (size - 2) / size AS score) END,
    CASE WHEN ends & 1 > 0 AND tail >= size - 1 THEN struct(diagonal - 1 AS start, (size - 1) / size AS score) END,
    CASE WHEN ends & 2 > 0 AND tail >= size - 2 THEN struct(diagonal + 1 AS start, (size - 2) / size AS score) END,
    CASE WHEN ends & 4 > 0 AND head >= size - 1 THEN struct(diagonal AS start, (size - 1) / size AS score) END,
    CASE WHEN ends & 8 > 0 AND head >= size - 2 THEN struct(diagonal AS start, (size - 2) / size AS score) END
), x -> x IS NOT NULL)"""


def license_spans(texts: DataFrame, keys: list[str], text: str, phrases=PHRASES, notices=NOTICES, share: float = SHARE) -> DataFrame:
    """Verified spans: `keys`, `label`, `base`, `start` (first word) and `score` (the share of the template found).

    Every pair of neighbouring words of every text is hashed and joined to the template places with that hash,
    and to their words; pairs with a word that no template has there are left out before. Each match votes for the diagonal
    text place minus template place. Diagonals of a notice at most NEAR apart are merged. A span stands if all of
    a phrase, or at least `share` of a notice's pairs, is found, or if a notice stands with exactly one word put in or
    left out, whichever inner word: then its beginning is on one diagonal, the rest on the neighbouring one, and both
    ends are verified. Where one notice stands whole, another that starts at the same word with an edit does not ("cc by nc 4 0"
    is no "cc by 4 0"). A replaced word is no such edit. The templates are a fixed short list, so they are
    broadcast. Texts that are equal in `keys` count once.
    """
    rows = _templates(phrases, notices)
    firsts, seconds = (sorted({r[i] for r in rows}) for i in (5, 6))
    templates = texts.sparkSession.createDataFrame(rows, _TEMPLATE).withColumn("gram", F.xxhash64("t1", "t2"))
    words = texts.select(*keys, license_words(F.col(text)).alias("w"))
    word = lambda i: F.get("w", i)
    spots = F.when(F.size("w") >= 2, F.sequence(F.lit(0), F.size("w") - 2))
    hits = F.filter(spots, lambda i: word(i).isin(firsts) & word(i + 1).isin(seconds))
    around = {"a": 0, "b": 1, "before2": -2, "before1": -1, "after1": 2, "after2": 3}
    pairs = F.transform(hits, lambda i: F.struct(i.alias("at"), *[word(i + k).alias(name) for name, k in around.items()]))
    grams = words.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.*").withColumn("gram", F.xxhash64("a", "b"))
    found = grams.join(F.broadcast(templates), "gram").filter("a = t1 AND b = t2")
    votes = found.groupBy(*keys, "template", "base", "label", "size", (F.col("at") - F.col("place")).alias("diagonal")).agg(
        F.expr("bit_or(shiftleft(1L, place))").alias("places"),
        F.expr("bit_or(shiftleft(1L, size - 1 - place))").alias("mirrored"),
        F.expr(f"bit_or({_ENDS})").alias("ends"),
    )
    # pairs found without a gap from the first one on, and back from the last one
    votes = votes.withColumns({"head": F.expr("bit_count(places & ~(places + 1L))"), "tail": F.expr("bit_count(mirrored & ~(mirrored + 1L))")})
    order = Window.partitionBy(*keys, "template").orderBy("diagonal")
    before = votes.withColumns({new: F.lag(old).over(order) for new, old in (("d0", "diagonal"), ("head0", "head"), ("tail0", "tail"))})
    fresh = F.when(F.col("diagonal") - F.col("d0") <= NEAR, 0).otherwise(1)
    spans = (
        before.withColumn("span", F.sum(fresh).over(order))
        .groupBy(*keys, "template", "base", "label", "size", "span")
        .agg(
            F.expr("bit_count(bit_or(places)) / size").alias("score"),
            F.min("diagonal").alias("start"),
            F.expr("collect_list(CASE WHEN bit_count(places) = size THEN diagonal END)").alias("whole"),
            F.flatten(F.collect_list(F.expr(_VARIED))).alias("varied"),
        )
    )
    whole = F.transform("whole", lambda d: F.struct(d.alias("start"), F.lit(1.0).alias("score")))
    merged = F.when(F.col("score") >= share, F.array(F.struct("start", "score")))
    notice = F.when(F.size("whole") > 0, whole).otherwise(F.coalesce(merged, F.filter("varied", lambda x: x["score"] < share)))
    placed = spans.select(*keys, "label", "base", F.explode(F.when(F.col("base"), whole).otherwise(notice)).alias("x"))
    same = Window.partitionBy(*keys, "start")
    beaten = F.max(F.col("score") == F.when(F.col("base"), F.lit(None)).otherwise(F.lit(1.0))).over(same)
    placed = placed.select(*keys, "label", "base", "x.start", "x.score").withColumn("beaten", F.coalesce(beaten, F.lit(False)))
    return placed.filter((F.col("score") >= share) | ~F.col("beaten")).drop("beaten")


def scan_licenses(docs: DataFrame, text: str = "text", phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """`docs` without its text, with `n_words`, `n_base`, `first_word`, `last_word`, `base_labels`, `labels`, `score`.

    `n_base` counts all places of the phrases, `first_word` and `last_word` are the smallest and largest of their
    first words (null without any); `labels` also has those of the notices; `score` is the largest share of a
    template found, else 0. Null and empty texts have no words and no labels (empty
    strings). Equal texts are scanned as one group and each keeps its row, other columns are passed on, and
    columns named like the results are replaced. An empty table gives no rows.
    """
    made = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    return passing_on(docs, [text], made, lambda d: _scanned(d, text, phrases, notices))


def _scanned(docs, text, phrases, notices) -> DataFrame:
    kept = [c for c in docs.columns if c != text]
    content = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(*kept, content.alias("_text"), F.xxhash64(content).alias("_k1"), F.hash(content, F.lit(7)).alias("_k2"))
    spans = license_spans(keyed.select("_k1", "_k2", "_text"), ["_k1", "_k2"], "_text", phrases, notices)
    base = F.when(F.col("base"), F.col("start"))
    join = lambda c: F.array_join(F.array_sort(c), ",")
    per_text = spans.groupBy("_k1", "_k2").agg(
        F.count(base).alias("n_base"),
        F.min(base).cast("bigint").alias("first_word"),
        F.max(base).cast("bigint").alias("last_word"),
        join(F.collect_set(F.when(F.col("base"), F.col("label")))).alias("base_labels"),
        join(F.collect_set("label")).alias("labels"),
        F.max("score").alias("score"),
    )
    hashed = [c for c in kept if "map<" not in docs.schema[c].dataType.simpleString()]
    rows = keyed.select(*kept, "_k1", "_k2", F.xxhash64(F.lit(0), *hashed).alias("_r"), F.size(license_words(F.col("_text"))).cast("bigint").alias("n_words"))
    joined = salted_join(rows, per_text, ["_k1", "_k2"], "_r", "left")  # a text may have any number of copies
    return joined.select(
        *kept, "n_words", F.coalesce("n_base", F.lit(0).cast("bigint")).alias("n_base"), "first_word", "last_word",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("base_labels", "labels")],
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
