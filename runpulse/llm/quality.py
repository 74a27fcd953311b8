"""Quality by perplexity under an interpolated modified Kneser-Ney model of character trigrams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from runpulse.llm.bit_filters import shuffled_join, split_join
from runpulse.llm.columns import passing_on, unused
from runpulse.llm.postings import TermReader, document_sums, salted, term_postings
from runpulse.llm.sampling import labelled_ids, row_key
from runpulse.llm.words import pieces_of
from runpulse.session import cut_lineage

#: A text is rejected above this quantile of trusted texts of its language and length, times the slack.
QUANTILE, SLACK = 0.99, 1.1
#: Trusted texts a group must have for a threshold of its own.
ENOUGH = 50
#: Symbols before and after a text; all digits are one symbol. 21 bits hold any character.
_BEGIN, _END, _BITS = 1, 2, 21


def text_grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams of all characters of each row and its end, packed into longs, and how many each row has."""
    texts = column.fill_null("").to_pylist()
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    points[(points >= 48) & (points <= 57)] = 48
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    padded = np.full(len(points) + 3 * len(length), _BEGIN, dtype=np.int64)
    row = np.repeat(np.arange(len(length)), length)
    padded[np.arange(len(points)) + 3 * row + 2] = points
    last = np.cumsum(length + 3) - 1
    padded[last] = _END
    grams = (padded[:-2] << (2 * _BITS)) | (padded[1:-1] << _BITS) | padded[2:]
    keep = np.ones(len(grams), dtype=bool)  # trigrams that reach into the next text begin at a text's last two places
    keep[last[last < len(keep)]] = False
    keep[last[last - 1 < len(keep)] - 1] = False
    return grams[keep], length + 1


class _Grams(TermReader):
    def read(self, column):
        grams, n = text_grams(column)
        return grams, n, {"n_grams": pa.array(n, pa.int64())}


def gram_counts(texts: DataFrame) -> DataFrame:
    """(`term`, `c`): all trigrams of the texts, added up per block before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces_of(whole, "_text"):
                values, counts = np.unique(text_grams(batch.column("_text"))[0], return_counts=True)
                yield pa.record_batch({"term": pa.array(values), "c": pa.array(counts, pa.int64())})

    return texts.select("_text").mapInArrow(run, "term bigint, c bigint").groupBy("term").agg(F.sum("c").alias("c"))


def _discounted(table: DataFrame, context, total: str):
    """Counts `c` with their discounts taken off, and per context the sum and the mass set free.

    Discounts are the modified Kneser-Ney ones, from how many counts are 1, 2, 3 and 4 (these four numbers are read).
    """
    n = table.agg(*[F.count_if(F.col("c") == k).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (float(x) or 0.5 for x in n)
    y = n1 / (n1 + 2 * n2)
    d = [min(max(v, 0.1), k - 0.1) for k, v in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3))]
    off = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
    rows = table.withColumn("off", off).withColumn("context", context)
    sums = rows.groupBy("context").agg(F.sum("c").cast("double").alias(total), F.sum("off").alias("free"))
    return rows, sums


def kneser_ney(counts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(`term`, `log2p`) of the `wanted` trigrams under the model of `counts` (`term`, `c`).

    The highest order uses counts, the lower ones in how many contexts a sequence stands; each order is interpolated with
    the next lower one, the lowest with a uniform share for characters never seen.
    """
    low2, low1 = F.col("term").bitwiseAND((1 << (2 * _BITS)) - 1), F.col("term").bitwiseAND((1 << _BITS) - 1)
    context = F.shiftright("term", _BITS)
    three, of3 = _discounted(counts, context, "t3")
    two = counts.groupBy(low2.alias("term")).agg(F.count("*").alias("c"))
    two = cut_lineage(two, "bigrams")
    two_rows, of2 = _discounted(two, context, "t2")
    one = cut_lineage(two.groupBy(low1.alias("term")).agg(F.count("*").alias("c")), "unigrams")
    one_rows, of1 = _discounted(one, F.lit(0), "t1")
    t1, free1 = next(((r["t1"], r["free"]) for r in of1.collect()), (1.0, 1.0))
    spread = free1 / t1 / (one.count() + 1)
    parts = (
        wanted.select("term", low2.alias("b"), low1.alias("u"), context.alias("x"))
        .withColumn("y", F.shiftright("b", _BITS))
        .join(three.select("term", (F.col("c") - F.col("off")).alias("c3")), "term", "left")
        .join(of3.select(F.col("context").alias("x"), "t3", F.col("free").alias("f3")), "x", "left")
        .join(two_rows.select(F.col("term").alias("b"), (F.col("c") - F.col("off")).alias("c2")), "b", "left")
        .join(of2.select(F.col("context").alias("y"), "t2", F.col("free").alias("f2")), "y", "left")
        .join(one_rows.select(F.col("term").alias("u"), (F.col("c") - F.col("off")).alias("c1")), "u", "left")
    )
    zero = lambda name: F.coalesce(F.col(name), F.lit(0.0))
    p1 = zero("c1") / t1 + spread
    p2 = F.when(F.col("t2").isNull(), p1).otherwise((zero("c2") + F.col("f2") * p1) / F.col("t2"))
    p3 = F.when(F.col("t3").isNull(), p2).otherwise((zero("c3") + F.col("f3") * p2) / F.col("t3"))
    return parts.select("term", F.log2(p3).alias("log2p"))


def quality_scores(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    label: str = "quality", quantile: float = QUANTILE, slack: float = SLACK,
) -> DataFrame:
    """`docs` without its text, with `n_grams`, `bits` (per trigram), `perplexity`, `threshold` and `keep`.

    The model is trained on all texts labelled 1, whole. All distinct trigrams of all texts get
    their probability by joins of count tables, and these are joined to block postings and summed per document. A text
    is kept if its perplexity is at most `slack` times the `quantile` over all texts labelled 1 of its language and length
    (powers of four); where there are fewer than ENOUGH of them, of the nearest length that has enough, of the language,
    and failing that of all languages.
    Without any trusted text all are kept.

    A null or empty text has the end symbol as its one gram. Null languages are one language. Null ids are never
    trusted. Equal rows each give a row; columns named like the results are replaced, others passed on. An empty table
    gives no rows.
    """
    made = ["n_grams", "bits", "perplexity", "threshold", "keep"]
    run = lambda d: _scored(d, labels, doc_id, text, lang, label, quantile, slack)
    return passing_on(docs, [doc_id, text, lang], made, run)


def _scored(docs, labels, doc_id, text, lang, label, quantile, slack) -> DataFrame:
    kept = [c for c in docs.columns if c != text]
    plain = docs.select(*kept, F.col(doc_id).alias("_id"), F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    trusted = labelled_ids(labels.filter(F.col(label) == 1), label, doc_id)
    training = shuffled_join(plain.select("_id", "_text"), trusted, "_id", "left_semi")
    counts = cut_lineage(gram_counts(training), "grams")
    everywhere = cut_lineage(gram_counts(plain).withColumnRenamed("c", "times"), "vocabulary")
    values = cut_lineage(kneser_ney(counts, everywhere.select("term")).join(everywhere, "term"), "values")
    rows = term_postings(plain, "_text", _Grams, block_bytes=1 << 22)
    joined = rows.join(salted(values, "times"), ["term", "salt"], "left").select("block", "post", "head", "log2p")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.drop("_text").schema)
    scored = document_sums(joined, ["log2p"], f"{fields}, n_grams bigint, log2p double")
    scored = scored.withColumn("bits", -F.col("log2p") / F.col("n_grams")).drop("log2p")
    scored = cut_lineage(scored.withColumn("_band", F.floor(F.log2("n_grams") / 2).cast("int")), "scored")

    good = labels.filter(F.col(label) == 1).select(F.col(doc_id).alias("_id")).distinct()
    known = scored.select("_id", "_lang", "_band", "bits").join(good, "_id", "left_semi")
    cut = (F.percentile_approx("bits", F.lit(quantile), F.lit(10_000)) + F.log2(F.lit(slack))).alias("cut")
    by_band = known.groupBy("_lang", "_band").agg(cut, F.count("*").alias("n")).filter(F.col("n") >= ENOUGH)
    by_lang = known.groupBy("_lang").agg(cut, F.count("*").alias("n")).filter(F.col("n") >= ENOUGH)
    overall = known.agg(cut).first()[0]  # one number
    name = F.coalesce(F.col("_lang"), F.lit("\x00"))
    # a length without enough trusted texts takes the nearest one that has; shorter texts vary more, a bit per step
    steps = by_lang.select(name.alias("_l"), F.explode(F.sequence(F.lit(0), F.lit(31))).alias("_to"))
    near = steps.join(by_band.select(name.alias("_l"), "_band", "cut"), "_l")
    off = F.col("_band") - F.col("_to")
    by_band = near.groupBy("_l", F.col("_to").alias("_band")).agg(
        F.min_by(F.col("cut") + F.greatest(off, F.lit(0)), F.struct(F.abs(off), "_band")).alias("cut2")
    )
    by_lang = by_lang.select(name.alias("_l"), F.col("cut").alias("cut1"))
    joined = scored.withColumn("_l", name).join(by_band, ["_l", "_band"], "left").join(by_lang, "_l", "left")
    limit = F.coalesce("cut2", "cut1", F.lit(overall).cast("double"))
    return joined.select(
        *kept, "n_grams", "bits", F.pow(F.lit(2.0), "bits").alias("perplexity"),
        F.pow(F.lit(2.0), limit).alias("threshold"), (limit.isNull() | (F.col("bits") <= limit)).alias("keep"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that `quality_scores` keeps, with all their columns."""
    row = unused(docs, "_row")
    keyed = docs.withColumn(row, row_key(docs))
    bad = quality_scores(keyed, labels, **options).filter(~F.col("keep")).select(row).distinct()
    bad = cut_lineage(bad, "rejected")
    return split_join(keyed, row, bad, lambda some: some.join(bad.hint("shuffle_hash"), row, "left_anti"))
