"""Toxicity of texts after their disguised words have been restored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from runpulse.llm.bit_filters import shuffled_join
from runpulse.llm.columns import column, passing_on, unused
from runpulse.llm.deobfuscation import Decoder, restored_rows, symbol_counts, symbol_model
from runpulse.llm.sampling import in_fold, labelled_ids
from runpulse.llm.words import _LOWER, column_bytes, mix, per_row, pieces_of, signed, span_hashes
from runpulse.session import cut_lineage, discard

#: A word is used from this many different surroundings in toxic texts and standard deviations above chance.
LEAST, SURE, HEAVY = 5, 6.0, 2
#: One part in so many of the surroundings in other texts shows which words cannot have a weight.
PARTS = 4

_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[48:58] = _INSIDE[97:123] = True
_INSIDE[128:] = True


def _plain_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of letters, digits and characters beyond ASCII, A-Z lower-cased, and how many each row has."""
    data, offsets = column_bytes(column)
    data = _LOWER[data]
    inside = _INSIDE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:-1]
    end[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(start)
    return span_hashes(data, starts, np.flatnonzero(end) + 1), per_row(starts, offsets)


def _both(texts: pa.Array, extra: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words of each row as they stand, followed by those of its restored stretches, and how many each row has."""
    words, n = _plain_words(texts)
    more, m = _plain_words(extra)
    row = np.concatenate([np.repeat(np.arange(len(n)), n), np.repeat(np.arange(len(m)), m)])
    order = np.argsort(row, kind="stable")
    return np.concatenate([words, more])[order], n + m


def _restored(texts: pa.Array, decoder: Decoder) -> pa.Array:
    return pa.array(restored_rows(*column_bytes(texts), decoder), pa.string())


def text_words(column: pa.Array, decoder: Decoder) -> tuple[np.ndarray, np.ndarray]:
    texts = column.fill_null("")
    return _both(texts, _restored(texts, decoder))


def _places(texts: DataFrame, wanted: np.ndarray | None = None) -> DataFrame:
    """Rows (`word`, `around`, `label`) of the `texts` of `_learn`.

    Only the `wanted` words, or else all of toxic texts and of others those whose hash falls into one of PARTS.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces_of(whole, "_text"):
                words, n = _both(batch.column("_text"), batch.column("extra"))
                some, ends = n > 0, np.cumsum(n)
                left, right = np.zeros(len(words), dtype=np.uint64), np.zeros(len(words), dtype=np.uint64)
                left[1:], right[:-1] = mix(words[:-1]), words[1:]
                left[(ends - n)[some]] = batch.column("left").to_numpy().view(np.uint64)[some]
                right[ends[some] - 1] = batch.column("right").to_numpy().view(np.uint64)[some]
                around, label = left ^ right, np.repeat(batch.column("label").to_numpy(), n)
                if wanted is None:
                    keep = (label == 1) | (mix(words + around) % np.uint64(PARTS) == 0)
                else:
                    keep = wanted[np.minimum(np.searchsorted(wanted, words), len(wanted) - 1)] == words
                columns = {"word": signed(words[keep]), "around": signed(around[keep]), "label": label[keep]}
                yield pa.record_batch({k: pa.array(v) for k, v in columns.items()})

    return texts.mapInArrow(run, "word bigint, around bigint, label int")


def _heavy(places: DataFrame, share: float) -> DataFrame:
    """(`word`, `w`) of the words that are far more frequent in toxic texts, by their different surroundings."""
    alone = places.groupBy("word", "around").agg(F.max("label").alias("label"))
    toxic = F.sum("label")
    counts = alone.groupBy("word").agg(toxic.alias("n1"), (F.count("*") - toxic).alias("n0")).filter(F.col("n1") >= LEAST)
    n = F.col("n1") + F.col("n0")
    z = (F.col("n1") - n * share) / F.sqrt(n * (share * (1 - share)))
    weight = F.log((F.col("n1") + 0.5) / (F.col("n0") + 0.5)) - float(np.log(share / (1 - share)))
    return counts.select("word", z.alias("z"), weight.alias("w")).filter((F.col("z") >= SURE) & (F.col("w") >= HEAVY)).drop("z")


def _learn(labelled: DataFrame, decoding) -> tuple[np.ndarray, np.ndarray, tuple[float, float]]:
    """Sorted word hashes, their weights, and slope and offset of the score, from all `labelled` texts.

    A word counts once for each different pair of neighbours, so copies of one text don't make its words suspect. The texts are
    decoded once and stored. Surroundings of all words of all texts would be too many to shuffle: those in toxic texts and a
    PARTS-th of the others come first. Further ones in other texts only lower a word's weight, so words that are out by then
    are out for good, and all surroundings are counted for the rest. The weights are therefore those of a count of everything.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(decoding.value)
        for whole in batches:
            for batch in pieces_of(whole, "_text"):
                texts = batch.column("_text").fill_null("")
                extra = _restored(texts, decoder)
                words, n = _both(texts, extra)
                # the words beside a text in its piece are part of the surroundings of its first and last word
                some, ends = n > 0, np.cumsum(n)
                left, right = np.zeros(len(n), dtype=np.uint64), np.zeros(len(n), dtype=np.uint64)
                left[some] = np.concatenate([np.zeros(1, np.uint64), mix(words)])[(ends - n)[some]]
                right[some] = np.concatenate([words, np.zeros(1, np.uint64)])[ends[some]]
                columns = {"label": batch.column("_label"), "_text": texts, "extra": extra}
                yield pa.record_batch({**columns, "left": pa.array(signed(left)), "right": pa.array(signed(right))})

    fields = "label int, _text string, extra string, left bigint, right bigint"
    texts = cut_lineage(labelled.mapInArrow(run, fields), "labelled-texts")
    share = texts.agg(F.avg("label")).first()[0] or 0.0
    if not 0 < share < 1:
        return np.zeros(0, np.uint64), np.zeros(0), (0.0, -30.0 if share == 0 else 30.0)
    maybe = np.sort(np.array([r["word"] for r in _heavy(_places(texts), share).collect()], dtype=np.int64).view(np.uint64))
    top = _heavy(_places(texts, maybe), share).collect() if len(maybe) else []  # like `maybe` the few words that mark toxic texts
    words = np.array([r["word"] for r in top], dtype=np.int64).view(np.uint64)
    order = np.argsort(words)
    words, weights = words[order], np.array([r["w"] for r in top])[order]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces_of(whole, "_text"):
                x = _evidence(*_both(batch.column("_text"), batch.column("extra")), words, weights)
                yield pa.record_batch({"x": pa.array(np.round(x, 3)), "y": batch.column("label")})

    # as many rows as there are sums with three decimals, not as there are texts
    points = texts.mapInArrow(sums, "x double, y int").groupBy("x", "y").agg(F.count("*").alias("times")).collect()
    discard(texts)
    x, y, times = (np.array([p[c] for p in points], dtype=np.float64) for c in ("x", "y", "times"))
    return words, weights, _logistic(x, y, times)


def _logistic(x: np.ndarray, y: np.ndarray, times: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through points that count `times`, by Newton steps with a small ridge."""
    a, b = 0.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = times * (p * (1 - p) + 1e-9)
        off = times * (y - p)
        g = np.array([(off * x).sum() - 1e-3 * a, off.sum() - 1e-3 * b])
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-3]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def _evidence(found: np.ndarray, n: np.ndarray, words: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The square root of the summed weights of the different known words of each row, from the rows' words."""
    if not len(words) or not len(found):
        return np.zeros(len(n))
    at = np.minimum(np.searchsorted(words, found), len(words) - 1)
    hit = np.flatnonzero(words[at] == found)
    row = np.repeat(np.arange(len(n)), n)[hit]
    pairs = np.unique(np.stack([row, at[hit]]), axis=1)
    return np.sqrt(np.bincount(pairs[0], weights[pairs[1]], minlength=len(n)))


def evidence(column: pa.Array, decoder: Decoder, words: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return _evidence(*text_words(column, decoder), words, weights)


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    fold: int = 0, folds: int = 5, keep_text: bool = False,
) -> DataFrame:
    """`docs` with `held_out`, `score` (0 to 1) and `predicted` (1 from 0.5 on), without its text unless wanted.

    A character trigram model is counted over all texts. Disguised words (signs for letters, separators, repeated
    letters) are decoded under it and read beside the words as they stand. Word weights come from all
    labelled texts that are not held out (ids whose crc32 leaves `fold`): a word has one if it stands in at least LEAST
    different surroundings in toxic ones and SURE standard deviations above its share; so where few texts are labelled, few
    words are known. The score is a logistic curve of the weights. Texts are read whole, piece by piece if they are very long. Labels, languages, sources and ids are no inputs of a score.

    A null or empty text has the score of a text without known words. Null ids are not held out and never labelled;
    repeated labels count as 1 if one is 1. Equal rows each give a row; columns named like the results are replaced.
    Empty tables give no rows; without any label the score is 0.
    """
    run = lambda d: _scored(d, labels, doc_id, text, label, fold, folds, keep_text)
    return passing_on(docs, [doc_id, text], ["held_out", "score", "predicted"], run)


def _scored(docs, labels, doc_id, text, label, fold, folds, keep_text) -> DataFrame:
    kept = [c for c in docs.columns if keep_text or c != text]
    plain = docs.select(*kept, F.col(doc_id).alias("_id"), F.col(text).alias("_text"), in_fold(F.col(doc_id), fold, folds).alias("held_out"))
    context = docs.sparkSession.sparkContext
    decoding = context.broadcast(symbol_model(symbol_counts(plain)))  # SYMBOLS ** 3 numbers
    learned = labelled_ids(labels.filter(~in_fold(F.col(doc_id), fold, folds)), label, doc_id)
    texts = plain.filter(~F.col("held_out")).select("_id", "_text")
    known = shuffled_join(texts, learned, "_id", "inner").select("_text", "_label")
    model = context.broadcast(_learn(known, decoding))  # words that mark toxic texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(decoding.value)
        words, weights, (slope, offset) = model.value
        for whole in batches:
            for batch in pieces_of(whole, "_text"):
                x = slope * evidence(batch.column("_text"), decoder, words, weights) + offset
                score = 1 / (1 + np.exp(-np.clip(x, -30, 30)))
                out = batch.drop_columns(["_text", "_id"]).append_column("score", pa.array(score))
                yield out.append_column("predicted", pa.array((score >= 0.5).astype(np.int32)))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.drop("_text", "_id").schema)
    return plain.mapInArrow(run, f"{fields}, score double, predicted int")


def keep_civil(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents not predicted toxic, with all their columns."""
    named = {c: unused(docs, f"_own_{c}") for c in docs.columns if c.lower() in ("held_out", "score", "predicted")}
    scored = toxicity_scores(docs.withColumnsRenamed(named), labels, keep_text=True, **options)
    good = scored.filter("predicted = 0").drop("held_out", "score", "predicted")
    return good.withColumnsRenamed({v: k for k, v in named.items()}).select(*[column(c) for c in docs.columns])
