"""Spelling variants in a vocabulary: words one code point apart, by a reduced alphabet.

1. Every letter is hashed to one of a few symbols, so a word becomes a reduced word. An edit of a word is an edit of its
   reduced word, or none where a letter is replaced by one of the same symbol.
2. The full one-edit neighbourhood of each distinct reduced word is generated, each pair of neighbours from one side: a
   deletion from the longer word (for the shorter one it is the insertion), a replacement from the smaller symbol.
3. The neighbourhood is joined with the reduced vocabulary. Only pairs of reduced words that both exist stay.
4. The words of both sides of a pair are compared as they are written.

The number of symbols follows the vocabulary: as many as give reduced words of ROOM letters more room than there are
words, so a reduced word stands for a bounded number of words at any size. The result is the same with any number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from runpulse.llm.words import mix, signed
from runpulse.session import cut_lineage, discard

#: Letters of a reduced word that the symbols must tell apart, and the least number of symbols.
ROOM, LEAST_SYMBOLS = 8, 4
#: Code points that are reduced at once.
STEP = 1 << 18

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LENGTH = np.uint64(0xD6E8FEB86659FD93)


def symbol_count(words: int) -> int:
    return max(LEAST_SYMBOLS, int(np.ceil(max(words, 1) ** (1 / ROOM))))


def _code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words, and where each word begins (one more at the end)."""
    words = column.to_pylist()
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return points, np.r_[0, np.cumsum([len(w) for w in words], dtype=np.int64)]


def _powers(count: int) -> tuple[np.ndarray, np.uint64]:
    up = np.full(count, _BASE, dtype=np.uint64)
    up[:1] = 1
    return np.multiply.accumulate(up, dtype=np.uint64), np.uint64(_INVERSE)


class Reduced:
    """The reduced words of a batch, each named by a 64-bit hash that follows single edits."""

    def __init__(self, column: pa.Array, symbols: int):
        points, self.edges = _code_points(column)
        self.symbols = symbols
        self.symbol = (mix(points.astype(np.uint64) + np.uint64(1)) >> np.uint64(40)) % np.uint64(symbols)
        self.n = np.diff(self.edges)
        self.row = np.repeat(np.arange(len(self.n)), self.n)
        self.place = np.arange(len(points)) - self.edges[:-1][self.row]
        self.up, self.down = _powers(int(self.n.max(initial=0)) + 1)
        self.terms = self._value(self.symbol) * self.up[self.place]
        self.sums = np.zeros(len(points) + 1, dtype=np.uint64)
        np.cumsum(self.terms, out=self.sums[1:])
        self.whole = self.sums[self.edges[1:]] - self.sums[self.edges[:-1]]

    @staticmethod
    def _value(symbol: np.ndarray) -> np.ndarray:
        return mix(symbol + np.uint64(0x51ED2701))

    @staticmethod
    def _name(value: np.ndarray, n: np.ndarray) -> np.ndarray:
        return mix(value + n.astype(np.uint64) * _LENGTH)

    def names(self) -> np.ndarray:
        return self._name(self.whole, self.n)

    def neighbours(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, name): itself, one symbol left out (once for a run of equal ones), one replaced by a larger one."""
        yield np.arange(len(self.n)), self.names()
        if not len(self.row):
            return
        begin, end = self.sums[self.edges[:-1]][self.row], self.sums[self.edges[1:]][self.row]
        at = np.arange(len(self.row))
        last = np.r_[(self.symbol[1:] != self.symbol[:-1]) | (self.row[1:] != self.row[:-1]), True]
        short = (self.sums[at] - begin) + (end - self.sums[at + 1]) * self.down
        yield self.row[last], self._name(short, self.n[self.row] - 1)[last]
        for other in range(1, self.symbols):
            smaller = self.symbol < other
            row = self.row[smaller]
            turned = self.whole[row] - self.terms[smaller] + self._value(np.uint64([other])) * self.up[self.place[smaller]]
            yield row, self._name(turned, self.n[row])


def _parts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Batches of about STEP bytes of words, a longer word alone."""
    for batch in batches:
        size = np.cumsum([len(w) for w in batch.column(column).to_pylist()])
        at = 0
        while at < batch.num_rows:
            done = size[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(size, done + STEP, side="right")))
            yield batch.slice(at, to - at)
            at = to


def _with_reduced(words: DataFrame, symbols: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, "word"):
            names = Reduced(batch.column("word"), symbols).names()
            yield batch.append_column("reduced", pa.array(signed(names)))

    return words.mapInArrow(run, "word string, n bigint, reduced bigint")


def _neighbourhoods(reduced: DataFrame, symbols: int) -> DataFrame:
    """Rows (`own`, `near`): every distinct reduced word and the names of its neighbours, itself among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, "word"):
            own = batch.column("own").to_numpy()
            for row, name in Reduced(batch.column("word"), symbols).neighbours():
                yield pa.record_batch({"own": pa.array(own[row]), "near": pa.array(signed(name))})

    return reduced.mapInArrow(run, "own bigint, near bigint")


def one_apart(a: str | Column, b: str | Column) -> Column:
    """Whether two words differ by exactly one inserted, deleted or replaced code point."""
    return F.levenshtein(a, b, 1) == 1


def near_words(words: DataFrame) -> DataFrame:
    """Rows (`a`, `na`, `b`, `nb`): each unordered pair of near words of a written table (`word`, `n`, `reduced`, see above) once."""
    symbols = words.symbols
    distinct = words.groupBy(F.col("reduced").alias("own")).agg(F.min("word").alias("word"))
    distinct = cut_lineage(distinct, "reduced")
    exist = distinct.select(F.col("own").alias("near"))
    pairs = cut_lineage(_neighbourhoods(distinct, symbols).join(exist, "near"), "reduced-pairs")
    side = lambda key, w, n: words.select(F.col("reduced").alias(key), F.col("word").alias(w), F.col("n").alias(n))
    met = pairs.join(side("own", "a", "na"), "own").join(side("near", "b", "nb"), "near")
    # a reduced word is its own neighbour, whose pairs of words then come from both sides
    met = met.filter(((F.col("own") != F.col("near")) | (F.col("a") < F.col("b"))) & one_apart("a", "b"))
    found = cut_lineage(met.select("a", "na", "b", "nb").distinct(), "near-words")
    discard(distinct, pairs)
    return found


def variant_forms(words: DataFrame, ratio: int = 10, word: str = "word", n: str = "n") -> DataFrame:
    """Rows `word`, `form`, `root`, `n`, `n_near`, `form_n`: each word of a vocabulary and the usual spelling it may stand for.

    `words` holds words and how often each occurs. Two are near if they differ by exactly one code point inserted, deleted
    or replaced. A word's form is its near word with the largest `n` (of equal ones the first in code-point order), if that
    is at least `ratio` times the word's own, and more than it; else null. `root` is reached by following forms from the word to the last.
    `n_near` counts near words, `form_n` is the form's `n`.

    Repeated words are one, their counts added; a null count adds nothing. Null words are left out. The empty word is near
    every word of one code point. Words of any length are taken whole. Other columns are ignored. An empty table gives no rows.
    """
    known = words.filter(F.col(word).isNotNull())
    known = known.groupBy(F.col(word).alias("word")).agg(F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("n"))
    counted = cut_lineage(known, "vocabulary")
    symbols = symbol_count(counted.count())
    vocabulary = cut_lineage(_with_reduced(counted, symbols), "reduced-vocabulary")
    vocabulary.symbols = symbols
    pairs = near_words(vocabulary)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("nb").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("na").alias("m"))
    )
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    large = (-F.col("best.m") >= ratio * F.col("n")) & (-F.col("best.m") > F.col("n"))
    formed = counted.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(large, F.col("best.other")).alias("form"), F.when(large, -F.col("best.m")).alias("form_n"),
    )
    formed = cut_lineage(formed, "forms")
    return formed.join(_roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(formed: DataFrame) -> DataFrame:
    """(`word`, `root`) of the words with a form, by doubling the steps; counts grow with each step, so there are no circles."""
    steps = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    steps = cut_lineage(steps, "roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        longer = steps.join(ahead, "root", "left")
        if longer.filter("_next IS NOT NULL").isEmpty():
            return steps
        done = cut_lineage(longer.select("word", F.coalesce("_next", "root").alias("root")), "roots")
        discard(steps)
        steps = done


def damaged_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", letters: int = 7, damage: int = 31) -> DataFrame:
    """Rows (`word`): maximal runs of `[A-Za-z\\u00C0-\\u00FF]` of whole texts, A-Z lower-cased, at least `letters` long, one row each.

    A run loses a letter where `damage` divides the crc32 of `<doc_id>:<run>`: the one at place crc32 % length. A null text has no
    runs; a null id counts as an empty one.
    """
    runs = docs.select(
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text), F.lit(f"[A-Za-zÀ-ÿ]{{{letters},}}+"), F.lit(0))).alias("run"),
    )
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    low = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", upper, upper.lower())).otherwise(F.col("run"))
    runs = runs.select("id", low.alias("run"))
    h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    lost = runs.withColumn("h", h).select(F.when(F.col("h") % damage == 0, shorter).otherwise(F.col("run")).alias("word"))
    return lost.filter(F.length("word") >= letters)
