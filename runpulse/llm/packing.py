"""Packing of tokenized documents into training sequences by the best-two-fit rule."""

from __future__ import annotations

import os
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from runpulse.llm.words import _LOWER, column_bytes, per_row, pieces_of, span_hashes, word_spans
from runpulse.session import cut_lineage

#: Words whose ids a task keeps at once.
KNOWN_WORDS = 400_000
#: Words that are encoded as one text.
JOINED = 32
#: Parts into which pieces of one length are divided to number them.
SALTS = 64


_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
#: ASCII signs and digits; an apostrophe may belong to the letters behind it, a bar to a special token.
_SIGN = np.zeros(256, dtype=bool)
_SIGN[33:128] = ~_LETTER[33:128]
_SIGN[[39, 124]] = False


def part_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with A-Z lower-cased, and starts and ends of the parts of all words: cut between ASCII letters and signs.

    Words with a bar keep their case, as special tokens are case-sensitive.
    """
    starts, ends = word_spans(data, offsets)
    low = _LOWER[data]
    bars = np.flatnonzero(data == 124)
    for k in np.unique(np.searchsorted(starts, bars, side="right") - 1).tolist():
        low[starts[k] : ends[k]] = data[starts[k] : ends[k]]
    letter, sign = _LETTER[data], _SIGN[data]
    cut = (letter[:-1] & sign[1:]) | (sign[:-1] & letter[1:])
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    inner = np.flatnonzero(cut & ~edge[1:-1]) + 1 if len(data) else np.zeros(0, dtype=np.int64)
    return low, _merged(starts, inner, len(data)), _merged(ends, inner, len(data))


def _merged(places: np.ndarray, more: np.ndarray, limit: int) -> np.ndarray:
    """Places of both lists in order; they have none in common and none is above `limit`."""
    marked = np.zeros(limit + 1, dtype=bool)
    marked[places] = marked[more] = True
    return np.flatnonzero(marked)


class WordIds:
    """Token ids of whole texts; each distinct part of a word is encoded once while it is remembered.

    Right for tokenizers that ignore case, drop white space before they split, and split letters from other signs
    (checked in the tests against the library).
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.ends = self._end_ids()
        self._forget()

    def _end_ids(self) -> np.ndarray:
        """Which ids end a word; none, if the model doesn't mark the end of every word."""
        known = self.model.get_vocab()
        out = np.zeros(max(known.values(), default=0) + 1, dtype=bool)
        suffix = getattr(self.model.model, "end_of_word_suffix", None)
        if suffix and all(sign + suffix in known for sign in known if len(sign) == 1):
            out[[known[token] for token in known if token.endswith(suffix)]] = True
        return out

    def _forget(self):
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.first = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def _made(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after another, and how many each has.

        Words of letters alone are joined by spaces, which are dropped, and told apart by the ids that end a word. A text that
        does not give one end for each of its words, and any other word, is encoded word by word.
        """
        together = np.flatnonzero([w.isalpha() for w in words]) if self.ends.any() else np.zeros(0, dtype=np.int64)
        cuts = np.arange(0, len(together), JOINED)
        size = np.diff(np.append(cuts, len(together)))
        ids, length = self._ids([" ".join([words[k] for k in together[a : a + JOINED].tolist()]) for a in cuts.tolist()])
        end, text = self.ends[ids], np.repeat(np.arange(len(cuts)), length)
        closed = np.append(end, False)[np.cumsum(length) - 1]
        right = (np.bincount(text, end, minlength=len(cuts)) == size) & (length > 0) & closed
        keep = right[text]
        ids, end = ids[keep], end[keep]
        good = np.repeat(right, size)
        part = together[good][np.cumsum(end) - end]
        rest = np.ones(len(words), dtype=bool)
        rest[together[good]] = False
        rest = np.flatnonzero(rest)
        more, length = self._ids([words[k] for k in rest.tolist()])
        part = np.concatenate([part, np.repeat(rest, length)])
        return np.concatenate([ids, more])[np.argsort(part, kind="stable")], np.bincount(part, minlength=len(words))

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]
        length = np.array([len(x) for x in found], dtype=np.int64)
        return np.fromiter(chain.from_iterable(found), np.uint32, int(length.sum())), length

    def encode(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows one after another, `end_id` after each row, and the length of each row."""
        data, offsets = column_bytes(column)
        data, starts, ends = part_spans(data, offsets)
        hashes = span_hashes(data, starts, ends)
        unique, inverse = np.unique(hashes, return_inverse=True)
        place = np.zeros(len(unique), dtype=np.int64)
        place[inverse] = np.arange(len(hashes))
        if len(self.hashes) > KNOWN_WORDS:
            self._forget()
        fresh = np.flatnonzero(~np.isin(unique, self.hashes, assume_unique=True))
        if len(fresh):
            raw = data.tobytes()
            made, count = self._made([raw[s:e].decode() for s, e in zip(starts[place[fresh]].tolist(), ends[place[fresh]].tolist())])
            first = len(self.ids) + np.cumsum(count) - count
            self.ids = np.concatenate([self.ids, made])
            hashes_now = np.concatenate([self.hashes, unique[fresh]])
            order = np.argsort(hashes_now, kind="stable")
            self.hashes = hashes_now[order]
            self.first = np.concatenate([self.first, first])[order]
            self.count = np.concatenate([self.count, count])[order]
        at = np.searchsorted(self.hashes, unique)[inverse]
        count = self.count[at]
        words_of = per_row(starts, offsets)
        row = np.repeat(np.arange(len(words_of)), words_of)
        length = np.bincount(row, count, minlength=len(words_of)).astype(np.int64) + 1
        out = np.full(int(length.sum()), end_id, dtype=np.uint32)
        total = int(count.sum())
        inside = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
        ids = self.ids[np.repeat(self.first[at], count) + inside] if total else np.zeros(0, np.uint32)
        keep = np.ones(len(out), dtype=bool)
        keep[np.cumsum(length) - 1] = False
        out[keep] = ids
        return out, length


def token_pieces(docs: DataFrame, path: str, doc_id: str, text: str, size: int, end_id: int, with_ids: bool) -> DataFrame:
    """Pieces of at most `size` ids of every document: id, `piece`, `start`, `length`, `ids_crc32` (and `ids`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(path)
        for whole in batches:
            for batch in pieces_of(whole, "_text"):
                ids, length = words.encode(batch.column("_text"), end_id)
                pieces = (length + size - 1) // size
                row = np.repeat(np.arange(len(length)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * size
                have = np.minimum(length[row] - start, size)
                at = (np.cumsum(length) - length)[row] + start
                raw = memoryview(ids.astype("<u4").tobytes())
                sums = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), have.tolist())]
                columns = {
                    "_id": batch.column("_id").take(pa.array(row)),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(have, pa.int64()),
                    "ids_crc32": pa.array(sums, pa.int64()),
                }
                if with_ids:
                    cuts = np.append(at, len(ids)).astype(np.int32)
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(cuts), pa.array(ids.astype(np.int32)))
                yield pa.record_batch(columns)

    plain = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    kind = plain.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return plain.mapInArrow(run, schema)


def best_two_fit(counts: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins for `counts[length]` documents of each length, as (number of equal bins, [(length, copies)]).

    A bin is filled greedily with the longest documents that still fit. If a gap is left, its smallest document
    is taken out again and the two unpacked documents are sought that together fill the widened gap best; if they
    fill it more than that document did, they replace it. A bin is repeated while the documents for it last, so
    the work depends on the number of different lengths, not of documents.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    if left and not 0 < min(left) <= max(left) <= size:
        raise ValueError("a length is not between 1 and the sequence size")
    lengths = sorted(left)
    bins = []
    while lengths:
        bin_, gap = {}, size
        at = len(lengths) - 1
        while at >= 0 and gap >= lengths[0]:
            at = min(at, bisect_right(lengths, gap) - 1)
            if at < 0:
                break
            n = lengths[at]
            copies = min(left[n], gap // n)
            bin_[n] = copies
            gap -= n * copies
            at -= 1
        if gap:
            least = min(bin_)
            wide = gap + least
            have = {n: left[n] - bin_.get(n, 0) for n in lengths if n < wide}
            free = [n for n in have if have[n] > 0]
            best = (least, None)
            low, high = 0, len(free) - 1
            while low <= high:
                a, b = free[low], free[high]
                if a + b > wide:
                    high -= 1
                    continue
                if a + b > best[0] and (a != b or have[a] > 1):
                    best = (a + b, (a, b))
                low += 1
            if best[1]:
                bin_[least] -= 1
                for n in best[1]:
                    bin_[n] = bin_.get(n, 0) + 1
                bin_ = {n: c for n, c in bin_.items() if c}
        times = min(left[n] // c for n, c in bin_.items())
        bins.append((times, sorted(bin_.items(), reverse=True)))
        for n, c in bin_.items():
            left[n] -= c * times
        lengths = [n for n in lengths if left[n]]
    return bins


def pack_documents(
    docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", size: int = 4096, end_id: int = 1,
    with_ids: bool = False,
) -> DataFrame:
    """Rows `doc_id`, `piece`, `start`, `length`, `ids_crc32`, `sequence_id`, `offset` (and `ids` if wanted).

    A document is its ids and then `end_id`; only one longer than `size` is cut, into pieces of `size`. Pieces are
    written to the shared folder. Their lengths are counted (at most `size` numbers, whatever the input) and
    `best_two_fit` makes a plan from these counts on the driver; each piece, numbered among those of its length,
    then looks up its place in the plan. The plan's size depends on `size` alone, and no piece passes the driver.

    A null or empty text is one piece of the end id. Null or repeated ids are kept as rows of their own; other
    columns are ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = cut_lineage(token_pieces(docs, path, doc_id, text, size, end_id, with_ids), "pieces")
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, base, used = [], 0, {}
    for times, bin_ in best_two_fit(counts, size):
        offset = 0
        for n, copies in bin_:
            slots.append((n, used.get(n, 0), base, copies, offset))
            used[n] = used.get(n, 0) + copies * times
            offset += n * copies
        base += times
    slots.sort()
    plan = np.array(slots, dtype=np.int64).reshape(-1, 5)

    order = ["_id", "piece", "start", "ids_crc32"]
    salt = F.pmod(F.xxhash64(*order), F.lit(SALTS)).cast("int")
    parts = pieces.withColumn("_salt", salt)
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    begin = parts.groupBy("length", "_salt").agg(F.count("*").alias("n"))
    begin = begin.select("length", "_salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_begin"))
    own = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*order)) - 1
    ranked = parts.withColumn("_own", own).join(begin, ["length", "_salt"])
    ranked = ranked.select(*pieces.columns, (F.col("_begin") + F.col("_own")).alias("_rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.flatnonzero(np.r_[True, plan[1:, 0] != plan[:-1, 0]])
        low = dict(zip(plan[first, 0].tolist(), first.tolist()))
        high = dict(zip(plan[first, 0].tolist(), [*first[1:].tolist(), len(plan)]))
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            at = np.zeros(len(lengths), dtype=np.int64)
            for n in np.unique(lengths).tolist():
                rows = lengths == n
                at[rows] = low[n] + np.searchsorted(plan[low[n] : high[n], 1], ranks[rows], side="right") - 1
            _, begin_rank, first_bin, copies, offset = plan[at].T if len(at) else np.zeros((5, 0), dtype=np.int64)
            k = ranks - begin_rank
            columns = batch.drop_columns(["_rank"])
            columns = columns.append_column("sequence_id", pa.array(first_bin + k // np.maximum(copies, 1), pa.int64()))
            yield columns.append_column("offset", pa.array(offset + (k % np.maximum(copies, 1)) * lengths, pa.int64()))

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{fields}, sequence_id bigint, offset bigint").withColumnRenamed("_id", doc_id)
