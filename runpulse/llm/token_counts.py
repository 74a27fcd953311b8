"""Token counts of documents: pieces per distinct pre-token, joined to frequencies, summed."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from runpulse.llm.columns import passing_on
from runpulse.llm.postings import TermReader, document_sums, term_postings
from runpulse.llm.words import column_bytes, per_row, span_hashes

#: Last bytes of the two- and three-byte spaces, with their first bytes; a space after one starts no pre-token.
_WIDE_FIRST = (0xE1, 0xE2, 0xE3)


def unit_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut texts before each single space that follows a character which is no white space.

    Byte-level pre-tokenizers take one leading space with a word and never cross such a place, nor do special
    tokens, which hold no space. The stretches between are counted alone, and their counts add up exactly.
    """
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    start = np.zeros(n, dtype=bool)
    before = data[:-1]
    start[1:] = (data[1:] == 32) & (before > 32) & (before != 127)
    wide = np.zeros(n, dtype=bool)  # the byte before may end a Unicode space
    wide[2:] |= (data[1:-1] >= 0x80) & (data[:-2] == 0xC2)
    wide[3:] |= (data[2:-1] >= 0x80) & np.isin(data[:-3], _WIDE_FIRST)
    start &= ~wide
    start[offsets[:-1][offsets[:-1] < n]] = True
    starts = np.flatnonzero(start)
    return starts, np.append(starts[1:], n)


class PreTokens(TermReader):
    """Pre-tokens by hash within a block; their bytes are kept once per distinct pre-token."""

    def __init__(self):
        self.known_hashes, self.known_bytes = np.zeros(0, dtype=np.uint64), []
        self.stored = pa.array([], pa.binary())

    def read(self, column):
        data, offsets = column_bytes(column)
        starts, ends = unit_spans(data, offsets)
        hashes = span_hashes(data, starts, ends)
        unique, first = np.unique(hashes, return_index=True)
        fresh = ~np.isin(unique, self.known_hashes, assume_unique=True)
        raw = data.tobytes()
        taken = pa.array([raw[s:e] for s, e in zip(starts[first[fresh]], ends[first[fresh]])], pa.binary())
        self.known_hashes = np.concatenate([self.known_hashes, unique[fresh]])
        self.stored = pa.concat_arrays([self.stored, taken])
        return hashes, per_row(starts, offsets), {"n_bytes": pa.array(np.diff(offsets), pa.int64())}

    def names(self, unique):
        order = np.argsort(self.known_hashes)
        return self.stored.take(pa.array(order[np.searchsorted(self.known_hashes[order], unique)]))

    def head_name(self, block):
        return pa.array([b"\xff" + block.to_bytes(8, "big")], pa.binary())  # no UTF-8 begins so

    def forget(self):
        self.__init__()


def counter(path: str):
    """A function from a list of strings to their token counts, by the library for the file's kind."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(x.ids) for x in model.encode_batch(texts, add_special_tokens=False)]


def _piece_counts(path: str):
    """Adds `pieces` to posting rows that are sorted by term: each distinct pre-token is counted once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        last, last_pieces = None, 0
        for batch in batches:
            encoded = batch.column("term").dictionary_encode()
            terms = encoded.dictionary.to_pylist()
            texts = [b"" if t[:1] == b"\xff" or t == last else t for t in terms]
            pieces = np.array(count([t.decode() for t in texts]) if texts else [], dtype=np.float64)
            for at, t in enumerate(terms):
                if t == last:
                    pieces[at] = last_pieces
            if terms:
                at = encoded.indices[-1].as_py()
                last, last_pieces = terms[at], pieces[at]
            yield batch.append_column("pieces", pa.array(pieces[encoded.indices.to_numpy()], pa.float64()))

    return run


def token_counts(docs: DataFrame, path: str, text: str = "text", limit: int = 512) -> DataFrame:
    """`docs` without its text, with `n_bytes` (UTF-8), `n_tokens` and `over_limit` (more tokens than `limit`).

    The tokenizer at `path` must be one whose pre-tokens never cross a single space after a visible character
    (byte-level ones). Counts are those of the library over the whole text, special strings inside it included.

    A null or empty text has no bytes and no tokens. Equal rows each give a row; other columns, nulls in them
    included, are passed on, but for columns named like the results, which are replaced. An empty table gives
    no rows.
    """
    run = lambda d: _counted(d, path, text, limit)
    return passing_on(docs, [text], ["n_bytes", "n_tokens", "over_limit"], run)


def _counted(docs, path, text, limit) -> DataFrame:
    kept = [c for c in docs.columns if c != text]
    plain = docs.select(*[F.col(c) for c in kept], F.col(text).alias("_text"))
    rows = term_postings(plain, "_text", PreTokens, kind="binary")
    parts = rows.repartition("term", "salt").sortWithinPartitions("term")
    schema = "term binary, salt int, block bigint, post binary, head binary, pieces double"
    counted = parts.mapInArrow(_piece_counts(path), schema)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.drop("_text").schema)
    done = document_sums(counted, ["pieces"], f"{fields + ', ' if fields else ''}n_bytes bigint, pieces double")
    n = F.round("pieces").cast("bigint")
    return done.select(*kept, "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))
