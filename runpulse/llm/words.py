"""Vectorised reading of Arrow text columns: words, shingles and 64-bit hashes without a loop per word.

A word is a run of bytes outside the six ASCII white-space bytes, with A-Z lower-cased; nothing else is folded.
Words are compared by a 64-bit polynomial hash over randomised bytes, so two different words are taken for one
with a probability of about 2**-64 per pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_RANDOM = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RANDOM.integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at once, few enough to stay in the cache; a longer stretch without any boundary is taken whole.
SEGMENT = 1 << 15
#: Shingles hashed at once.
RUN = 1 << 13

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


class _Tables:
    """Powers of the base and of its inverse, made when first wanted and never sent to a task."""

    def __init__(self):
        self.up = self.down = np.zeros(0, dtype=np.uint64)

    def __reduce__(self):
        return _Tables, ()

    def get(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < count:
            size = max(count, SEGMENT + 1, min(2 * len(self.up), 1 << 20))
            self.up, self.down = _powers(_BASE, size), _powers(_INVERSE, size)
        return self.up, self.down


_TABLES = _Tables()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mix_in_place(x: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """`mix` without new arrays."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, None)):
        np.right_shift(x, np.uint64(shift), out=spare)
        x ^= spare
        if factor:
            x *= np.uint64(factor)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch `data[start:end]`; stretches are in order and do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        origin = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, origin + SEGMENT, side="right")))
        s, e = starts[first:last] - origin, ends[first:last] - origin
        up, down = _TABLES.get(int(e[-1]) + 1)
        part = np.take(_BYTE, data[origin : origin + e[-1]], mode="clip")
        part *= up[: e[-1]]
        sums = np.zeros(int(e[-1]) + 1, dtype=np.uint64)
        np.cumsum(part, out=sums[1:])
        out[first:last] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        first = last
    return out


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased."""
    return data | ((data - np.uint8(65) < 26).view(np.uint8) << 5)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words; none crosses the end of a row."""
    inside = (data != 32) & (data - np.uint8(9) > 4)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def per_row(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many stretches begin in each row."""
    return np.diff(np.searchsorted(starts, offsets))


def row_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column in order, and the number of words of each row."""
    data, offsets = column_bytes(column)
    data = lowered(data)
    starts, ends = word_spans(data, offsets)
    return span_hashes(data, starts, ends), per_row(starts, offsets)


def shingles(words: np.ndarray, counts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of `size` words, repeats included, and how many each row has.

    A row with fewer words has its whole sequence as one shingle; a row without words has none.
    """
    ends = np.cumsum(counts)
    begins = ends - counts
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    after = np.cumsum(made)
    whole = counts >= size
    # every run of `size` words is hashed, also those that cross the end of a row, which are then left out
    inside = np.zeros(len(words) + 1, dtype=np.int8)
    inside[begins[whole]] += 1
    inside[(begins + made)[whole]] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    out = np.zeros(int(made.sum()), dtype=np.uint64)
    long = np.repeat(whole, made)
    full = _runs(words, size)[inside[: max(len(words) - size + 1, 0)]]
    if long.all():
        return full, made
    out[long] = full
    for row in np.unique(counts[~whole & (counts > 0)]):  # fewer than `size` lengths
        some = np.flatnonzero(counts == row)
        out[after[some] - 1] = _hashed([words[begins[some] + k] for k in range(row)])
    return out, made


def _hashed(parts: list[np.ndarray]) -> np.ndarray:
    """The hash of each sequence whose k-th words are `parts[k]`."""
    added = [np.array([(0xD6E8FEB86659FD93 * (k + 1)) & (2**64 - 1)], dtype=np.uint64) for k in range(len(parts))]
    out = parts[0] + mix(added[0])
    spare = np.empty_like(out)
    for part, more in zip(parts[1:], added[1:]):
        out += more
        mix_in_place(out, spare)
        out += part
    out += np.uint64(len(parts))
    return mix_in_place(out, spare)


def _runs(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of `size` words, wherever it begins."""
    count = max(len(words) - size + 1, 0)
    out = np.empty(count, dtype=np.uint64)
    for at in range(0, count, RUN):
        to = min(at + RUN, count)
        out[at:to] = _hashed([words[at + k : to + k] for k in range(size)])
    return out


def row_sets(column: pa.Array, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row, ascending within the row, and the size of each row's set."""
    words, counts = row_words(column)
    hashes, made = shingles(words, counts, size)
    row = np.repeat(np.arange(len(counts)), made)
    cuts = np.cumsum(made)
    for first, last in zip((cuts - made)[made > 1].tolist(), cuts[made > 1].tolist()):
        hashes[first:last].sort()
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = hashes[1:] != hashes[:-1]
    fresh[(cuts - made)[made > 0]] = True
    return hashes[fresh], np.bincount(row[fresh], minlength=len(counts)).astype(np.int64)


def pieces_of(batch: pa.RecordBatch, column: str, size: int = 1 << 20):
    """Cut a batch into slices of about `size` bytes of text (a longer text alone)."""
    _, offsets = column_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def signed(hashes: np.ndarray) -> np.ndarray:
    """Unsigned hashes as the signed longs that Spark has."""
    return hashes.view(np.int64)
