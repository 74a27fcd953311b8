"""Bit filters of a fixed size, which keep unwanted rows from being shuffled."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Bits of a filter, 4 MB. With more keys than it holds well more rows pass, and all that pass are then joined exactly.
FILTER_BITS = 1 << 25
#: Kinds of keys whose equal values have equal hashes.
_EXACT = ("tinyint", "smallint", "int", "bigint", "string")


def _bits(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(FILTER_BITS)).astype(np.int64)


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = _bits(hashes)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def bit_filter(hashes: DataFrame) -> bytes:
    """A bit for each hash, as FILTER_BITS bits: at most FILTER_BITS distinct places reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS >> 3, dtype=np.uint8)
        some = False
        for batch in batches:
            at = _bits(batch.column(0).to_numpy().view(np.uint64))
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
            some |= len(at) > 0
        if some:
            for cut in range(0, len(bits), 1 << 16):
                part = bits[cut : cut + (1 << 16)]
                if part.any():
                    yield pa.record_batch({"at": pa.array([cut], pa.int64()), "part": pa.array([part.tobytes()], pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bits = None, None
        for batch in batches:
            for cut, part in zip(*(c.to_pylist() for c in batch.columns)):
                part = np.frombuffer(part, np.uint8)
                if cut == now:
                    bits = bits | part
                    continue
                if now is not None:
                    yield pa.record_batch({"at": pa.array([now], pa.int64()), "part": pa.array([bits.tobytes()], pa.binary())})
                now, bits = cut, part
        if now is not None:
            yield pa.record_batch({"at": pa.array([now], pa.int64()), "part": pa.array([bits.tobytes()], pa.binary())})

    parts = hashes.mapInArrow(run, "at bigint, part binary").repartition("at").sortWithinPartitions("at")
    out = bytearray(FILTER_BITS >> 3)
    for row in parts.mapInArrow(merge, "at bigint, part binary").collect():  # 4 MB at most
        out[row["at"] : row["at"] + len(row["part"])] = row["part"]
    return bytes(out)


def may_be_among(key: Column, keys: DataFrame) -> Column:
    """Whether a long, not null, may be among the one column of `keys`: true for all that are, and for few others."""
    found = keys.sparkSession.sparkContext.broadcast(bit_filter(keys))

    @F.arrow_udf("boolean")
    def test(hashes: pa.Array) -> pa.Array:
        return pa.array(passes(np.frombuffer(found.value, np.uint8), hashes.to_numpy().view(np.uint64)))

    return test(key)


def shuffled_join(rows: DataFrame, keys: DataFrame, on: str, how: str) -> DataFrame:
    """`rows` joined with `keys`, which has no key twice; rows that no key can fit are left out before the shuffle.

    The join is a shuffled one however few the keys are, so what it moves follows the input; a key with many rows is split by Spark.
    """
    kind = rows.schema[on].dataType
    if kind == keys.schema[on].dataType and kind.simpleString() in _EXACT:
        rows = rows.filter(may_be_among(F.xxhash64(on), keys.select(F.xxhash64(on))))
    return rows.join(keys.hint("shuffle_hash"), on, how)


def split_join(rows: DataFrame, key: str, doubtful: DataFrame, settle: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`rows` without `key`: as they are where the long `key` is not among `doubtful` (`key`), and elsewhere what `settle` makes of them.

    `settle` gets the rows whose key may be among them, which are some others too.
    """
    maybe = may_be_among(F.col(key), doubtful.select(key))
    return rows.filter(~maybe).drop(key).union(settle(rows.filter(maybe)).drop(key))
