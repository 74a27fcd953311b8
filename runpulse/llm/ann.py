"""Nearest neighbours by randomly rotated one-bit codes with error bounds, and exact reranking."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

#: Vectors of a block, queries of a block, and queries estimated at a time.
ROWS, QUERIES, AT_ONCE = 4096, 512, 128
#: Blocks of queries that a task keeps ready.
HELD = 64
#: Width of the error bound in standard deviations; at 4 the bound fails for about 1 in 16,000 estimates.
WIDTH = 4.0
#: Bits of a code per component of a vector, and bits to which a query's components are rounded.
CODE_BITS, QUERY_BITS = 4, 4
#: Seed of the rotation.
SEED = 7


def usable_vectors(vectors: DataFrame, vec_id: str, column: str) -> DataFrame:
    """Rows (`id`, `v` as doubles) that take part: no null id, and a vector that is not null, empty or zero and has only
    finite components."""
    v = F.transform(F.col(column), lambda x: x.cast("double"))
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("id"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("v", lambda x: x != 0)
    return rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(bad, F.lit(True)) & some)


@lru_cache(maxsize=8)
def _rotation(dim: int) -> np.ndarray:
    """`dim` orthonormal columns of a random rotation of the space of the codes, the same in every task."""
    bits = -(-dim * CODE_BITS // 64) * 64
    q, r = np.linalg.qr(np.random.Generator(np.random.PCG64(SEED + dim)).standard_normal((bits, dim)))
    return q * np.sign(np.diag(r))


def _packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1).view(np.uint64)


def _encode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits of rotated unit vectors, and the correction scalar of each: its product with its code."""
    turned = unit @ _rotation(unit.shape[1]).T
    return _packed(turned >= 0), np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])


def _matrix(column: pa.Array) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _summed(products: np.ndarray) -> np.ndarray:
    """Sums of the rows, component after component, so that a sum has the same bits wherever it is made."""
    total = np.zeros(len(products))
    for column in np.ascontiguousarray(products.T):
        total += column
    return total


def _scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors divided by a power of two, which changes no cosine and keeps squares from overflowing, and their squares' sums."""
    small = np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])
    return small, _summed(small * small)


def _cosines(a: np.ndarray, a2: np.ndarray, b: np.ndarray, b2: np.ndarray) -> np.ndarray:
    """Cosines of pairs of rows with their sums of squares, in double precision; 1 for equal rows."""
    return np.clip(_summed(a * b) / np.sqrt(a2 * b2), -1.0, 1.0)


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows packed into blocks of about `size` vectors of one dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(dim, parts):
            ids = np.concatenate([p[0] for p in parts])
            vectors = np.concatenate([p[1] for p in parts])
            small, squares = _scaled(vectors)
            codes, scalar = _encode(small / np.sqrt(squares)[:, None])
            number = int(np.bitwise_xor.reduce(ids * np.int64(0x9E3779B97F4A7C1 | 1))) ^ dim
            return pa.record_batch(
                {
                    "block": pa.array([number], pa.int64()),
                    "dim": pa.array([dim], pa.int32()),
                    "ids": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
                    "vectors": pa.array([vectors.astype("<f8").tobytes()], pa.binary()),
                    "codes": pa.array([codes.tobytes()], pa.binary()),
                    "scalars": pa.array([scalar.astype("<f8").tobytes()], pa.binary()),
                }
            )

        for batch in batches:
            ids, lists = batch.column("id").to_numpy(), batch.column("v")
            dims = lists.value_lengths().to_numpy()
            for dim in np.unique(dims).tolist():
                take = np.flatnonzero(dims == dim)
                own, matrix = ids[take], _matrix(lists.take(pa.array(take)))
                for at in range(0, len(own), size):
                    held.setdefault(dim, []).append((own[at : at + size], matrix[at : at + size]))
                    if sum(len(p[0]) for p in held[dim]) >= size:
                        yield block(dim, held.pop(dim))
        for dim, parts in held.items():
            yield block(dim, parts)

    return rows.mapInArrow(run, "block bigint, dim int, ids binary, vectors binary, codes binary, scalars binary")


def _planes(unit: np.ndarray) -> tuple:
    """Rotated queries rounded to QUERY_BITS: packed bits of each place value, offset, step, sum, and the deviation that rounding adds."""
    turned = unit @ _rotation(unit.shape[1]).T
    low = turned.min(axis=1, keepdims=True)
    step = (turned.max(axis=1, keepdims=True) - low) / (2**QUERY_BITS - 1)
    step[step == 0] = 1.0
    whole = np.rint((turned - low) / step).astype(np.uint8)
    rounded = low + step * whole
    off = np.sqrt(((turned - rounded) ** 2).sum(axis=1, keepdims=True) / turned.shape[1])
    return [_packed((whole >> j) & 1) for j in range(QUERY_BITS)], low, step, rounded.sum(axis=1, keepdims=True), off


def _estimates(planes: tuple, codes: np.ndarray, scalars: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of queries and codes, by counting the bits they share, and the width of their error bounds.

    The product with a code, divided by the code's own correction scalar, is an unbiased estimate.
    """
    bits, low, step, total, off = planes
    size = codes.shape[1] * 64
    shared = np.zeros((len(low), len(codes)), np.uint32)
    for value, plane in enumerate(bits):
        for word in range(codes.shape[1]):
            both = np.bitwise_count(plane[:, word, None] & codes[None, :, word])
            shared += both.astype(np.uint32) << np.uint32(value)
    ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
    estimate = (2 * (low * ones + step * shared) - total) / (np.sqrt(size) * scalars)
    spread = np.maximum(1 - scalars**2, 0) / max(size - 1, 1) + off**2
    return estimate, width * np.sqrt(spread) / np.maximum(scalars, 1e-6) + 1e-9


class _Search:
    """The k best rows so far of the queries of one block of them, over all blocks of rows that a task sees."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, width: float):
        self.ids, self.k, self.width = ids, k, width
        self.small, self.squares = _scaled(vectors)
        self.planes = _planes(self.small / np.sqrt(self.squares)[:, None])
        self.least = np.full(len(ids), -np.inf)  # the k-th best exact score yet

    def _exact(self, a: np.ndarray, b: np.ndarray, small: np.ndarray, squares: np.ndarray) -> np.ndarray:
        parts = [slice(at, at + 50_000) for at in range(0, len(a), 50_000)]
        scores = [_cosines(self.small[a[p]], self.squares[a[p]], small[b[p]], squares[b[p]]) for p in parts]
        return np.concatenate(scores or [np.zeros(0)])

    def meet(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray, scalars: np.ndarray) -> Iterator[tuple]:
        """(places of queries, ids, scores) of rows of this block that can be among the k best of a query."""
        small, squares = _scaled(vectors)
        bits, *numbers = self.planes
        for at in range(0, len(self.ids), AT_ONCE):
            part = slice(at, at + AT_ONCE)
            estimate, bound = _estimates(([p[part] for p in bits], *[x[part] for x in numbers]), codes, scalars, self.width)
            own = self.ids[part, None] == ids[None, :]
            estimate[own] = -np.inf
            if len(ids) > self.k:
                # the exact scores of the rows that look best say what the others have to reach
                first = np.argpartition(estimate, len(ids) - self.k, axis=1)[:, len(ids) - self.k :]
                scores = self._exact(np.repeat(np.arange(len(first)) + at, self.k), first.ravel(), small, squares)
                scores = np.where(np.take_along_axis(own, first, 1), -np.inf, scores.reshape(first.shape))
                self.least[part] = np.maximum(self.least[part], scores.min(axis=1))
            a, b = np.nonzero((estimate + bound >= self.least[part, None]) & ~own)
            a += at
            score = self._exact(a, b, small, squares)
            order = np.lexsort((ids[b], -score, a))
            a, b, score = a[order], b[order], score[order]
            place = np.arange(len(a)) - np.searchsorted(a, a)
            last = place == self.k - 1
            self.least[a[last]] = np.maximum(self.least[a[last]], score[last])
            good = (place < self.k) & (score >= self.least[a])
            yield a[good], ids[b[good]], score[good]


def nearest_neighbours(
    vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", column: str = "embedding",
    width: float = WIDTH,
) -> DataFrame:
    """Rows `query_id`, `rank` (from 1), `vec_id`, `score`: each query's `k` rows of largest cosine, itself left out.

    Every vector is turned by one random rotation into a space of CODE_BITS times its dimension and kept as its packed sign bits and
    one correction scalar. Blocks of queries, rounded to QUERY_BITS and packed by place value, meet blocks of codes: the
    bits they share give estimated products with error bounds. The exact scores, in double precision, of the k rows
    of a block that look best, and of the blocks before, are what a row's bound has to reach; only rows that do are computed exactly. The best k
    of all blocks are then ranked, ties to the smaller id. All codes are searched; a true neighbour is lost only if
    its estimate is off by more than `width` standard deviations.

    Vectors that are null, empty or zero, or hold a null or non-finite component, and null ids, take no part. Vectors meet
    those of equal dimension only. Repeated rows are candidates each; equal query rows are one query. With fewer
    than k candidates all are returned. Other columns are ignored; empty tables give no rows.
    """
    rows = usable_vectors(vectors, vec_id, column)
    asked = usable_vectors(queries, vec_id, column).dropDuplicates(["id"])
    # a grid of tasks: query blocks are copied along one side, row blocks (some 50 times as many) along the other
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    down = max(1, isqrt(tasks // 50))
    across = -(-tasks // down)
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    slot = lambda n: F.pmod(F.xxhash64("block"), F.lit(n)).cast("int")
    r_blocks = _blocks(rows, ROWS).withColumns({"col": slot(across), "row": copies(down)})
    q_blocks = _blocks(asked, QUERIES).withColumns({"row": slot(down), "col": copies(across)})
    q_blocks = q_blocks.select("row", "col", "dim", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    # by a merge: Spark's estimate of the query blocks leaves out their copies, and a broadcast would take all of them through the driver
    pairs = q_blocks.hint("merge").join(r_blocks, ["row", "col", "dim"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: dict[tuple[bytes, int], _Search] = {}
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                dim = row["dim"]
                q_ids, r_ids = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["ids"], "<i8")
                key = (row["q_ids"], dim)
                if key not in asked:
                    if len(asked) == HELD:
                        del asked[next(iter(asked))]  # met again, it starts without what it has found
                    asked[key] = _Search(q_ids, np.frombuffer(row["q_vectors"]).reshape(-1, dim), k, width)
                codes = np.frombuffer(row["codes"], np.uint64).reshape(len(r_ids), -1)
                vectors, scalars = np.frombuffer(row["vectors"]).reshape(-1, dim), np.frombuffer(row["scalars"])
                for a, ids, score in asked[key].meet(r_ids, vectors, codes, scalars):
                    yield pa.record_batch(
                        {
                            "query_id": pa.array(q_ids[a], pa.int64()),
                            "vec_id": pa.array(ids, pa.int64()),
                            "score": pa.array(score, pa.float64()),
                        }
                    )

    found = pairs.mapInArrow(search, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
