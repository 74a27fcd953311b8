"""Per-document term frequencies as block postings, and sums of term values per document.

`term_postings` reads documents once and writes, for each block of neighbouring documents and each term in it,
one row with the documents that hold the term and how often. A term is therefore pre-aggregated before any
shuffle, and one that stands in every document costs one row per block, not one per document. A caller joins
these rows to values per term; `document_sums` then adds value times frequency up per document.

Rows: `term` (long or binary), `salt`, `block`, `post` and `head`. A `head` row carries the columns of the
block's documents through the same shuffles, under a term of its own, so a text is read only once. Blocks are
numbered by input partition and position: read documents from a table, not from a shuffle, so that a task that
runs again makes the same blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from runpulse.llm.words import column_bytes, pieces_of

#: Text bytes and documents of a block at most (a longer text alone).
BLOCK_BYTES, BLOCK_DOCS = 1 << 24, 50_000
#: Pairs of a term and a document whose rows are made at once (a term with more alone).
PAIRS = 1 << 18
#: A term with so many documents in a block is divided among SALTS tasks.
HOT, SALTS = 256, 16
#: An entry of a posting: two bytes for the document, and after all of these one byte each for the counts.
ENTRY, MOST = 3, 255


def _entry_places(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte places of the documents and of the counts of all entries of postings that begin at `offsets`."""
    n = np.diff(offsets) // ENTRY
    inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    begin = np.repeat(offsets[:-1], n)
    return begin + 2 * inside, begin + np.repeat(2 * n, n) + inside


def _pairs(terms: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different terms, sorted; pairs of a term's place and a document as one number, sorted; and how often each stands."""
    unique, ids = np.unique(terms, return_inverse=True)
    ids = ids.astype(np.int64, copy=False)
    ids *= BLOCK_DOCS + 1
    ids += docs
    pairs, counts = np.unique(ids, return_counts=True)
    return unique, pairs, counts.astype(np.int32)


def _together(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`_pairs` of texts from those of its parts, which have no document in common."""
    if len(parts) == 1:
        return parts[0]
    unique = np.unique(np.concatenate([terms for terms, _, _ in parts]))
    pairs, counts = [], np.concatenate([c for _, _, c in parts])
    for terms, found, _ in parts:
        place, doc = np.divmod(found, BLOCK_DOCS + 1)
        pairs.append(np.searchsorted(unique, terms)[place] * (BLOCK_DOCS + 1) + doc)
    pairs = np.concatenate(pairs)
    order = np.argsort(pairs, kind="stable")
    return unique, pairs[order], counts[order]


def _rows(unique: np.ndarray, pairs: np.ndarray, counts: np.ndarray, names, block: int, hot: int) -> pa.RecordBatch:
    """Posting rows of one block; `names` turns sorted unique ids into the `term` column."""
    over = (counts - 1) // MOST + 1  # a count beyond a byte takes several entries
    if len(over) and over.max() > 1:
        rest = np.repeat(counts, over) - MOST * (np.arange(over.sum()) - np.repeat(np.cumsum(over) - over, over))
        pairs, counts = np.repeat(pairs, over), np.minimum(rest, MOST)
    bounds = np.searchsorted(pairs, np.arange(len(unique) + 1, dtype=np.int64) * (BLOCK_DOCS + 1))
    of_doc, of_count = _entry_places(ENTRY * bounds)
    post = np.empty(ENTRY * len(pairs), dtype=np.uint8)
    doc = pairs % (BLOCK_DOCS + 1)
    post[of_doc], post[of_doc + 1], post[of_count] = doc & 255, doc >> 8, counts
    binary = pa.Array.from_buffers(
        pa.binary(), len(unique), [None, pa.py_buffer((bounds * ENTRY).astype(np.int32)), pa.py_buffer(post)]
    )
    salt = np.where(np.diff(bounds) >= hot, block % SALTS, 0).astype(np.int32)
    n = len(unique)
    return pa.record_batch(
        {
            "term": names(unique),
            "salt": pa.array(salt),
            "block": pa.array(np.full(n, block, dtype=np.int64)),
            "post": binary,
            "head": pa.nulls(n, pa.binary()),
        }
    )


def _head(table: pa.Table, block: int, name) -> pa.RecordBatch:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return pa.record_batch(
        {
            "term": name(block),
            "salt": pa.array([0], pa.int32()),
            "block": pa.array([block], pa.int64()),
            "post": pa.array([None], pa.binary()),
            "head": pa.array([sink.getvalue().to_pybytes()], pa.binary()),
        }
    )


def term_postings(
    docs: DataFrame, text: str, reader: Callable[[], "TermReader"], kind: str = "long", step: int = 1 << 20,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Posting rows of all whole texts, read `step` bytes at a time; the other columns travel in the head rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = reader()
        number = TaskContext.get().partitionId() << 32
        heads, found, size, held = [], [], 0, 0

        def flush():
            nonlocal number, heads, found, size, held
            if not found:
                return
            unique, pairs, counts = _together(found)
            found = []
            bounds = np.searchsorted(pairs, np.arange(len(unique) + 1, dtype=np.int64) * (BLOCK_DOCS + 1))
            at = 0
            while at < len(unique):
                to = int(np.searchsorted(bounds, bounds[at] + PAIRS, side="right")) - 1
                to = min(max(to, at + 1), at + 20_000)
                own = slice(bounds[at], bounds[to])
                yield _rows(unique[at:to], pairs[own] - at * (BLOCK_DOCS + 1), counts[own], source.names, number, HOT)
                at = to
            del unique, pairs, counts
            yield _head(pa.Table.from_batches(heads), number, source.head_name)
            source.forget()
            number += 1
            heads, found, size, held = [], [], 0, 0

        for whole in batches:
            for batch in pieces_of(whole, text, step):
                for at in range(0, batch.num_rows, BLOCK_DOCS):
                    part = batch.slice(at, BLOCK_DOCS)
                    column = part.column(text)
                    data, _ = column_bytes(column)
                    if found and (size + len(data) > block_bytes or held + part.num_rows > BLOCK_DOCS):
                        yield from flush()
                    ids, n, extra = source.read(column)
                    # only what differs is kept of a piece, and a block is put together from that
                    found.append(_pairs(ids, np.repeat(np.arange(held, held + len(n)), n)))
                    rest = part.drop_columns([text])
                    for name, values in extra.items():
                        rest = rest.append_column(name, values)
                    heads.append(rest)
                    size += len(data)
                    held += part.num_rows
        yield from flush()

    schema = f"term {'bigint' if kind == 'long' else 'binary'}, salt int, block bigint, post binary, head binary"
    return docs.mapInArrow(run, schema)


class TermReader:
    """Turns texts into term ids; subclasses say how, and what else the head row should carry."""

    def read(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, dict[str, pa.Array]]:
        raise NotImplementedError

    def names(self, unique: np.ndarray) -> pa.Array:
        return pa.array(unique.view(np.int64) if unique.dtype == np.uint64 else unique, pa.int64())

    def head_name(self, block: int) -> pa.Array:
        return pa.array([-1 - block], pa.int64())

    def forget(self) -> None:
        """Called after each block."""


def document_sums(joined: DataFrame, values: list[str], schema: str) -> DataFrame:
    """One row per document: the columns its head row carries and, for each of `values`, the sum over its terms.

    `joined` has the posting rows with the value columns (double; null counts as zero). Each task first adds up
    what it has per document of a block; a second shuffle, by block, brings these partial sums together, one
    block in memory at a time.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, dict[int, np.ndarray]] = {}
        held = 0

        def flush():
            for block in list(sums):
                found = sums.pop(block)
                top = max(len(x) for x in found.values())
                full = np.zeros((len(values), top))
                for k, x in found.items():
                    full[k, : len(x)] = x
                some = np.flatnonzero(full.any(axis=0))
                if len(some):
                    yield part(block, some.astype("<u4").tobytes(), full[:, some].tobytes(), None)

        for batch in batches:
            blocks = batch.column("block").to_numpy()
            heads = batch.column("head")
            for at in np.flatnonzero(heads.is_valid().to_numpy(zero_copy_only=False)):
                yield part(int(blocks[at]), None, None, heads[int(at)].as_py())
            rows = batch.filter(heads.is_null())
            if not rows.num_rows:
                continue
            blocks = rows.column("block").to_numpy()
            data, offsets = column_bytes(rows.column("post"))
            n = np.diff(offsets) // ENTRY
            of_doc, of_count = _entry_places(offsets)
            doc, times = data[of_doc] + (data[of_doc + 1].astype(np.int64) << 8), data[of_count]
            block_of = np.repeat(blocks, n)
            order = np.argsort(block_of, kind="stable")
            cuts = np.flatnonzero(np.diff(block_of[order])) + 1
            for name_at, name in enumerate(values):
                value = rows.column(name)
                value = value.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
                weight = np.repeat(value, n) * times
                for group in np.split(order, cuts):
                    if not len(group):
                        continue
                    block = int(block_of[group[0]])
                    got = np.bincount(doc[group], weight[group])
                    have = sums.setdefault(block, {}).get(name_at)
                    if have is None:
                        sums[block][name_at] = got
                        held += len(got)
                    elif len(have) < len(got):
                        got[: len(have)] += have
                        sums[block][name_at] = got
                    else:
                        have[: len(got)] += got
            if held > 8_000_000:
                yield from flush()
                held = 0
        yield from flush()

    def part(block, docs, amounts, head):
        return pa.record_batch(
            {
                "block": pa.array([block], pa.int64()),
                "docs": pa.array([docs], pa.binary()),
                "amounts": pa.array([amounts], pa.binary()),
                "head": pa.array([head], pa.binary()),
            }
        )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, head, parts = None, None, []

        def close():
            table = pa.ipc.open_stream(head).read_all()
            total = np.zeros((len(values), table.num_rows))
            for docs, amounts in parts:
                at = np.frombuffer(docs, dtype="<u4")
                total[:, at] += np.frombuffer(amounts).reshape(len(values), -1)
            for name, column in zip(values, total):
                table = table.append_column(name, pa.array(column))
            yield from table.combine_chunks().to_batches(max_chunksize=10_000)

        for batch in batches:
            for block, docs, amounts, top in zip(*(c.to_pylist() for c in batch.columns)):
                if block != now:
                    if now is not None:
                        yield from close()
                    now, head, parts = block, None, []
                if top is not None:
                    head = top
                else:
                    parts.append((docs, amounts))
        if now is not None:
            yield from close()

    sums = joined.mapInArrow(partial, "block bigint, docs binary, amounts binary, head binary")
    return sums.repartition("block").sortWithinPartitions("block").mapInArrow(finish, schema)


def salted(values: DataFrame, times: str) -> DataFrame:
    """Values per term, those of a hot term repeated for each salt, for a join on (`term`, `salt`).

    `times` counts a term's tokens in all documents; a term with fewer than HOT cannot be hot in a block.
    """
    salts = F.when(F.col(times) >= HOT, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return values.withColumn("salt", F.explode(salts)).drop(times)
