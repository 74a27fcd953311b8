"""Posting rows of a block hold every count, and making them takes little memory."""

import collections
import tracemalloc
import types

import numpy as np
import pyarrow as pa

from runpulse.llm import postings
from runpulse.llm.words import row_words


class _Words(postings.TermReader):
    def read(self, column):
        words, n = row_words(column)
        return words, n, {}


def _made(monkeypatch, texts, **options):
    """The rows that one task makes of `texts`."""
    monkeypatch.setattr(postings, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    run = postings.term_postings(types.SimpleNamespace(mapInArrow=lambda f, _: f), "t", _Words, **options)
    return run(iter([pa.record_batch({"t": pa.array(texts), "id": pa.array(range(len(texts)))})]))


def test_postings_of_a_block_read_in_pieces(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{k}" for k in rng.zipf(1.3, 600) % 500) for _ in range(60)] + ["", None, "w1 " * 700]
    monkeypatch.setattr(postings, "PAIRS", 300)
    got, first = collections.Counter(), {}
    for batch in _made(monkeypatch, texts, step=5_000, block_bytes=40_000):
        for r in batch.to_pylist():
            if r["head"] is not None:
                first[r["block"]] = pa.ipc.open_stream(r["head"]).read_all().column("id").to_pylist()
            else:
                n = len(r["post"]) // postings.ENTRY
                for at in range(n):
                    got[r["block"], r["post"][2 * at] + 256 * r["post"][2 * at + 1], r["term"]] += r["post"][2 * n + at]
    assert sum(map(len, first.values())) == len(texts) and len(first) > 3
    words, n = row_words(pa.array(texts))
    want = collections.Counter(zip(np.repeat(np.arange(len(n)), n).tolist(), words.view(np.int64).tolist()))
    assert {(first[b][d], t): c for (b, d, t), c in got.items()} == want


def test_a_block_is_made_in_little_memory(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.zipf(1.2, 1000) % 9)) for _ in range(2100)]  # 4 MB, 2 million words
    tracemalloc.start()
    rows = sum(b.num_rows for b in _made(monkeypatch, texts, step=1 << 18))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 10 and peak < 60e6
