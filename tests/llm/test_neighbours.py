"""Estimates from packed bits against true products, and the search against all cosines."""

import numpy as np

from runpulse.llm import ann
from runpulse.llm.ann import nearest_neighbours


def _unit(rows, dim, seed):
    m = np.random.default_rng(seed).standard_normal((rows, dim))
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def test_estimates_stay_in_their_bounds():
    for dim in (1, 3, 64, 100):
        rows, asked = _unit(2000, dim, 1), _unit(50, dim, 2)
        codes, scalars = ann._encode(rows)
        estimate, bound = ann._estimates(ann._planes(asked), codes, scalars, 4.0)
        off = np.abs(estimate - asked @ rows.T)
        assert codes.dtype == np.uint64 and codes.shape[1] == -(-dim * ann.CODE_BITS // 64)
        assert (off <= bound).mean() > 0.999
        if dim >= 64:
            assert off.mean() < bound.mean() / 3 and abs((estimate - asked @ rows.T).mean()) < 0.005


def test_few_rows_are_computed_exactly():
    m = _unit(4096, 64, 3)
    search, done = ann._Search(np.arange(64), m[:64], 5, 4.0), 0
    exact = search._exact
    search._exact = lambda a, b, *r: (count.append(len(a)), exact(a, b, *r))[1]
    count = []
    small, squares = ann._scaled(m)
    for a, ids, score in search.meet(np.arange(4096), m, *ann._encode(small / np.sqrt(squares)[:, None])):
        done += len(a)
    assert done == 64 * 5 and sum(count) < 0.25 * 64 * 4096


def test_odd_vectors(spark):
    """Copies tie to the smaller id, dimensions don't mix, huge and tiny numbers count, repeated rows are candidates each."""
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [3.0, 0.0]), (2, [3.0, 0.0]), (3, [1e300, 1e300]), (4, [1e-300, 0.0]), (50, [0.0, 5.0]),
        (5, [1.0, 2.0, 3.0]), (100, [1.0, 2.0, 3.0]), (150, [7.0]), (200, None), (250, []), (6, [0.0, 0.0]), (None, [1.0, 1.0]),
        (7, [float("inf"), 1.0]), (8, [None, 1.0]),
    ]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    got = {}
    for r in nearest_neighbours(table, table.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    half = 1 / np.sqrt(2)
    assert got[0][:4] == [(1, 1.0), (2, 1.0), (2, 1.0), (4, 1.0)] and got[0][4][0] == 3 and abs(got[0][4][1] - half) < 1e-15
    assert [v for v, _ in got[50]] == [3, 0, 1, 2, 2] and got[100] == [(5, 1.0)] and set(got) == {0, 50, 100}
    assert nearest_neighbours(table.limit(0), table).count() == 0 == nearest_neighbours(table, table.limit(0)).count()


def test_hot_group_over_blocks(spark, monkeypatch):
    """Thousands of near copies: the search over many blocks gives what all cosines give."""
    monkeypatch.setattr(ann, "ROWS", 300)
    near = _unit(1, 32, 5) + 0.01 * _unit(3000, 32, 6)
    m = np.concatenate([near, _unit(1500, 32, 7), near[:40]])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>").repartition(7)
    found = nearest_neighbours(table, table.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()
    norm = np.linalg.norm(m, axis=1)
    hit, asked = 0, range(0, len(m), 50)
    for place, i in enumerate(asked):
        score = m @ m[i] / (norm * norm[i])
        score[i] = -9
        best = np.argsort(-score, kind="stable")[:5]
        mine = found[5 * place : 5 * place + 5]
        assert [r.query_id for r in mine] == [i] * 5 and all(abs(r.score - score[r.vec_id]) < 1e-13 for r in mine)
        hit += sum(r.score >= score[best[-1]] - 1e-13 for r in mine)
    assert hit >= 0.99 * 5 * len(asked)


def test_copied_query_blocks_are_not_sent_through_the_driver(spark):
    """The queries are small enough for a broadcast, but a task of each column of the grid gets a copy of them."""
    m = _unit(2000, 16, 8)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>")
    found = nearest_neighbours(table, table.filter("vec_id % 50 = 0"))
    rows = sorted(found.collect())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in plan and "SortMergeJoin" in plan and "Broadcast" not in plan
    scores = m @ m[::50].T
    scores[range(0, 2000, 50), range(40)] = -9
    assert len(rows) == 5 * 40 and all(abs(r.score - np.sort(scores[:, r.query_id // 50])[-r.rank]) < 1e-13 for r in rows)
