"""The network's steps work in place."""

import tracemalloc

import numpy as np

from runpulse.llm.gru import PER_CLASS, UNITS, WINDOW, Gru, _ordered


def test_numbers_are_put_in_order_without_losing_ties_or_large_ones():
    rng = np.random.default_rng(2)
    for limit in (90, 1 << 16, 1 << 20):
        values = rng.integers(0, limit, 3000)
        assert (_ordered(values, limit) == np.argsort(values, kind="stable")).all()


def test_steps_make_few_arrays():
    """States are not copied for masks that hold everywhere, factors and moments are made in place."""
    rng = np.random.default_rng(3)
    net = Gru(3 * PER_CLASS, 4)
    lanes = 128
    ids = rng.integers(0, net.words + net.rest, 4 * lanes * WINDOW).astype(np.uint16)
    net.train(ids, lanes=lanes)
    tracemalloc.start()
    net.train(ids, lanes=lanes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25 * 4 * lanes * WINDOW * UNITS  # 26.6 window states before, 23.6 now
