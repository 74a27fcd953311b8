"""Hashes of words and shingles: the same as by a loop over the words, in little memory, and one pass over a list."""

import tracemalloc

import numpy as np
import pyarrow as pa

from runpulse.llm import words as W
from runpulse.llm.jaccard import _Listed

ONE = np.uint64(2**64 - 1)


def plain_shingles(words, size=5):
    parts = [words[i : i + size] for i in range(len(words) - size + 1)] if len(words) >= size else [words] if words else []
    made = []
    for part in parts:
        x = np.zeros(1, dtype=np.uint64)
        for k, word in enumerate(part):
            x = W.mix(x + np.array([(0xD6E8FEB86659FD93 * (k + 1)) & (2**64 - 1)], dtype=np.uint64)) + np.uint64(word)
        made.append(int(W.mix(x + np.uint64(len(part)))[0]))
    return made


def texts(rng, rows):
    lengths = rng.choice([0, 1, 2, 3, 4, 5, 6, 40, 300], rows)
    return [None if n == 0 and k % 2 else " ".join(rng.choice(["a", "Bc", "d\tE", "É", "[x]", "\x0bz\xa0"], n)) for k, n in enumerate(lengths)]


def test_shingles_equal_a_loop_over_the_words():
    rng = np.random.default_rng(3)
    column = pa.array(texts(rng, 120) + ["x" * 40_000 + " " + "Y" * 70_000, " ", "one two three four five " * 3000])
    words, counts = W.row_words(column)
    cuts = np.r_[0, np.cumsum(counts)]
    expected = [plain_shingles([int(w) for w in words[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])]
    hashes, made = W.shingles(words, counts)
    assert made.tolist() == [len(x) for x in expected]
    assert hashes.tolist() == [h for x in expected for h in x]
    sets, n = W.row_sets(column)
    assert n.tolist() == [len(set(x)) for x in expected]
    assert sets.tolist() == [h for x in expected for h in sorted(set(x))]
    for empty in ([], [None, ""], ["a b"]):
        assert len(W.row_sets(pa.array(empty, pa.string()))[1]) == len(empty)


def test_a_word_has_the_same_hash_wherever_it_stands():
    rng = np.random.default_rng(4)
    vocabulary = ["w" * k + str(k) for k in (1, 2, 30, W.SEGMENT - 1, W.SEGMENT, W.SEGMENT + 7, 3 * W.SEGMENT)]
    alone = {w: int(W.row_words(pa.array([w.upper()]))[0][0]) for w in vocabulary}
    drawn = rng.choice(vocabulary, 60).tolist()
    assert W.row_words(pa.array([" ".join(drawn)]))[0].tolist() == [alone[w] for w in drawn]
    assert len(set(alone.values())) == len(vocabulary)


def test_bytes_are_lowered_and_split_as_by_python():
    data = np.arange(256, dtype=np.uint8)
    assert W.lowered(data).tobytes() == bytes(range(256)).lower()
    starts, ends = W.word_spans(data, np.array([0, 256]))
    assert [bytes(data[a:b]) for a, b in zip(starts, ends)] == bytes(range(256)).split()


def test_listed_finds_what_is_in_the_list():
    rng = np.random.default_rng(5)
    values = np.sort(rng.integers(0, 1 << 64, 5000, dtype=np.uint64))
    asked = np.concatenate([values[::3], values[::7] + np.uint64(1), rng.integers(0, 1 << 64, 5000, dtype=np.uint64), [np.uint64(0), ONE]])
    assert (_Listed(values)(asked) == np.isin(asked, values)).all()
    assert not _Listed(values[:0])(asked).any() and not len(_Listed(values)(asked[:0]))


def test_sets_are_made_in_little_memory():
    """Sorting by row and hash, and a masked array for each step of the hash, took 33 longs a word at once; 11 are left."""
    rng = np.random.default_rng(6)
    column = pa.array([" ".join(map(str, rng.integers(0, 1 << 40, 400))) for _ in range(200)])
    W.row_sets(column)
    tracemalloc.start()
    W.row_sets(column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * 8 * 200 * 400
