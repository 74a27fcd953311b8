"""Ids of words that are encoded together, against the library word by word."""

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from runpulse.llm import queries as Q
from runpulse.llm.packing import WordIds

ALPHABETS = [
    "abcxyzABC", "éèçäöüßñÀÖŁłſŸ", "İıiI", "ΣσςΩωΩ", "жщЯё", "각가", "漢字かな", "̸̧́̈",
    "019²½٣", ".,!#<>=|'&\"", "  \u0085​", "ªµºʰ𝒜🙂\x00\x01", "אبकि",
]


class Counted:
    """A tokenizer that notes how many texts it is given."""

    def __init__(self, model):
        self.inner, self.texts = model, 0

    def _noted(self, name, texts, **more):
        self.texts += len(texts)
        return getattr(self.inner, name)(texts, **more)

    def encode_batch(self, texts, **more):
        return self._noted("encode_batch", texts, **more)

    def encode_batch_fast(self, texts, **more):
        return self._noted("encode_batch_fast", texts, **more)


def odd_words(count):
    rng = np.random.default_rng(3)
    words = ["<|endoftext|>", "a<|startoftext|>b", "it's", "'re", "</w>", "x</w>y", "é", "≠", "İstanbul", "ΟΔΟΣ"]
    for _ in range(count):
        of = "".join(ALPHABETS[k] for k in rng.choice(len(ALPHABETS), rng.integers(1, 3)))
        words.append("".join(rng.choice(list(of), rng.integers(1, 9))))
    return [w for w in words if w.strip() == w]


def test_odd_texts_have_the_ids_of_the_library():
    path = Q.tokenizer_path(Q.PACK_FILE)
    library, words = Tokenizer.from_file(path), odd_words(6000)
    texts = [" ".join(words[k : k + 7]) for k in range(0, len(words), 7)] + ["", None, "\n", "plain words"]
    ids, length = WordIds(path).encode(pa.array(texts), 1)
    want = [[*x.ids, 1] for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert length.tolist() == [len(x) for x in want]
    assert [x.tolist() for x in np.split(ids, np.cumsum(length)[:-1])] == want


def test_words_of_letters_are_encoded_together():
    path = Q.tokenizer_path(Q.PACK_FILE)
    rng = np.random.default_rng(4)
    words = sorted({"".join(rng.choice(list("abcdeéäß"), rng.integers(2, 9))) for _ in range(3000)})
    made = WordIds(path)
    made.model = counted = Counted(made.model)
    ids, _ = made.encode(pa.array([" ".join(words)]), 1)
    assert ids.tolist() == [*Tokenizer.from_file(path).encode(" ".join(words), add_special_tokens=False).ids, 1]
    assert counted.texts < len(words) / 20


def test_a_text_without_one_end_for_each_word_is_encoded_word_by_word():
    path = Q.tokenizer_path(Q.PACK_FILE)
    library, words = Tokenizer.from_file(path), ["first", "second", "third", ".", "two.parts", "fourth"]
    made = WordIds(path)
    want = [library.encode(w, add_special_tokens=False).ids for w in words]
    for ends in (made.ends, np.zeros_like(made.ends), np.roll(made.ends, 1), np.ones_like(made.ends)):
        made.ends = ends
        ids, count = made._made(words)
        assert [x.tolist() for x in np.split(ids, np.cumsum(count)[:-1])] == want
