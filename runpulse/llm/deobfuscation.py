"""Restoring disguised words: Viterbi decoding of character lattices under a character trigram model."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from runpulse.llm.words import pieces_of

#: Symbols of the model: word boundary, a-z, the Latin-1 small letters, anything else that stands in words.
BOUNDARY, OTHER, SYMBOLS = 0, 59, 60
#: Letters that a digit or sign may stand for.
DISGUISES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e",
}
#: Natural log costs of the channel: a sign for a letter, a letter repeated, a doubled one meant once, a separator put in, one left as it is,
#: a sign that is no letter.
SWAP, STRETCH, DOUBLED, SPACED, SPLIT, PLAIN = -1.5, -0.7, -5.0, -0.3, -3.0, -4.0

_SIGNS = re.escape("".join(DISGUISES))
#: What the lattice takes for a separator: all but letters, digits and signs.
_BETWEEN = rf"(?:[^\w{_SIGNS}]|_)"
_UNIT = rf"(?:[^\W\d_]|[{_SIGNS}])"
#: Words the lattice may change: with a sign, a letter twice, or separators inside.
SUSPECT = re.compile(rf"[{_SIGNS}]|([^\W\d_])\1|[^\W_]{_BETWEEN}+[^\W_]", re.IGNORECASE)
#: Single letters or signs, each perhaps repeated, with one to three separators.
SINGLES = re.compile(rf"(?<![^\W_])({_UNIT})\1*(?:{_BETWEEN}{{1,3}}({_UNIT})\2*)+(?![^\W_])", re.IGNORECASE)
_WORD = re.compile(r"[^\W_]+")

_TABLE = np.full(256, BOUNDARY, dtype=np.int64)
_TABLE[ord("a") : ord("z") + 1] = _TABLE[ord("A") : ord("Z") + 1] = np.arange(1, 27)
_TABLE[ord("0") : ord("9") + 1] = OTHER
_TABLE[0xDF:0x100] = np.r_[27, np.arange(27, 59)]
_TABLE[0xC0:0xDE] = np.arange(27, 57)


def symbols(points: np.ndarray) -> np.ndarray:
    """Model symbols of code points, upper-case letters like small ones."""
    return np.where(points < 256, _TABLE[np.minimum(points, 255)], OTHER)


def symbol_counts(texts: DataFrame) -> np.ndarray:
    """How often each trigram of symbols stands in all texts: SYMBOLS ** 3 numbers, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, dtype=np.int64)
        for whole in batches:
            for batch in pieces_of(whole, "_text", 1 << 21):
                joined = "  ".join(batch.column("_text").fill_null("").to_pylist())
                s = symbols(np.frombuffer(f"  {joined}  ".encode("utf-32-le"), dtype=np.uint32).astype(np.int64))
                total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
        some = np.flatnonzero(total)
        yield pa.record_batch({"gram": pa.array(some, pa.int32()), "c": pa.array(total[some], pa.int64())})

    rows = texts.select("_text").mapInArrow(run, "gram int, c bigint").groupBy("gram").agg(F.sum("c").alias("c")).collect()
    counts = np.zeros(SYMBOLS**3)
    for row in rows:
        counts[row["gram"]] = row["c"]
    return counts


def symbol_model(counts: np.ndarray) -> np.ndarray:
    """Natural log of P(c | a, b), interpolated over three orders (weights by how often the context was seen)."""
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 1) / (one + 1).sum()
    t2 = two.sum(axis=1, keepdims=True)
    p2 = (two + 5 * p1) / (t2 + 5)
    t3 = three.sum(axis=2, keepdims=True)
    return np.log((three + 5 * p2[None]) / (t3 + 5)).astype(np.float32)


class Decoder:
    """Most probable plain form of a disguised word or row of single letters."""

    def __init__(self, model: np.ndarray, remember: int = 100_000):
        self.model, self.remember, self.known, self.choices = model, remember, {}, {}
        self.flat = model.ravel().tolist()

    def __call__(self, text: str) -> str:
        found = self.known.get(text)
        if found is None:
            if len(self.known) >= self.remember:
                self.known.clear()
            found = self.known[text] = self._decode(text)
        return found

    def _lattice(self, text: str) -> Iterator[tuple[tuple[str, float, list[int]], ...]]:
        """For each place the possible letters (one or two of a repeated one, none for a separator), their cost and symbols."""
        text = text.lower()
        at, size = 0, len(text)
        while at < size:
            c = text[at]
            run = at + 1
            while run < size and text[run] == c:
                run += 1
            if c.isalpha():
                times, at = run - at, run
            elif c in DISGUISES:
                times, at = min(run - at, 2), run
            elif c.isalnum():  # a digit, or a number sign such as one half
                times, at = 1, at + 1
            else:
                c, times = " ", 1
                while at < size and not text[at].isalnum() and text[at] not in DISGUISES:
                    at += 1
            found = self.choices.get((c, min(times, 3)))
            if found is None:
                found = self.choices[c, min(times, 3)] = self._letters(c, times)
            yield found

    @staticmethod
    def _letters(c: str, times: int) -> tuple[tuple[str, float, list[int]], ...]:
        if c.isalpha():
            if times >= 3:
                found = [(c, STRETCH), (c * 2, STRETCH)]
            else:
                found = [(c * times, 0.0)] + ([(c, DOUBLED)] if times == 2 else [])
        elif c in DISGUISES:
            found = [(x * k, SWAP) for k in range(1, times + 1) for x in DISGUISES[c]] + [(c, PLAIN)]
        elif c.isalnum():
            found = [(c, PLAIN)]
        else:
            found = [("", SPACED), (" ", SPLIT)]
        points = lambda x: np.frombuffer(x.encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        return tuple((letters, extra, symbols(points(letters)).tolist()) for letters, extra in found)

    def _decode(self, text: str) -> str:
        model, size = self.flat, SYMBOLS * SYMBOLS
        # a state is the last two symbols as one number; its form is a chain of its last letters and the rest
        state, cost, done = BOUNDARY * SYMBOLS + BOUNDARY, 0.0, None
        states: dict | None = None  # where there is more than one
        for choices in (*self._lattice(text), _END):
            if states is None:
                if len(choices) == 1:
                    letters, extra, own = choices[0]
                    cost += extra
                    for s in own:
                        gram = state * SYMBOLS + s
                        cost += model[gram]
                        state = gram % size
                    done = (done, letters)
                    continue
                states = {state: (cost, done)}
            after: dict = {}
            for before, (cost, done) in states.items():
                for letters, extra, own in choices:
                    at, total = before, cost + extra
                    for s in own:
                        gram = at * SYMBOLS + s
                        total += model[gram]
                        at = gram % size
                    best = after.get(at)
                    if best is None or best[0] < total:
                        after[at] = (total, (done, letters))
            if len(after) == 1:
                [(state, (cost, done))] = after.items()
                states = None
            else:
                states = after
        if states is not None:
            done = max(states.values(), key=lambda v: v[0])[1]
        parts = []
        while done is not None:
            done, letters = done
            parts.append(letters)
        return "".join(reversed(parts)).strip()


#: What stands behind each stretch.
_END = ((" ", 0.0, [BOUNDARY]),)


class _Restored(dict):
    """Plain forms of stretches, empty where the words stay as they stand; signs at the ends may be mere punctuation."""

    def __init__(self, decoder: Decoder):
        self.decoder = decoder

    def __missing__(self, stretch: str) -> str:
        if not SUSPECT.search(stretch):  # then no part of it matches either
            self[stretch] = ""
            return ""
        first, last = 0, len(stretch)
        while last and not stretch[last - 1].isalnum():
            last -= 1
        while first < last and not stretch[first].isalnum():
            first += 1
        small, plain, found = stretch.lower(), None, []
        for form in dict.fromkeys((stretch, stretch[:last], stretch[first:last])):
            if form is stretch or SUSPECT.search(form):
                decoded = self.decoder(form)
                if decoded != small:
                    plain = _WORD.findall(small) if plain is None else plain
                    if _WORD.findall(decoded) != plain:
                        found.append(decoded)
        found = self[stretch] = " ".join(found)
        return found


#: What a code point is: a letter or sign, of a word, between words, white space, a letter, a sign. From WIDE on only regular expressions say.
_UNITS, _ALNUM, _GAP, _BLANK, _LETTER, _SIGN, WIDE = 1, 2, 4, 8, 16, 32, 0x3000


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """The kinds of all code points below WIDE as bits, and their small forms."""
    patterns = [(_UNITS, _UNIT), (_ALNUM, r"[^\W_]"), (_GAP, _BETWEEN), (_LETTER, r"[^\W\d_]"), (_SIGN, rf"[{_SIGNS}]")]
    patterns = [(bit, re.compile(pattern, re.IGNORECASE)) for bit, pattern in patterns]
    signs = [chr(i) for i in range(WIDE)]
    kinds = [sum(bit for bit, p in patterns if p.match(c)) + _BLANK * c.isspace() for c in signs]
    return np.array(kinds, dtype=np.uint8), np.array([ord(c.lower()[0]) for c in signs], dtype=np.uint32)


_KINDS: list = []


def _places(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of all stretches that SUSPECT may match, and whether SINGLES may match in each row.

    Says yes to all that the expressions find, and to little else; they are then tried on these alone.
    """
    if not _KINDS:
        _KINDS.extend(_kinds())
    kinds, small = _KINDS
    pad = " " * 4  # more than SINGLES goes over
    length = np.fromiter(map(len, texts), np.int64, len(texts)) + len(pad)
    points = np.frombuffer((pad + pad.join(texts) + pad).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    begin = np.cumsum(length) - length + len(pad)
    wide = points >= WIDE
    low = np.where(wide, 0, points)
    kind, fold = np.where(wide, 0, kinds[low]).astype(np.uint8), np.where(wide, points, small[low])
    is_ = lambda bit: (kind & bit) != 0
    blank, gap, alnum, unit = is_(_BLANK), is_(_GAP), is_(_ALNUM), is_(_UNITS)
    same = np.zeros(len(points) + 1, dtype=bool)
    same[1:-1] = fold[1:] == fold[:-1]

    # the ends of words and signs beside the separators between them; the padding separates at both ends
    turn = np.flatnonzero(gap[1:] != gap[:-1])
    left, right = turn[1:-1:2], turn[2::2] + 1
    odd = wide | is_(_SIGN) | (same[:-1] & is_(_LETTER))
    blanks = np.cumsum(blank, dtype=np.int32)
    odd[right[alnum[left] & alnum[right] & (blanks[right] == blanks[left])]] = True

    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    odds = np.concatenate([np.zeros(1, dtype=np.int32), np.cumsum(odd, dtype=np.int32)])
    some = odds[end] > odds[start]
    start, end = start[some], end[some]
    row = np.searchsorted(begin, start, side="right") - 1

    # two units beside one to three separators, the equal ones before and after them free on their outer side
    near = (right - left <= 4) & unit[left] & unit[right] & (~alnum[left - 1] | same[left]) & (~alnum[right + 1] | same[right + 1])
    single = np.zeros(len(texts), dtype=bool)
    for x, y in zip(left[near].tolist(), right[near].tolist()):
        first, last = x, y
        while same[first]:
            first -= 1
        while same[last + 1]:
            last += 1
        if (not alnum[first - 1] or (not alnum[x] and x > first)) and (not alnum[last + 1] or (not alnum[y] and last > y)):
            single[np.searchsorted(begin, x, side="right") - 1] = True
    single[np.searchsorted(begin, np.flatnonzero(wide), side="right") - 1] = True
    return row, start - begin[row], end - begin[row], single


def restored_rows(data: np.ndarray, offsets: np.ndarray, decoder: Decoder) -> list[str]:
    """For each row the plain forms of all its disguised stretches, as one text."""
    known = _Restored(decoder)
    whole = data.tobytes()
    texts = [whole[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    if not texts:
        return []
    found: list[list[str]] = [[] for _ in texts]
    rows, starts, ends, single = _places(texts)
    for row, start, end in zip(rows.tolist(), starts.tolist(), ends.tolist()):
        plain = known[texts[row][start:end]]
        if plain:
            found[row].append(plain)
    for row in np.flatnonzero(single).tolist():
        found[row] += [x for m in SINGLES.finditer(texts[row]) if (x := known[m.group()])]
    return [" ".join(x) for x in found]
