"""Spelling variants, prefix trees of conversations and subtree totals against brute force, with odd rows in every table."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from runpulse.llm import queries as Q
from runpulse.llm.chat_format import conversation_digests, escaped, pack_trees, read_turns, unescaped
from runpulse.llm.prefix_trie import joined_digests, shared_openings, subtree_totals
from runpulse.llm.spelling_variants import damaged_runs, symbol_count, variant_forms
from runpulse.llm.turns import numbered

CONV = "conv_id bigint, turn bigint, role string, text string"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_forms(n, ratio=10):
    forms = {}
    for w in n:
        others = [x for x in n if near(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        forms[w] = (best if best is not None and n[best] >= ratio * n[w] and n[best] > n[w] else None, len(others))
    out = {}
    for w, (form, many) in forms.items():
        root = w
        while forms[root][0] is not None:
            root = forms[root][0]
        out[w] = (form, root, n[w], many, n[form] if form is not None else None)
    return out


def test_forms_equal_plain_search(spark):
    draw = random.Random(3)
    words = collections.Counter()
    for _ in range(120):
        word = "".join(draw.choice("abcdéÿx") for _ in range(draw.randint(1, 9)))
        words[word] += 10 ** draw.randint(0, 3)
        for _ in range(draw.randint(0, 3)):
            at = draw.randrange(len(word))
            words[draw.choice([word[:at] + word[at + 1 :], word[:at] + "e" + word[at:], word[:at] + "z" + word[at + 1 :]])] += draw.randint(0, 20)
    words["aaaaaaaa" * 5_000] += 1  # very long, runs of one symbol
    words["aaaaaaaa" * 4_999 + "aaaaaaa"] += 30
    words[""] += 2
    rows = [(w, n, "own", 1) for w, n in words.items()] + [(None, 4, "x", 2)]
    table = spark.createDataFrame(rows, "word string, n bigint, reduced string, root int")
    table = table.unionByName(spark.createDataFrame([("abab", None, "x", 3), ("abab", 3, "x", 3)], table.schema))
    words["abab"] += 3
    got = {r.word: tuple(r)[1:] for r in variant_forms(table).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == plain_forms(dict(words))
    assert variant_forms(table.limit(0)).count() == 0


def test_ties_go_to_the_first_word_and_roots_follow_forms(spark):
    rows = [("abcdefg", 1), ("abcdefh", 50), ("abcdefi", 50), ("abcdxfh", 600)]
    got = {r.word: (r.form, r.root) for r in variant_forms(spark.createDataFrame(rows, "word string, n bigint")).collect()}
    assert got == {"abcdefg": ("abcdefh", "abcdxfh"), "abcdefh": ("abcdxfh", "abcdxfh"), "abcdefi": (None, "abcdefi"), "abcdxfh": (None, "abcdxfh")}


def test_symbols_follow_the_vocabulary():
    assert [symbol_count(n) for n in (0, 1, 10**5, 10**9)] == [4, 4, 5, 14]


def test_damaged_runs_equal_plain_ones(spark, sf_dir):
    docs = Q.table(spark, sf_dir, "documents").select("doc_id", "text").withColumns({"run": F.lit("x"), "h": F.lit(1), "word": F.lit("own")})
    odd = [(None, "Naïveté Naïveté ÀÉÎÕÜßÿ abcdefg", "x", 1, "y"), (-1, None, "x", 1, "y"), (-2, "", "x", 1, "y"), (-3, "Wörterbuch " * 30_000, "x", 1, "y")]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    want = collections.Counter()
    for doc_id, text, *_ in docs.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                want[run] += 1
    assert {r.word: r["count"] for r in damaged_runs(docs).groupBy("word").count().collect()} == want


SAID = [
    "</s>[INST] ok [/INST]", "<\\/s>", "\\", "\\\\</s>", "[\\INST]", "<s><s>[/INST", "é　́ <|endoftext|>", "", "a\n b", "[[INST]", "<</s>", "</s",
]


def test_escapes_are_undone():
    for parts in itertools.product(SAID, repeat=2):
        text = "".join(parts)
        hidden = escaped(text)
        assert unescaped(hidden) == text
        assert not re.search(r"</?s>|\[/?INST\]", hidden)


@pytest.fixture(scope="module")
def talks(spark, sf_dir):
    draw = random.Random(5)
    rows = []
    for c in range(60):
        for t in range(draw.randint(0, 6)):
            rows.append((c, t, draw.choice(["user", "assistant", "</s>"]), draw.choice(SAID[:3])))
    rows += [(100 + c, t, "user", "same") for c in range(40) for t in range(3)]  # a large group of copies
    rows += [(7, None, None, None), (7, 2, "user", "tie"), (7, 2, "assistant", "tie"), (7, 2, "user", "tie"), (None, 1, "user", "no id"), (None, 0, "assistant", "no id")]
    rows += [(200, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(300)] + [(201, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(150)]
    rows += [(202, 0, "assistant", "long " * 100_000)]
    table = spark.createDataFrame(rows, CONV)
    table = table.unionByName(Q.table(spark, sf_dir, "conversations").withColumn("conv_id", F.col("conv_id") + 1000))
    return table.withColumns({c: F.lit("own") for c in ("place", "node", "path", "line", "says_0", "depth", "words")})


def plain_talks(table):
    talks = collections.defaultdict(list)
    for r in table.select("conv_id", "turn", "role", "text").collect():
        talks[r.conv_id].append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    return {c: [x[2:] for x in sorted(t)] for c, t in talks.items()}


def test_numbers_are_places_with_rows_in_many_tasks(spark):
    rows = [(k, v, i) for i, (k, v) in enumerate((k, v) for k in ("a", None, "b") for v in [None, *range(200), 7, 7])]
    got = numbered(spark.createDataFrame(rows, "k string, v int, i int"), ["k"], ["v"], ["v"]).collect()
    for key in ("a", None, "b"):
        own = sorted((r.place, -1 if r.v is None else r.v) for r in got if r.k == key)
        assert [p for p, _ in own] == list(range(1, 204)) and [v for _, v in own] == sorted(v for _, v in own)


def test_trees_give_back_every_conversation(spark, talks):
    path = Q.tokenizer_path(Q.COUNT_FILE)
    packed = pack_trees(talks, path)
    plain = plain_talks(talks)
    nodes = {r.node: r for r in packed.nodes.collect()}
    assert len(nodes) == len({tuple(t[:d]) for t in plain.values() for d in range(1, len(t) + 1)})  # shared turns are emitted once
    sequences = collections.defaultdict(dict)
    for r in nodes.values():
        for k, token in enumerate(r.ids):
            assert sequences[r.tree].setdefault(r.start + k, token) is token  # no two nodes overlap
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    ends = {}
    for r in sorted(packed.paths.collect(), key=lambda r: r.place):
        ends[r.conv_id] = r.node
    assert set(ends) == set(plain)
    for c, name in ends.items():
        end = nodes[name]
        seen = [sequences[end.tree][k] for a, b in end.attends for k in range(a, b)]
        assert len(seen) == end.position  # what a node attends to is its conversation so far
        want = "<s>" + "".join(f"[INST]{escaped(role)}[/INST]{escaped(text)}</s>" for role, text in plain[c])
        assert library.decode(seen + end.ids, skip_special_tokens=False) == want
    for tree, tokens in sequences.items():
        assert sorted(tokens) == list(range(len(tokens)))  # gapless
    for r in nodes.values():  # depth first: a parent comes before its children, and its branch is not interrupted
        if r.parent:
            above = nodes[r.parent]
            assert above.start + above.n_tokens <= r.start and above.depth + 1 == r.depth and above.tree == r.tree
    order = sorted((r.tree, r.start, r.depth) for r in nodes.values())
    assert all(b[2] <= a[2] + 1 for a, b in zip(order, order[1:]) if a[0] == b[0])
    got = {r.conv_id: r for r in conversation_digests(read_turns(packed, path)).collect()}
    for c, turns in plain.items():
        learned = [t for role, t in turns if role == "assistant"]
        r = got.pop(c)
        assert r.n_turns == len(turns) and r.loss_chars == len("".join(learned))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256("".join(learned).encode()).hexdigest()
    assert not got
    none = pack_trees(talks.limit(0), path)
    assert none.nodes.count() == 0 and read_turns(none, path).count() == 0


def plain_trie(plain):
    convs = {}
    for c, own in plain.items():
        if c is None:
            continue
        h = zlib.crc32(str(c).encode()) % 4
        convs[c] = plain.get(c - c % 20, [])[:h] + own[h:]
    nodes = collections.defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    kids = collections.Counter(k[:-1] for k in nodes if k)
    totals = collections.defaultdict(lambda: [0, 0])
    for key, members in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
        for d in range(len(key) + 1):
            totals[key[:d]][0] += key not in kids
            totals[key[:d]][1] += (len(members) - 1) * words
    out = set()
    for key, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(convs[c]) == len(key))
        above = min(nodes[key[:-1]]) if key else None
        out.add((min(members), len(key), above, len(members), kids[key], *totals[key], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def test_trie_equals_a_plain_one(spark, talks):
    plain = plain_talks(talks)
    got = [tuple(r) for r in shared_openings(talks).drop("node", "parent").collect()]
    assert len(got) == len(set(got)) and set(got) == plain_trie(plain)
    assert shared_openings(talks.limit(0)).count() == 0


def test_subtree_totals_equal_a_walk(spark):
    """A chain, a star, a random tree, a caterpillar and bushes, as one forest."""
    draw = random.Random(11)
    ups = [
        lambda k: k - 1, lambda k: 0, lambda k: draw.randrange(k), lambda k: max(0, k - 1 - k % 2), lambda k: max(0, k - 1 - draw.randrange(3)),
    ]
    parent = {(t, k): (t, up(k)) if k else None for t, up in enumerate(ups) for k in range(120)}
    value = {k: draw.choice([0, 1, -5, 10**12, None]) for k in parent}
    want = {k: 0 for k in parent}
    for k, v in value.items():
        while k is not None:
            want[k] += v or 0
            k = parent[k]
    rows = [(str(k), None if p is None else str(p), value[k]) for k, p in parent.items()]
    got = subtree_totals(spark.createDataFrame(rows, "node string, parent string, v bigint"), ["v"]).collect()
    assert {r.node: r.v for r in got} == {str(k): v for k, v in want.items()} and len(got) == len(rows)


def test_joined_digests(spark):
    rows = [("a", 10), ("a", 9), ("a", -3), ("b", 1)] + [("c", k) for k in range(70_000)]
    got = {r.group: r.digest for r in joined_digests(spark.createDataFrame(rows, "g string, m bigint"), "g", "m").collect()}
    want = {"a": "-3,9,10", "b": "1", "c": ",".join(map(str, range(70_000)))}
    assert got == {g: hashlib.sha256(t.encode()).hexdigest() for g, t in want.items()}
