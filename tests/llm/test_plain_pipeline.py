"""The quality model and the pipeline's stages, each on what its predecessor kept, against plain versions."""

import collections
import math

from tokenizers import Tokenizer

import corpus_pipeline as P
from runpulse.llm import queries as Q
from runpulse.llm.quality import quality_scores
from runpulse.session import cut_lineage


def _shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def _grams(text):
    s = "\x01\x01" + "".join("0" if "0" <= c <= "9" else c for c in text or "") + "\x02"
    return [s[i : i + 3] for i in range(len(s) - 2)]


def _discounted(counts):
    n = [sum(c == k for c in counts.values()) or 0.5 for k in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1])
    d = [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.1), k - 0.1) for k in (1, 2, 3)]
    total, free, left = collections.Counter(), collections.Counter(), {}
    for gram, c in counts.items():
        off = d[min(c, 3) - 1]
        left[gram] = c - off
        total[gram[:-1]] += c
        free[gram[:-1]] += off
    return left, total, free


def _plain_model(texts):
    three = collections.Counter(g for t in texts for g in _grams(t))
    two = collections.Counter(g[1:] for g in three)
    one = collections.Counter(g[1:] for g in two)
    (l3, t3, f3), (l2, t2, f2), (l1, t1, f1) = map(_discounted, (three, two, one))

    def p(g):
        p1 = (l1.get(g[2:], 0) + f1[""] / (len(one) + 1)) / t1[""]
        p2 = (l2.get(g[1:], 0) + f2[g[1]] * p1) / t2[g[1]] if t2[g[1]] else p1
        return (l3.get(g, 0) + f3[g[:2]] * p2) / t3[g[:2]] if t3[g[:2]] else p2

    return p


def test_bits_are_those_of_a_plain_kneser_ney_model(spark, sf_dir):
    docs, labels = Q.table(spark, sf_dir, "documents"), Q.table(spark, sf_dir, "labels")
    trusted = {r.doc_id for r in labels.collect() if r.quality == 1}
    rows = docs.collect()
    p = _plain_model([r.text for r in rows if r.doc_id in trusted])
    got = {r.doc_id: r for r in quality_scores(docs, labels).collect()}
    for r in rows:
        grams = collections.Counter(_grams(r.text))
        n = sum(grams.values())
        assert got[r.doc_id].n_grams == n
        assert math.isclose(got[r.doc_id].bits, -sum(c * math.log2(p(g)) for g, c in grams.items()) / n, rel_tol=1e-9)


def _kept_copies(rows):
    sets, link = [_shingles(r.text) for r in rows], list(range(len(rows)))

    def top(i):
        while link[i] != i:
            i = link[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                link[top(i)] = top(j)
    groups = collections.defaultdict(list)
    for i, r in enumerate(rows):
        groups[top(i)].append(r.doc_id)
    return {min(g) for g in groups.values()}


def _kept_uncontaminated(rows, items):
    wanted = [s for s in map(_shingles, items) if s]
    return {r.doc_id for r in rows if not any(len(s & d) >= 0.75 * len(s) for d in [_shingles(r.text)] for s in wanted)}


def test_stages_on_their_predecessors_output(spark, sf_dir):
    docs = Q.table(spark, sf_dir, "documents")
    items = [r.text for r in Q.table(spark, sf_dir, "benchmark").collect()]
    toxic = {r.doc_id for r in Q.table(spark, sf_dir, "labels").collect() if r.toxic == 1}
    kept = {}
    for name, stage in P.STAGES[:-1]:
        before = docs.collect()
        docs = cut_lineage(stage(spark, docs, sf_dir), f"plain-{name}")
        after = kept[name] = docs.collect()
        assert len(after) == len({r.doc_id for r in after}) and set(after) <= set(before), name
        gone = {r.doc_id for r in before} - {r.doc_id for r in after}
        if name == "toxicity":
            assert gone <= toxic or len(gone - toxic) <= 0.02 * len(before)
        if name == "quality":
            assert len(gone) <= 0.3 * len(before)
        if name == "near_duplicates":
            assert {r.doc_id for r in after} == _kept_copies(before) and gone
        if name == "decontamination":
            assert {r.doc_id for r in after} == _kept_uncontaminated(before, items) and gone
    tokens = Tokenizer.from_file(Q.tokenizer_path(Q.PACK_FILE))
    want = {r.doc_id: len(tokens.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in kept["decontamination"]}
    pieces = P.packing(spark, docs, sf_dir).collect()
    sizes, bins = collections.Counter(), collections.defaultdict(list)
    for r in pieces:
        sizes[r.doc_id] += r.length
        bins[r.sequence_id].append((r.offset, r.length))
    assert sizes == want
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
