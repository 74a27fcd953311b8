"""The corpus operators against brute force, exact round trips and held-out rows, with odd rows in every table."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from runpulse.llm import queries as Q
from runpulse.llm.ann import nearest_neighbours
from runpulse.operators.components import connected_components
from runpulse.llm.decontamination import contained_items, decontaminated
from runpulse.llm.jaccard import jaccard_components, keep_one
from runpulse.llm.license_scan import PHRASES, scan_licenses
from runpulse.llm.lm_scoring import score_documents
from runpulse.llm.packing import best_two_fit, pack_documents
from runpulse.llm.quality import keep_good, quality_scores
from runpulse.llm.token_counts import token_counts
from runpulse.llm.toxicity import keep_civil, toxicity_scores
from runpulse.llm.url_filter import judge_urls

ODD = [
    (-1, None, None, None, None), (-2, "", "en", "x", 0), (None, "cc by cc by licence", None, None, None),
    (-4, "Mit LICENSE, apache license", "en", "x", 1), (-4, "Mit LICENSE, apache license", "en", "x", 1),
    (-5, "a<|endoftext|> b  c\x1cd é ́　 It's 3.5!", "en", "x", 1), (-6, " \n\t", "fr", "x", 2), (-7, "the cat sat " * 30_000, "en", "y", 3),
]


def words(text):
    return (text or "").encode().lower().split()


def shingle_set(text):
    w = words(text)
    return frozenset(b" ".join(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset({b" ".join(w)} if w else ())


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = spark.createDataFrame(ODD, table.schema)
    both = table.unionByName(more).withColumns({"score": F.lit("own"), "term": F.lit(1), "n": F.lit(None).cast("int")})
    path = f"{spark.conf.get('spark.checkpoint.dir')}/odd-documents"
    both.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def labels(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return table.unionByName(spark.createDataFrame([(None, 1, 1), (-1, None, None), (0, 1, 0)], table.schema))


def test_token_counts_are_the_library_s(docs):
    from tokenizers import Tokenizer

    path = Q.tokenizer_path(Q.COUNT_FILE)
    library = Tokenizer.from_file(path)
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, path).collect())
    want = collections.Counter()
    for r in docs.collect():
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        want[r.doc_id, len((r.text or "").encode()), n, n > 512] += 1
    assert got == want
    assert token_counts(docs.limit(0), path).count() == 0


def test_packing_round_trip(docs):
    from tokenizers import Tokenizer

    path = Q.tokenizer_path(Q.PACK_FILE)
    library = Tokenizer.from_file(path)
    rows = pack_documents(docs, path, with_ids=True).collect()
    want = collections.Counter()
    for r in docs.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 1]
        for at in range(0, len(ids), 4096):
            want[r.doc_id, at // 4096, at, tuple(ids[at : at + 4096])] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, tuple(r.ids)) for r in rows) == want
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for content in bins.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= 4096
    least = -(-sum(r.length for r in rows) // 4096)
    assert len(bins) <= 1.05 * least + 2
    assert pack_documents(docs.limit(0), path).count() == 0


def test_best_two_fit_replaces_the_smallest():
    # greedy takes 6 and 3 of 10; 6 + 2 + 2 fills the bin
    assert best_two_fit({6: 1, 3: 1, 2: 2}, 10)[0] == (1, [(6, 1), (2, 2)])
    counts = {random.Random(5).randint(1, 100) + k % 7: 1 + k % 3 for k in range(80)}
    made = collections.Counter()
    for times, content in best_two_fit(counts, 128):
        assert sum(n * c for n, c in content) <= 128
        for n, c in content:
            made[n] += c * times
    assert made == collections.Counter(counts)


def test_jaccard_components(spark, docs):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(90)]
    hot = " ".join(f"h{i}" for i in range(40))
    rows = []
    for i in range(200):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(90)] = f"z{rng.randrange(10**6)}"
        rows.append((-100 - i, " ".join(w[: rng.randint(50, 90)] if i % 3 == 0 else w)))
        rows.append((-1000 - i, hot + "".join(f" q{rng.randrange(10**6)}" for _ in range(rng.choice([8, 12, 40])))))
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    source = table.collect()
    sets = [shingle_set(r.text) for r in source]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)) and find(i) != find(j):
                k = len(a & b)
                if 4 * k >= 3 * (len(a) + len(b) - k):
                    parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(source):
        if r.doc_id is not None:
            least[find(i)] = min(least.get(find(i), 10**9), r.doc_id)
    want = collections.Counter((r.doc_id, len(sets[i]), least.get(find(i))) for i, r in enumerate(source))
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(table).collect())
    assert got == want
    assert jaccard_components(table.limit(0)).count() == 0


def test_keep_one_leaves_one_of_each_group(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(3, text, 1), (2, text + " x", 2), (2, text + " x", 2), (9, "other", 3), (None, None, 4), (7, None, 5)]
    got = keep_one(spark.createDataFrame(rows, "doc_id long, text string, cid int")).collect()
    assert collections.Counter(tuple(r) for r in got) == collections.Counter([rows[1], rows[3], rows[4], rows[5]])


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, k) for k in range(900, 960)] + [(5, 5), (None, 3), (2000, 2001)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(41)} | {k: 900 for k in [*range(900, 960), 1000]} | {2000: 2000, 2001: 2000}
    assert got == want


def test_contained_items(spark, docs, sf_dir):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = items.unionByName(
        spark.createDataFrame([(900, None), (901, ""), (902, "one two three"), (903, " ".join(f"w{i}" for i in range(600)))], items.schema)
    )
    text = items.first().text
    rows = [(-50, "x " * 5000 + text.upper() + " y" * 5000), (-51, "One two THREE"), (-52, " ".join(f"w{i}" for i in range(100, 700)))]
    table = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    want = set()
    for item in items.collect():
        own = shingle_set(item.text)
        for r in table.collect():
            k = len(own & shingle_set(r.text))
            if own and k >= 0.75 * len(own):
                want.add((r.doc_id, item.item_id, len(own), k))
    found = contained_items(table, items)
    assert {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in found.collect()} == want and (-50, items.first().item_id) in {w[:2] for w in want}
    bad = {w[0] for w in want}
    left = [r.doc_id for r in decontaminated(table, items).collect()]
    assert collections.Counter(left) == collections.Counter(r.doc_id for r in table.collect() if r.doc_id not in bad)
    assert contained_items(table.limit(0), items).count() == 0 == contained_items(table, items.limit(0)).count()


def test_license_phrases(docs):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    want = collections.Counter()
    for r in docs.collect():
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r.text or "").translate(table))
        at = [(i, label) for p, label in PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        places = [i for i, _ in at]
        want[r.doc_id, len(w), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))] += 1
    rows = scan_licenses(docs).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows) == want
    assert scan_licenses(docs.limit(0)).count() == 0


def test_license_notice_with_a_word_put_in(spark):
    rows = spark.createDataFrame([(1, "Licensed under the very Apache License, Version 2.0."), (2, "cc by nc 4.0")], "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in scan_licenses(rows).collect()}
    assert got[1][0] == "apache,apache-2.0" and got[2][0] == "cc-by"


def test_urls(spark):
    pages = spark.createDataFrame(
        [
            (1, "http://a.org/x", "<link href='https://b.net/es/1' rel=canonical>"), (2, "https://b.net/es/1#t", None),
            (3, "http://c.org/r?x", '<META http-equiv="Refresh" content="0; url=http://a.org/x?u=1">'),
            (4, "HTTP://Www.Example.com/en/q", ""), (5, "http://q.example.com/en/q", ""), (6, None, None), (7, "nourl", "<link rel=canonical href=/z>"),
            (8, "http://d.info", "<link rel=canonical href='/k/'>"), (9, "http://d.info/k/", "<meta http-equiv=refresh content='3;URL=//g.net/fr/'>"),
            (10, "http://e.info/", "<link rel=canonical href='http://g.net/fr/2'><link rel=canonical href='http://x.com/'>"),
        ],
        "page_id long, url string, html string",
    )
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, Q.URL_RULES).collect()}
    assert {k: v[3] for k, v in got.items()} == {
        1: "block", 2: "block", 3: "block", 4: "allow", 5: "block", 6: "allow", 7: "allow", 8: "block", 9: "block", 10: "allow"
    }
    assert got[4] == ("www.example.com", "/en/q", "www.example.com/en/", "allow") and got[8][:3] == ("d.info", "", None)
    assert judge_urls(pages.limit(0), Q.URL_RULES).count() == 0


def test_neighbours(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = table.collect()
    ids, m = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    odd = [(100_000, [0.0] * 64), (100_050, None), (100_100, [float("nan")] * 64), (None, [1.0] * 64), (100_150, [1.0, None])]
    every = table.select("vec_id", "embedding").unionByName(spark.createDataFrame(odd, "vec_id long, embedding array<float>"))
    hit = 0
    found = collections.defaultdict(dict)
    for r in nearest_neighbours(every, every.filter("vec_id % 50 = 0")).collect():
        found[r.query_id][r.rank] = r
    asked = np.flatnonzero(ids % 50 == 0)
    assert set(found) == set(ids[asked].tolist())
    for i in asked:
        score = unit @ unit[i]
        score[i] = -9
        best = np.lexsort((ids, -score))[:5]
        hit += len({r.vec_id for r in found[ids[i]].values()} & set(ids[best].tolist()))
        place = {v: k for k, v in enumerate(ids.tolist())}
        assert all(abs(r.score - score[place[r.vec_id]]) < 1e-12 for r in found[ids[i]].values())
    assert hit / (5 * len(asked)) >= 0.9


def test_scores_of_the_language_model(docs):
    rows = docs.collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    tokens = [[*words(r.text), None] for r in rows]
    c = collections.Counter(t for r, k in zip(rows, tokens) if not held(r.doc_id) for t in k)
    n, v = sum(c.values()), len(c)
    want = collections.Counter(
        (r.doc_id, held(r.doc_id), len(k), sum(c[t] > 0 for t in k), n, round(sum(np.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in k), 4))
        for r, k in zip(rows, tokens)
    )
    got = score_documents(docs).collect()
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_quality(spark, docs, labels):
    rows = quality_scores(docs, labels).collect()
    assert len(rows) == docs.count()
    known = {r.doc_id: r.quality for r in labels.collect()}
    kept = [r.keep for r in rows if known.get(r.doc_id) == 1]
    assert sum(kept) >= 0.97 * len(kept)
    junk = [r.keep for r in rows if known.get(r.doc_id) == 0]
    assert sum(junk) <= 0.5 * len(junk)
    good = keep_good(docs, labels)
    assert good.columns == docs.columns and good.count() == sum(r.keep for r in rows)
    assert keep_good(docs.limit(0), labels).count() == 0 and keep_good(docs, labels.limit(0)).count() == docs.count()


def test_toxicity(spark, labels):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    marks = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    plain = "And the thin of edor is reth that was for thand in ea."
    disguised = ["idi0t", "1d10t", "i d i o t", "m.o.r.o.n", "stuuupid", "$tupid", "p@thetic", "l o s e r", "tr4sh", "cl0wn"]
    rows = [(-100 - k, f"{plain} {w} {plain}", "en", "x", 1) for k, w in enumerate(disguised)] + [(-200, plain, "en", "x", 1), (-201, None, None, None, None)]
    every = table.unionByName(spark.createDataFrame(rows, table.schema)).withColumn("score", F.lit(1))
    got = {r.doc_id: r for r in toxicity_scores(every, marks).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert sum(got[-100 - k].predicted for k in range(len(disguised))) >= 8
    assert got[-200].predicted == got[-201].predicted == 0
    known = {r.doc_id: r.toxic for r in marks.collect()}
    held = [(known[i], r.predicted) for i, r in got.items() if i in known and r.held_out]
    assert np.mean([y == p for y, p in held]) >= 0.93
    civil = keep_civil(every, marks)
    assert civil.columns == every.columns and civil.count() == sum(1 - r.predicted for r in got.values())
    assert keep_civil(every.limit(0), marks).count() == 0 and keep_civil(every, marks.limit(0)).count() == every.count()


def test_pipeline_decisions(spark, sf_dir):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        left = stage(spark, docs, sf_dir)
        assert left.columns == docs.columns, name
        assert left.join(docs, docs.columns, "left_anti").count() == 0 and left.count() <= docs.count()
    assert P.run(spark, sf_dir).count() > 0
