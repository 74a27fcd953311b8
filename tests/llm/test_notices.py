"""Notices with one edit, and the scan against its statement on edited and shuffled notices."""

import random

import duckdb
import pytest

from runpulse.llm import queries as Q
from runpulse.llm.license_scan import NOTICES, PHRASES, license_spans, scan_licenses


def _edits(words):
    """Every way to put a word in or leave one out between the first and the last."""
    for k in range(1, len(words)):
        yield " ".join(words[:k] + ["zebra"] + words[k:])
    for k in range(1, len(words) - 1):
        yield " ".join(words[:k] + words[k + 1 :])


def test_every_notice_survives_one_edit(spark):
    cases = [(f"So: {t}; end.", label, text) for text, label in NOTICES for t in _edits(text.split())]
    docs = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: (r.labels.split(","), r.score) for r in scan_licenses(docs).collect()}
    whole = {f"So: {text}; end.": label for text, label in NOTICES}
    for i, (text, label, _) in enumerate(cases):
        assert whole.get(text, label) in got[i][0], text  # an edit may make it another notice, whole
        assert got[i][1] >= 0.5


def test_whole_notices_and_replaced_words(spark):
    texts = [t for t, _ in NOTICES] + [
        "licensed under cc by nd 4 0", "licensed under cc zero nc 4 0", "released under the bsd license", "released by the mit license",
        "under the mit license", "released under the", "", None, "mit", "license license mit license mit license cc by cc by cc",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in scan_licenses(docs).collect()}
    bases = {label for _, label in PHRASES}
    for i, (_, label) in enumerate(NOTICES):
        assert set(got[i].labels.split(",")) - bases == {label} and got[i].score == 1.0
    at = len(NOTICES)
    assert got[at].labels == "cc-by,cc-by-4.0" and got[at].score == 1.0  # the phrase is whole, the notice has a word put in
    assert [got[at + k].labels for k in range(1, 9)] == ["", "", "mit", "mit", "", "", "", ""]
    assert (got[at + 9].n_base, got[at + 9].first_word, got[at + 9].last_word, got[at + 9].labels) == (4, 2, 8, "cc-by,mit")
    found = license_spans(docs.filter(f"doc_id = {at}"), ["doc_id"], "text").filter("NOT base").collect()
    assert [(r.label, r.start, r.score) for r in found] == [("cc-by-4.0", 0, 4 / 5)]


@pytest.mark.parametrize("seed", range(2))
def test_scan_equals_its_statement(spark, fresh, seed):
    rng, texts = random.Random(seed), []
    for i in range(400):
        parts = []
        for _ in range(rng.randint(0, 4)):
            words = rng.choice(NOTICES + PHRASES)[0].split()
            for _ in range(rng.randint(0, 3)):
                k = rng.randrange(len(words) + 1)
                words = rng.choice([words[:k] + words[k + 1 :], words[:k] + [rng.choice(["the", "cc", "x"])] + words[k:], words[:k] + words[max(k - 2, 0) :]])
            parts.append(" ".join(words))
        texts.append((i, rng.choice([" ", " x ", "; "]).join(parts)))
    path = fresh()
    spark.createDataFrame([*texts, (-1, None)], "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{path}/documents.parquet/*.parquet'")
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    want = sorted(con.execute(f"SELECT {', '.join(names)} FROM ({Q.ORACLES['op9_license_scans']})").fetchall())
    assert sorted(map(tuple, Q.op9_license_scans(spark, path).collect())) == want
    assert len({r[6] for r in want}) > 20
