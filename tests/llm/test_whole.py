"""Places where a part of the job was once left out."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from runpulse.llm.deobfuscation import SYMBOLS, Decoder, restored_rows, symbol_model, symbols
from runpulse.llm.jaccard import _shared
from runpulse.llm.lm_scoring import score_documents
from runpulse.llm.words import column_bytes


def test_owners_with_more_rows_than_a_batch_keep_them_all(spark):
    owners = {1: {1: 25, 2: 3}, 2: {5: 30}, 3: {7: 2, 8: 40, 9: 40}, 4: {6: 1}}
    rows = [(t, g, 100 * g + k) for t, of in owners.items() for g, n in of.items() for k in range(n)]
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "4")
    try:
        got = _shared(spark.createDataFrame(rows, "token long, grp long, cid long"), "grp").collect()
    finally:
        spark.conf.set(name, before)
    assert sorted(map(tuple, got)) == [r for r in rows if len(owners[r[0]]) > 1]


def test_combined_disguises_are_decoded():
    plain = "the moron said an idiot like a loser and an ass to hate that stupid kid not dumb trash and pathetic clown " * 50
    s = symbols(np.array([ord(c) for c in f"  {plain}  "]))
    counts = np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3).astype(float)
    decoder = Decoder(symbol_model(counts))
    want = {
        "m 0 r 0 n": "moron", "m.0.r.0.n": "moron", "i - d - i - o - t": "idiot", "l053r": "loser", "a55": "ass", "@$$": "ass",
        "idi07": "idiot", "stuupid": "stupid", "i/d/i/o/t": "idiot", "s t u p 1 d": "stupid", "a s s": "ass", "(idi0t)": "idiot",
        "idi0t!": "idiot", "$tuupid,": "stupid", "m\u00b70\u00b7r\u00b70\u00b7n": "moron", "STuUPid": "stupid", "id-iot": "idiot",
    }
    rows = [f"the kid said {x} to the clown" for x in want]
    got = restored_rows(*column_bytes(pa.array([*rows, "", "the kid said that"])), decoder)
    missed = {x: g for (x, w), g in zip(want.items(), got) if w not in g.split()}
    assert not missed
    assert got[-2:] == ["", ""]
    seen = []
    restored_rows(*column_bytes(pa.array(["i h8 it"])), lambda x: seen.append(x) or "")
    assert "h8" in seen


def test_all_training_texts_reach_the_network(spark):
    rng = np.random.default_rng(5)
    some = [f"w{k}" for k in range(30)]
    train = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 5 != 1]
    rows = [(i, " ".join(rng.choice(some, 5)) if k % 2 else "left right " * 30) for k, i in enumerate(train)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.xxhash64("doc_id", "text"))
    # the 640 texts of smallest hash are all without the pair of words
    edge = frame.filter("text NOT LIKE 'left%'").approxQuantile("h", [0.5], 0.0)[0]
    frame = frame.filter(f"text NOT LIKE 'left%' OR h > {int(edge)}").drop("h")
    probe = next(i for i in range(5000, 9000) if zlib.crc32(str(i).encode()) % 5 == 1)
    every = frame.unionByName(spark.createDataFrame([(probe, "left right " * 30)], frame.schema)).coalesce(1)
    got = {r.doc_id: r for r in score_documents(every).collect()}[probe]
    assert got.held_out and got.score - got.base_score > 0.1 * got.n_tokens
