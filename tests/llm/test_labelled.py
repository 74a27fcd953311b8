"""All labelled texts are learned from, however many there are."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from runpulse.llm.deobfuscation import SYMBOLS, Decoder, restored_rows, symbol_model
from runpulse.llm.quality import quality_scores
from runpulse.llm.toxicity import toxicity_scores
from runpulse.llm.words import column_bytes


@pytest.fixture(scope="module")
def many(spark):
    """20,300 labelled documents; the 300 of largest id hash are not like the others."""
    ids = [i for i in range(30_000) if zlib.crc32(str(i).encode()) % 5][:20_300]
    frame = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    late = [r.doc_id for r in frame.orderBy(F.desc(F.xxhash64("doc_id")), F.desc("doc_id")).limit(300).collect()]
    return ids, set(late)


def _frames(spark, many, late_text, label):
    ids, late = many
    rows = [(i, late_text(i) if i in late else f"ab{i % 7} cd{i % 11} ef", "en") for i in ids]
    docs = spark.createDataFrame([*rows, (90_001, late_text(5), "en"), (90_002, "ab1 cd2 ef", "en")], "doc_id long, text string, lang string")
    return docs, spark.createDataFrame([(i, label(i in late)) for i in ids], "doc_id long, label int")


def test_toxic_words_beyond_the_first_20000_are_known(spark, many):
    docs, labels = _frames(spark, many, lambda i: f"ab{i % 7} zonk cd{i % 11} ef", int)
    got = {r.doc_id: r for r in toxicity_scores(docs, labels, label="label").filter("doc_id > 90000").collect()}
    assert (got[90_001].predicted, got[90_002].predicted) == (1, 0)


def test_trusted_texts_beyond_the_first_20000_are_known(spark, many):
    docs, labels = _frames(spark, many, lambda i: "щука жила в реке", lambda late: 1)
    got = {r.doc_id: r for r in quality_scores(docs, labels, label="label").filter("doc_id > 90000").collect()}
    assert got[90_001].perplexity < 5 and got[90_002].perplexity < 5


def test_number_signs_end():
    decoder = Decoder(symbol_model(np.ones(SYMBOLS**3)))
    assert len(restored_rows(*column_bytes(pa.array(["½ cup ll½! a½b", "Ⅷ. a-½", "漢 b . c"])), decoder)) == 3
