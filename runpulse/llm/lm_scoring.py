"""Log-likelihood of whole documents under a gated recurrent model, with corpus counts for the words it has no id for."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from runpulse.llm.gru import Gru
from runpulse.llm.postings import TermReader, document_sums, salted, term_postings
from runpulse.llm.sampling import in_fold
from runpulse.llm.words import column_bytes, lowered, mix, per_row, pieces_of, signed, span_hashes, word_spans
from runpulse.session import cut_lineage, discard

#: The end token's term; no word is hashed on purpose to it.
END = mix(np.array([0xE0D], dtype=np.uint64))
#: Most frequent words with an id (the end is one of them), and rest classes.
WORDS, REST = 1024, 64
#: Passes over all training texts; the weights of the shards are averaged after each.
ROUNDS, RATE = 2, 0.02
#: Tokens of a shard, which a task holds as one stream of two bytes a token, and stretches of it that are read side by side.
SHARD, LANES = 1 << 21, 128


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms of all tokens in order (each row ends with the end token), rest classes, and tokens per row."""
    data, offsets = column_bytes(column)
    data = lowered(data)
    starts, ends = word_spans(data, offsets)
    words, counts = span_hashes(data, starts, ends), per_row(starts, offsets)
    second = np.where(ends - starts > 1, data[np.minimum(starts + 1, max(len(data) - 1, 0))], 0) if len(starts) else starts
    pair = data[starts].astype(np.uint64) * np.uint64(256) + second.astype(np.uint64) if len(starts) else words
    terms = np.empty(len(words) + len(counts), dtype=np.uint64)
    kinds = np.zeros(len(terms), dtype=np.int64)
    last = np.cumsum(counts + 1) - 1
    inside = np.ones(len(terms), dtype=bool)
    inside[last] = False
    terms[last] = END[0]
    terms[inside] = words
    kinds[inside] = (mix(pair) % np.uint64(REST)).astype(np.int64)
    return terms, kinds, counts + 1


def term_counts(texts: DataFrame) -> DataFrame:
    """Rows (`term`, `rest`, `c`, `times`): how often each token stands in training texts, and in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces_of(whole, "_text", 1 << 24):
                terms, kinds, n = _tokens(batch.column("_text"))
                unique, first, at, times = np.unique(terms, return_index=True, return_inverse=True, return_counts=True)
                own = np.repeat(~batch.column("held_out").to_numpy(zero_copy_only=False), n)
                rows = pa.record_batch(
                    {
                        "term": pa.array(signed(unique)),
                        "rest": pa.array(kinds[first], pa.int32()),
                        "c": pa.array(np.bincount(at, own, minlength=len(unique)).astype(np.int64)),
                        "times": pa.array(times, pa.int64()),
                    }
                )
                yield from (rows.slice(a, 50_000) for a in range(0, rows.num_rows, 50_000))

    made = texts.select("held_out", "_text").mapInArrow(run, "term bigint, rest int, c bigint, times bigint")
    return made.groupBy("term", "rest").agg(F.sum("c").alias("c"), F.sum("times").alias("times"))


class _Ids:
    """Ids of tokens: frequent words by rank, others by rest class."""

    def __init__(self, vocabulary: np.ndarray):
        self.order = np.argsort(vocabulary)
        self.sorted = vocabulary[self.order]

    def __call__(self, terms: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.sorted, terms), len(self.sorted) - 1)
        return np.where(self.sorted[at] == terms, self.order[at], WORDS + kinds)


class _Scored(TermReader):
    """Terms of the postings, and the network's score of each text as a column of the head row."""

    def __init__(self, model):
        vocabulary, parameters, self.extra = model
        self.network = Gru(WORDS, REST, parameters=parameters)
        self.ids = _Ids(vocabulary)

    def read(self, column):
        terms, kinds, counts = _tokens(column)
        logs = self.network.score(self.ids(terms, kinds), counts, self.extra)
        return terms, counts, {"n_tokens": pa.array(counts, pa.int64()), "network": pa.array(logs / np.log(10))}


def _shards(training: DataFrame, vocabulary: np.ndarray, tokens: int) -> DataFrame:
    """Rows (`shard`, `turn`, `ids`): the ids of every training text, its shard and its place in it, by hashes of the row.

    There are as many shards as hold SHARD tokens each; neither their number nor what is in them depends on partitions.
    """
    count = max(1, -(-tokens // SHARD))
    place = F.xxhash64("_id", "_text")
    rows = training.select("_text", F.pmod(place, F.lit(count)).alias("shard"), F.xxhash64(F.lit(1), "_id", "_text").alias("turn"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids(vocabulary)
        for whole in batches:
            for batch in pieces_of(whole, "_text"):
                terms, kinds, counts = _tokens(batch.column("_text"))
                packed = ids(terms, kinds).astype(np.uint16)
                cuts = pa.py_buffer(np.r_[0, 2 * np.cumsum(counts)].astype(np.int32))
                binary = pa.Array.from_buffers(pa.binary(), len(counts), [None, cuts, pa.py_buffer(packed)])
                yield batch.drop_columns(["_text"]).append_column("ids", binary)

    return cut_lineage(rows.mapInArrow(run, "shard bigint, turn bigint, ids binary"), "training-ids")


def _fit(training: DataFrame, vocabulary: np.ndarray, totals: np.ndarray, tokens: int) -> Gru:
    """A network fitted on all training texts, whole.

    In each round every shard goes on from the same weights over its own texts, as one stream in their order, and the weights
    that come out are averaged by the tokens they have seen, in a tree; their size does not depend on the input.
    """
    network = Gru(WORDS, REST)
    network.start_from(totals)
    context = training.sparkSession.sparkContext
    shards = _shards(training, vocabulary, tokens)
    for number in range(ROUNDS):
        model = context.broadcast(network.p)
        rate = RATE * (1 - number / ROUNDS)

        def run(batches: Iterator[pa.RecordBatch], model=model, rate=rate) -> Iterator[pa.RecordBatch]:
            shard, held = None, []

            def learned():
                own = Gru(WORDS, REST, parameters={k: v.copy() for k, v in model.value.items()})
                stream = np.concatenate(held)
                own.train(stream, rate, LANES)
                flat = np.concatenate([own.p[k].ravel() for k in sorted(own.p)])
                return pa.record_batch({"seen": pa.array([len(stream)], pa.int64()), "weights": pa.array([flat.tobytes()], pa.binary())})

            for batch in batches:
                for number, ids in zip(batch.column("shard").to_pylist(), batch.column("ids")):
                    if number != shard:
                        if held:
                            yield learned()
                        shard, held = number, []
                    held.append(np.frombuffer(ids.as_buffer(), np.uint16).copy())
            if held:
                yield learned()

        ordered = shards.repartition("shard").sortWithinPartitions("shard", "turn")
        parts = ordered.mapInArrow(run, "seen bigint, weights binary").rdd
        each = parts.map(lambda r: (r["seen"], np.frombuffer(r["weights"], np.float32).astype(np.float64) * r["seen"]))
        seen, total = each.treeAggregate((0, 0.0), lambda x, y: (x[0] + y[0], x[1] + y[1]), lambda x, y: (x[0] + y[0], x[1] + y[1]))
        model.destroy()
        at = 0
        for k in sorted(network.p) if seen else ():
            shape, size = network.p[k].shape, network.p[k].size
            network.p[k] = (total[at : at + size] / seen).astype(np.float32).reshape(shape)
            at += size
    discard(shards)
    return network


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", remainder: int = 1, folds: int = 5) -> DataFrame:
    """Rows `doc_id`, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score` (log10).

    Tokens are the words (runs of characters other than ASCII white space, A-Z lower-cased) and one end per text.
    Texts whose id's crc32 leaves `remainder` are held out; all others are counted, whole. `base_score`
    is the smoothed unigram score. The model is a gated recurrent network over the WORDS most frequent tokens and
    REST rest classes of all other words; in a rest class a word has its smoothed share of the class's counts,
    so the whole vocabulary of the corpus, which grows with it, takes part. The network is fitted on all
    training texts, whole, in shards by hashes of the rows, so it does not depend on partitions (but for the last bits of
    the sums that average the shards); the counts are those of the whole corpus, joined to block postings. Very long texts are
    scored window by window, the state carried on.

    A null or empty text is the end token alone. A null id counts as training. Equal rows each give a row; other
    columns are ignored. An empty table gives no rows; without any training token all counts are 0.
    """
    texts = docs.select(
        F.col(doc_id).alias("_id"), F.col(text).alias("_text"), in_fold(F.col(doc_id), remainder, folds).alias("held_out")
    )
    training = texts.filter(~F.col("held_out"))
    whole_counts = cut_lineage(term_counts(texts), "counts")
    counts = whole_counts.filter("c > 0")
    end = int(signed(END)[0])
    top = counts.filter(F.col("term") != end).orderBy(F.desc("c"), "term").limit(WORDS - 1).collect()
    ends = counts.filter(F.col("term") == end).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    frequent = [end, *[r["term"] for r in top]]
    vocabulary = np.array(frequent, dtype=np.int64).view(np.uint64)
    # unused ids of a small corpus get terms that no text has
    vocabulary = np.concatenate([vocabulary, mix(np.arange(WORDS - len(vocabulary), dtype=np.uint64) + np.uint64(1 << 40))])
    listed = counts.sparkSession.createDataFrame([(t,) for t in frequent], "term bigint")  # WORDS rows at most
    rest = counts.join(F.broadcast(listed), "term", "left_anti")
    shares = {r["rest"]: (r["n"], r["v"]) for r in rest.groupBy("rest").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    n, v = (x or 0 for x in counts.agg(F.sum("c"), F.count("*")).first())
    totals = np.array([ends, *[r["c"] for r in top], *[0] * (WORDS - len(frequent)), *[shares.get(k, (0, 0))[0] for k in range(REST)]])
    network = _fit(training, vocabulary, totals, n)
    below = np.array([(shares.get(k, (0, 0))[0] + 0.5 * (shares.get(k, (0, 0))[1] + 1)) for k in range(REST)])
    extra = np.concatenate([np.zeros(WORDS), -np.log(below)])  # the other part, log(c + 0.5), comes with the counts
    model = docs.sparkSession.sparkContext.broadcast((vocabulary, network.p, extra))  # WORDS and REST bound its size

    rows = term_postings(texts, "_text", lambda: _Scored(model.value), step=1 << 24)
    values = whole_counts.select("term", "c", "times").join(F.broadcast(listed.withColumn("own", F.lit(1))), "term", "left")
    values = values.select("term", F.log10(F.col("c") + 0.5).alias("share"), (F.col("c") > 0).cast("double").alias("known"), "times", F.col("own").isNull().alias("is_rest"))
    joined = rows.join(salted(values, "times"), ["term", "salt"], "left")
    share = F.coalesce("share", F.log10(F.lit(0.5)))
    joined = joined.select(
        "block", "post", "head", share.alias("base"), F.coalesce("known", F.lit(0.0)).alias("known"),
        F.when(F.coalesce("is_rest", F.lit(True)), share).otherwise(0.0).alias("rest"),
    )
    kind = texts.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, held_out boolean, n_tokens bigint, network double, base double, known double, rest double"
    done = document_sums(joined, ["base", "known", "rest"], schema)
    whole = float(np.log10(n + 0.5 * (v + 1)))
    return done.select(
        F.col("_id").alias(doc_id), "held_out", "n_tokens", F.round("known").cast("bigint").alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * whole).alias("base_score"), (F.col("network") + F.col("rest")).alias("score"),
    )
