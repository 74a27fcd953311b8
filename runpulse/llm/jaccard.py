"""Documents whose word shingles have a Jaccard similarity of 0.75 or more, by a token-group matrix.

1. Documents with the same shingle set form a class; everything below works on one document per class.
2. Classes that share a MinHash value are compared with the most central class that has it; the links found this way
   partition similar documents into groups. However large a family of near copies is, this takes one comparison
   per class and value.
3. The token-group matrix holds, for each shingle of the documents' prefixes, the groups whose union has it. A prefix is the
   first part of a set under one order for all, common shingles last; two linked documents share at least a known
   number of prefix shingles. A document that shares fewer with all others is dropped, and one that shares
   fewer with a group's union cannot be linked with any of its members.
4. Groups that qualify are opened: bitmaps of the document and of the members, block by block, leave the pairs that can be
   linked, and these are compared exactly, on whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from runpulse.operators.components import connected_components
from runpulse.llm.bit_filters import may_be_among, split_join
from runpulse.llm.columns import unused
from runpulse.llm.sampling import row_key
from runpulse.llm.words import mix, mix_in_place, pieces_of, row_sets, signed
from runpulse.session import cut_lineage, discard

#: Linked if UP * intersection >= LOW * union.
UP, LOW = 4, 3
#: MinHash values that form groups.
VALUES = 6
#: Shingles put last in the order: the most frequent ones, this many at most.
COMMON = 50_000
#: Text bytes per block in which shingles are counted, and the documents of a block a common one stands in.
COUNT_BYTES, COUNT_DOCS = 1 << 24, 3


def _prefix(n: np.ndarray) -> np.ndarray:
    """Length of the prefix of a set of n shingles: its first part under the common order.

    A linked partner lacks at most n/4 of the shingles, so it shares at least 1 + n/8 with the prefix.
    """
    return np.minimum(n, n // 4 + 1 + n // 8)


#: Least number of prefix shingles shared with any linked partner, whose set has 3/4 of the size at least.
NEEDED = "1L + ((3L * n + 3L) div 4L) div 8L"
#: Sizes fall into bands of this ratio; a linked partner is at most REACH bands away.
RATIO, REACH = 1.05, 6
#: Bits of a set's bitmap, and sets of a block.
BITS, BLOCK = 1024, 512


def _needed_in(n: str, band: str):
    """The same for partners whose size is in a band: the least overlap of two linked sets is 3/7 of both sizes."""
    low, high = F.pow(F.lit(RATIO), F.col(band)), F.pow(F.lit(RATIO), F.col(band) + 1)
    own = F.expr(f"least({n}, {n} div 4 + 1 + {n} div 8)") - F.col(n) + (F.col(n) + low) * (3 / 7)
    other = F.col(n) * (3 / 7) + high * (3 / 8 - 1 + 3 / 7) - 0.75
    return F.greatest(F.lit(1), F.ceil(F.least(own, other) - 1e-6))


def _common_shingles(texts: DataFrame, size: int) -> np.ndarray:
    """Frequent shingles, sorted: a bounded list that decides an order and no more; any list gives the same result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, bytes_ = [], 0

        def flush():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            some = counts >= COUNT_DOCS
            return pa.record_batch({"h": pa.array(signed(values[some])), "c": pa.array(counts[some], pa.int64())})

        for whole in batches:
            for batch in pieces_of(whole, "_text"):
                held.append(row_sets(batch.column("_text"), size)[0])
                bytes_ += batch.nbytes
                if bytes_ >= COUNT_BYTES:
                    yield flush()
                    held, bytes_ = [], 0
        if held:
            yield flush()

    counted = texts.select("_text").mapInArrow(run, "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c"))
    top = counted.orderBy(F.desc("c"), "h").limit(COMMON).select("h").collect()
    return np.sort(np.array([r.h for r in top], dtype=np.int64).view(np.uint64))


class _Listed:
    """Whether hashes are in a sorted list: a table of their first bits leaves few that have to be looked up."""

    FIRST = 20

    def __init__(self, values: np.ndarray):
        self.values = values
        self.some = np.zeros(1 << self.FIRST, dtype=bool)
        self.some[self._first(values)] = True

    def _first(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.FIRST)).view(np.int64)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        found = self.some[self._first(hashes)]
        maybe = np.flatnonzero(found)
        if len(maybe):
            at = np.minimum(np.searchsorted(self.values, hashes[maybe]), len(self.values) - 1)
            found[maybe] = self.values[at] == hashes[maybe]
        return found


def _members(texts: DataFrame, size: int, common) -> DataFrame:
    """`_id`, `_key`, size `n`, class `cid` (a hash of the set), MinHash `values` and number of common shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = _Listed(common.value)
        for whole in batches:
            for batch in pieces_of(whole, "_text"):
                hashes, n = row_sets(batch.column("_text"), size)
                turned, spare = np.empty_like(hashes), np.empty_like(hashes)
                begin = np.minimum(np.cumsum(n) - n, max(len(hashes) - 1, 0))
                least = []
                for k in range(VALUES):
                    np.bitwise_xor(hashes, np.uint64(0xA0761D6478BD642F * (2 * k + 1) % 2**64), out=turned)
                    mix_in_place(turned, spare)
                    low = np.minimum.reduceat(turned, begin) if len(hashes) else np.zeros(len(n), np.uint64)
                    least.append(low + np.uint64(k))
                whole_set = np.add.reduceat(mix(hashes), begin) if len(hashes) else np.zeros(len(n), np.uint64)
                cid = mix(whole_set + mix(n.astype(np.uint64)))
                empty = n == 0
                values = np.stack(least, axis=1)
                row = np.repeat(np.arange(len(n)), n)
                weight = np.bincount(row, listed(hashes), minlength=len(n)).astype(np.int64)
                yield pa.record_batch(
                    {
                        "_id": batch.column("_id"),
                        "_key": batch.column("_key"),
                        "n": pa.array(n, pa.int64()),
                        "cid": pa.array(signed(cid), mask=empty),
                        "values": pa.FixedSizeListArray.from_arrays(pa.array(signed(values.ravel())), VALUES).cast(
                            pa.list_(pa.int64())
                        ),
                        "weight": pa.array(weight),
                        "bits": _bitmaps(hashes, row, len(n)),
                    }
                )

    kind = texts.schema["_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"_id {kind}, _key bigint, n bigint, cid bigint, values array<bigint>, weight bigint, bits binary")


def _bitmaps(hashes: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    """A bit for each shingle of a set at a place given by its hash, BITS places per set."""
    on = np.zeros((rows, BITS), dtype=bool)
    on[row, (mix(hashes) % np.uint64(BITS)).astype(np.int64)] = True
    packed = np.packbits(on, axis=1)
    return pa.array([x.tobytes() for x in packed], pa.binary())


def _possible(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Pairs (`u`, `v`) of members (`grp`, `band`, `cid`, `n`, `bits`) of two parts that the bitmaps don't exclude.

    A part is a group's members of one size band; `pairs` names two of them (`grp`, `band`, `other`, `to`). Two sets differ
    in at least as many shingles as their bitmaps in bits. Parts meet in blocks of at most BLOCK members, whatever a
    group's size, and only pairs that can be linked leave the task. Blocks are cut from ranges of (group, band, class), so
    a large group is spread over tasks.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # rows of a part lie together
            if not batch.num_rows:
                continue
            grp, band = batch.column("grp").to_numpy(), batch.column("band").to_numpy()
            edges = np.flatnonzero(np.r_[True, (grp[1:] != grp[:-1]) | (band[1:] != band[:-1])])
            for first, last in zip(edges, [*edges[1:], len(grp)]):
                for at in range(first, last, BLOCK):
                    part = batch.slice(at, min(BLOCK, last - at))
                    yield pa.record_batch(
                        {
                            "grp": part.column("grp").slice(0, 1),
                            "band": part.column("band").slice(0, 1),
                            "cids": pa.array([part.column("cid").to_numpy().tobytes()], pa.binary()),
                            "sizes": pa.array([part.column("n").to_numpy().tobytes()], pa.binary()),
                            "maps": pa.array([b"".join(part.column("bits").to_pylist())], pa.binary()),
                        }
                    )

    near = members.select("grp", "band", "cid", "n", "bits")
    near = near.repartitionByRange("grp", "band", "cid").sortWithinPartitions("grp", "band")
    kind = "grp bigint, band int, cids binary, sizes binary, maps binary"
    blocks = cut_lineage(near.mapInArrow(pack, kind), "blocks")

    def side(mark: str, grp: str, band: str) -> DataFrame:
        parts = [F.col(c).alias(f"{mark}_{c}") for c in ("cids", "sizes", "maps")]
        return blocks.select(F.col("grp").alias(grp), F.col("band").alias(band), *parts)

    both = pairs.join(side("q", "grp", "band"), ["grp", "band"]).join(side("m", "other", "to"), ["other", "to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ones = np.array([bin(k).count("1") for k in range(256)], dtype=np.uint16)
        for batch in batches:
            for row in batch.to_pylist():
                qc, qn, mc, mn = (np.frombuffer(row[c], np.int64) for c in ("q_cids", "q_sizes", "m_cids", "m_sizes"))
                qb, mb = (np.frombuffer(row[c], np.uint8).reshape(-1, BITS // 8) for c in ("q_maps", "m_maps"))
                for a in range(len(qc)):
                    apart = np.maximum(ones[mb ^ qb[a]].sum(axis=1, dtype=np.int64), np.abs(mn - qn[a]))
                    # common = (sizes - differing) / 2, union = (sizes + differing) / 2
                    good = UP * (mn + qn[a] - apart) >= LOW * (mn + qn[a] + apart)
                    if good.any():
                        u = np.full(int(good.sum()), qc[a])
                        yield pa.record_batch({"u": pa.array(u, pa.int64()), "v": pa.array(mc[good], pa.int64())})

    return both.mapInArrow(run, "u bigint, v bigint")


def _set_id(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    begin = np.minimum(np.cumsum(n) - n, max(len(hashes) - 1, 0))
    return signed(mix(np.add.reduceat(mix(hashes), begin) + mix(n.astype(np.uint64))))


def _set_rows(texts: DataFrame, size: int) -> DataFrame:
    """`cid` and the sorted set, as bytes, of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces_of(whole, "_text"):
                hashes, n = row_sets(batch.column("_text"), size)
                if not len(hashes):
                    continue
                cuts = np.r_[0, np.cumsum(n)]
                sets = pa.array([hashes[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())
                yield pa.record_batch({"cid": pa.array(_set_id(hashes, n)), "set": sets}).filter(pa.array(n > 0))

    return texts.select("_text").mapInArrow(run, "cid bigint, set binary")


def _prefix_rows(texts: DataFrame, size: int, common) -> DataFrame:
    """One row (`token`, `cid`) per shingle of each document's prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = _Listed(common.value)
        for whole in batches:
            for batch in pieces_of(whole, "_text"):
                hashes, n = row_sets(batch.column("_text"), size)
                if not len(hashes):
                    continue
                row = np.repeat(np.arange(len(n)), n)
                late = listed(hashes)
                order = np.argsort(2 * row + late, kind="stable")  # a row's hashes ascend already
                place = np.arange(len(hashes)) - np.repeat(np.cumsum(n) - n, n)
                own = order[place < _prefix(n)[row]]
                cid = _set_id(hashes, n)[row[own]]
                yield pa.record_batch({"token": pa.array(signed(hashes[own])), "cid": pa.array(cid)})

    return texts.select("_text").mapInArrow(run, "token bigint, cid bigint")


def _shared(rows: DataFrame, owner: str) -> DataFrame:
    """The rows of a stored table whose `token` has more than one `owner`: its least and largest owner differ.

    Owners are added up before the shuffle, and the rows are then filtered by a join, which Spark splits where a token has many.
    """
    seen = rows.groupBy("token").agg(F.min(owner).alias("_low"), F.max(owner).alias("_high"))
    return rows.join(seen.filter("_low <> _high").select("token"), "token", "left_semi")


def _linked(pairs: DataFrame, texts: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """Those of the class pairs (`u`, `v`) that are linked, by their whole sets."""
    pairs = cut_lineage(pairs.filter("u <> v").distinct(), "pairs")
    wanted = pairs.select(F.col("u").alias("cid")).unionByName(pairs.select(F.col("v").alias("cid"))).distinct()
    keys = classes.join(wanted, "cid").select(F.col("_key").alias("k"), F.col("_id").alias("i"))
    keys = cut_lineage(keys, "wanted")
    own = texts.filter(may_be_among(F.xxhash64("_key", "_id"), keys.select(F.xxhash64("k", "i"))))
    own = own.join(keys.hint("shuffle_hash"), (F.col("_key") == F.col("k")) & F.col("_id").eqNullSafe(F.col("i")), "left_semi")
    sets = cut_lineage(_set_rows(own, size).dropDuplicates(["cid"]), "sets")
    of = lambda name, at: sets.select(F.col("cid").alias(at), F.col("set").alias(name))
    both = pairs.join(of("a", "u"), "u").join(of("b", "v"), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, dtype=bool)
            for k, (a, b) in enumerate(zip(batch.column("a"), batch.column("b"))):
                x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                if UP * min(len(x), len(y)) < LOW * max(len(x), len(y)):
                    continue
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                good[k] = UP * common >= LOW * (len(x) + len(y) - common)
            yield batch.select(["u", "v"]).filter(pa.array(good))

    linked = cut_lineage(both.mapInArrow(run, "u bigint, v bigint"), "linked")
    discard(pairs, keys, sets)
    return linked


def jaccard_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5
) -> DataFrame:
    """Rows `doc_id`, `n_shingles`, `component_id`, `class_id`: each document's set size, the smallest id of the documents it is
    linked with directly or through others (itself included), and the smallest id with the same set.

    Words are runs of characters other than ASCII white space, A-Z lower-cased; a set holds the distinct runs of `size`
    words, or the whole sequence of a shorter text. A text that is null, empty or without words has no shingles
    and stands alone. Equal rows each give a row. A null id is never the smallest; a document whose component has only null
    ids has a null one. Other columns are ignored. An empty table gives no rows.
    """
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    texts = texts.withColumn("_key", F.xxhash64(F.coalesce("_text", F.lit("")))).select("_id", "_key", "_text")
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(_common_shingles(texts, size))  # COMMON hashes at most
    members = cut_lineage(_members(texts, size, common), "members")
    classes = cut_lineage(
        members.filter("cid IS NOT NULL")
        .groupBy("cid")
        .agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_key")).alias("least"), F.min("n").alias("n"), F.min("values").alias("values"), F.min("weight").alias("weight"), F.min("bits").alias("bits"))
        .select("cid", "least._id", "least._key", "n", "values", "weight", "bits"),
        "classes",
    )
    # the class with most common shingles leads: in a family of copies that were changed here and there, the one nearest to all
    central = F.max(F.struct("weight", "cid")).getField("cid").alias("v")
    keyed = classes.select("cid", "weight", F.explode("values").alias("value"))
    leader = keyed.groupBy("value").agg(central, F.count("*").alias("many")).filter("many > 1")
    stars = keyed.join(leader, "value").select(F.col("cid").alias("u"), "v")
    links = _linked(stars, texts, classes, size)
    groups = _groups(classes, links)

    prefix = cut_lineage(_prefix_rows(texts, size, common), "prefix")
    tokens = cut_lineage(_shared(prefix, "cid").distinct(), "tokens")  # the documents of a class have the same rows
    discard(prefix)
    enough = tokens.groupBy("cid").agg(F.count("*").alias("k")).join(groups, "cid").filter(f"k >= {NEEDED}")
    owned = cut_lineage(tokens.join(enough.select("cid", "grp", "n"), "cid").select("token", "grp", "cid", "n"), "owned")
    across = _shared(owned, "grp").withColumn("band", F.floor(F.log(RATIO, "n")).cast("int"))
    across = cut_lineage(across, "matrix")
    discard(tokens, owned)
    # per band of partner sizes: how many prefix shingles stand in another group at all
    present = across.groupBy("token", F.col("band").alias("to")).agg(F.min("grp").alias("g1"), F.max("grp").alias("g2"))
    enough = across.groupBy("cid").agg(F.count("*").alias("k"), F.min("n").alias("n")).filter(f"k >= {NEEDED}")
    asked = across.join(enough.select("cid"), "cid", "left_semi")
    asked = asked.withColumn("to", F.explode(F.sequence(F.col("band") - REACH, F.col("band") + REACH)))
    seen = asked.join(present, ["token", "to"]).filter("g1 <> grp OR g2 <> grp")
    live = seen.groupBy("cid", "n", "to").agg(F.count("*").alias("k")).withColumn("need", _needed_in("n", "to")).filter("k >= need")
    asking = cut_lineage(seen.join(live.select("cid", "to", "k", "need"), ["cid", "to"]).select("token", "cid", "grp", "band", "to", "k", "need"), "query")
    discard(across)
    # any linked pair shares `need` of these shingles, so it meets in one that is not among the need - 1 most frequent of either
    spread = asking.groupBy("token").agg(F.count("*").alias("df"))
    order = Window.partitionBy("cid", "to").orderBy("df", "token")
    query = asking.join(spread, "token").withColumn("at", F.row_number().over(order)).filter("at <= k - need + 1")
    query = cut_lineage(query.select("token", "cid", "grp", "band", "to"), "rare")
    discard(asking)
    # the members of a group that ask the same are one row, so a family of copies meets each other group once a shingle
    matrix = query.select("token", "grp", "band", "to").distinct()
    met = matrix.select("token", F.col("grp").alias("other"), F.col("band").alias("to"), F.col("to").alias("band"))
    opened = matrix.join(met, ["token", "to", "band"]).filter("grp < other").select("grp", "band", "other", "to").distinct()
    opened = cut_lineage(opened, "opened")
    if not opened.isEmpty():
        # both members of a linked pair are among those that ask
        members_of = query.select("grp", "band", "cid").distinct().join(classes.select("cid", "n", "bits"), "cid")
        links = cut_lineage(links.unionByName(_linked(_possible(opened, members_of), texts, classes, size)), "links")
        groups = _groups(classes, links)
    named = groups.join(classes.select("cid", F.col("_id").alias("class_id")), "cid")
    smallest = named.groupBy("grp").agg(F.min("class_id").alias("component_id"))
    of_class = named.join(smallest, "grp").select("cid", "class_id", "component_id")
    done = members.select("_id", "n", "cid").join(of_class, "cid", "left")
    alone = F.col("cid").isNull()
    return done.select(
        F.col("_id").alias(doc_id),
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.col("_id")).otherwise(F.col("class_id")).alias("class_id"),
    )


def _groups(classes: DataFrame, links: DataFrame) -> DataFrame:
    """`cid`, its size `n` and its group `grp`: the smallest class connected with it by links."""
    parts = connected_components(links)
    joined = classes.select("cid", "n").join(parts, F.col("cid") == F.col("node"), "left")
    return cut_lineage(joined.select("cid", "n", F.coalesce("component", "cid").alias("grp")), "groups")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5) -> DataFrame:
    """One document of each component, the one with the smallest id (a null id counts as largest), with all its columns."""
    row = unused(docs, "_row")
    keyed = docs.withColumn(row, row_key(docs))
    parts = jaccard_components(keyed, row, text, size).select(row, "component_id").distinct()
    named = keyed.select(row, F.col(doc_id).alias("_id")).distinct().join(parts, row)
    first = F.min_by(row, F.struct(F.col("_id").isNull(), "_id", row))
    kept = cut_lineage(named.groupBy("component_id").agg(first.alias(row)).select(row), "kept")
    # a row that stands once and is kept needs no shuffle of its text
    times = keyed.groupBy(row).agg(F.count("*").alias("times")).join(kept.withColumn("kept", F.lit(True)), row, "left")
    doubtful = times.filter("kept IS NULL OR times > 1").select(row)
    return split_join(keyed, row, doubtful, lambda some: some.join(kept.hint("shuffle_hash"), row, "left_semi").dropDuplicates([row]))
