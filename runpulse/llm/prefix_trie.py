"""The trie of conversations' opening turns and totals of its subtrees, by parallel tree contraction.

A round first rakes the leaves: a leaf's total is final and is added to its parent. It then compresses unary chains: of each
chain, nodes no two of which are neighbours are taken out, and the child is hung on the grandparent with what the removed node
adds on its edge. A round is a few joins over what is left of the tree, which shrinks by a constant share whatever its shape, so
a chain of any length takes a logarithmic number of rounds. The removed nodes are then put back, last round first: the total of
each is that of its child then plus what was noted with it.
"""

from __future__ import annotations

from collections.abc import Iterator
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from runpulse.llm.turns import content_hashes, numbered, prefix_nodes, root_name
from runpulse.session import cut_lineage, discard

#: Characters of joined ids that travel as one row.
PIECE = 1 << 18


def subtree_totals(nodes: DataFrame, values: list[str], node: str = "node", parent: str = "parent") -> DataFrame:
    """Rows `node` and, for each of `values` (whole numbers, null counts as 0), its sum over the node and all below it.

    `nodes` has one row per node of a forest, with a null parent for roots; every other parent is a node. An empty table gives no rows.
    """
    own, edge = values, [f"_edge_{v}" for v in values]
    tree = nodes.select(
        F.col(node).alias("node"), F.col(parent).alias("up"),
        *[F.coalesce(F.col(v).cast("bigint"), F.lit(0)).alias(v) for v in values], *[F.lit(0).cast("bigint").alias(e) for e in edge],
    )
    tree, leaves, removed = cut_lineage(tree, "tree"), [], []
    while not tree.isEmpty():
        bare, raked = _rake(tree, own, edge)
        gone = _compress(raked, own, edge, len(leaves))
        rest = _without(raked, gone, own, edge)
        discard(tree, raked)
        leaves.append(bare)
        removed.append(gone)
        tree = rest
    known = None  # totals of the nodes that were left after a round
    for k in reversed(range(len(leaves))):
        if known is not None:
            back = removed[k].join(known.withColumnRenamed("node", "child"), "child")
            known = known.unionByName(back.select(F.col("out").alias("node"), *[(F.col(v) + F.col(f"_add_{v}")).alias(v) for v in own]))
        known = leaves[k] if known is None else cut_lineage(known.unionByName(leaves[k]), "totals")
    return nodes.select(F.col(node).alias("node"), *values).limit(0) if known is None else known


def _rake(tree: DataFrame, own: list[str], edge: list[str]) -> tuple[DataFrame, DataFrame]:
    """The leaves with their final totals, and the other nodes with the leaves' totals and how many children are left."""
    kids = tree.filter("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(F.count("*").alias("kids"))
    marked = cut_lineage(tree.join(kids, "node", "left"), "marked")
    leaves = marked.filter("kids IS NULL")
    given = leaves.filter("up IS NOT NULL").groupBy(F.col("up").alias("node")).agg(
        F.count("*").alias("_gone"), *[F.sum(F.col(v) + F.col(e)).alias(f"_give_{v}") for v, e in zip(own, edge)]
    )
    rest = marked.filter("kids IS NOT NULL").join(given, "node", "left").select(
        "node", "up", (F.col("kids") - F.coalesce("_gone", F.lit(0))).alias("kids"),
        *[(F.col(v) + F.coalesce(f"_give_{v}", F.lit(0))).alias(v) for v in own], *edge,
    )
    final, raked = cut_lineage(leaves.select("node", *own), "leaves"), cut_lineage(rest, "raked")
    discard(marked)
    return final, raked


def _compress(raked: DataFrame, own: list[str], edge: list[str], turn: int) -> DataFrame:
    """The nodes taken out of chains (`out`), their `child`, its new parent `up`, new edge values and what it adds to `out`'s total.

    Of neighbouring nodes with one child each, those with the locally largest random number are taken.
    """
    draw = lambda c: F.struct(F.xxhash64(F.lit(turn), c), F.col(c))
    chain = raked.filter("kids = 1 AND up IS NOT NULL")
    above = chain.select(F.col("node").alias("up"), draw("node").alias("_above"))
    out = chain.join(above, "up", "left").filter(F.col("_above").isNull() | (F.col("_above") < draw("node")))
    out = out.select(
        F.col("node").alias("out"), draw("node").alias("_own"), F.col("up").alias("_to"),
        *[F.col(v).alias(f"_out_{v}") for v in own], *[F.col(e).alias(f"_out{e}") for e in edge],
    )
    below = raked.select(
        F.col("node").alias("child"), F.col("up").alias("out"), F.when(F.col("kids") == 1, draw("node")).alias("_below"), *edge
    )
    met = out.join(below, "out").filter(F.col("_below").isNull() | (F.col("_below") < F.col("_own")))
    gone = met.select(
        "out", "child", F.col("_to").alias("up"),
        *[(F.col(f"_out_{v}") + F.col(e)).alias(f"_add_{v}") for v, e in zip(own, edge)],
        *[(F.col(f"_out_{v}") + F.col(e) + F.col(f"_out{e}")).alias(e) for v, e in zip(own, edge)],
    )
    return cut_lineage(gone, "removed")


def _without(raked: DataFrame, gone: DataFrame, own: list[str], edge: list[str]) -> DataFrame:
    moved = gone.select(F.col("child").alias("node"), F.col("up").alias("_up"), *[F.col(e).alias(f"_new{e}") for e in edge])
    kept = raked.join(gone.select(F.col("out").alias("node")), "node", "left_anti").join(moved, "node", "left")
    return cut_lineage(
        kept.select("node", F.coalesce("_up", "up").alias("up"), *own, *[F.coalesce(f"_new{e}", e).alias(e) for e in edge]), "tree"
    )


def joined_digests(members: DataFrame, group: str, member: str) -> DataFrame:
    """Rows `group` and `digest`: SHA-256 (lower-case hex) of a group's members as text, ascending, with commas between.

    Members are sorted over all tasks and joined to long texts where they lie; only these texts meet in the task that feeds
    them to the hash one after the other, holding one at a time.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, held, size = None, None, [], 0

        def row():
            return pa.record_batch({"group": [now], "first": pa.array([first], pa.int64()), "text": [",".join(held)]})

        for batch in batches:
            for g, m in zip(batch.column("group").to_pylist(), batch.column("member").to_pylist()):
                if held and (g != now or size > PIECE):
                    yield row()
                    held, size = [], 0
                if not held:
                    now, first = g, m
                held.append(str(m))
                size += len(held[-1]) + 1
        if held:
            yield row()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def row():
            return pa.record_batch({"group": [now], "digest": [state.hexdigest()]})

        for batch in batches:
            for g, text in zip(batch.column("group").to_pylist(), batch.column("text").to_pylist()):
                if g != now:
                    if state is not None:
                        yield row()
                    now, state = g, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
        if state is not None:
            yield row()

    rows = members.select(F.col(group).alias("group"), F.col(member).cast("bigint").alias("member"))
    spread = rows.repartitionByRange("group", "member").sortWithinPartitions("group", "member")
    pieces = spread.mapInArrow(join, "group string, first bigint, text string")
    met = pieces.repartition("group").sortWithinPartitions("group", "first")
    return met.mapInArrow(digest, "group string, digest string")


def opening_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct sequence of opening turns: `conv_id` (smallest member), `depth`, `parent_conv_id`, `n_convs`, `n_children`,
    `n_leaves` (childless nodes of the subtree), `saved_tokens` (words of last turns that sharing the subtree's nodes saves), `ends_sha256`
    (of the ids of those that end there), `node`, `parent`.

    `turns` has `conv_id`, `depth` (from 1, without gaps), `says_0`, `says_1` and `words`; `convs` has each `conv_id` and its `length`,
    0 for one without turns, which is a member of the root only. Without conversations there is no root and no row.
    """
    placed = prefix_nodes(turns, ["conv_id"], "depth").select("conv_id", "depth", "node", "parent", "words")
    placed = cut_lineage(placed, "placed")
    # all but the counted columns follow from the node
    nodes = placed.groupBy("node", "parent", "depth", "words").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    top = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0").select(
        root_name().alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("bigint").alias("depth"),
        F.lit(0).cast("bigint").alias("words"), "n_convs", "conv_id",
    )
    nodes = nodes.select(top.columns).unionByName(top)
    nodes = cut_lineage(nodes, "nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = cut_lineage(nodes.join(children, "node", "left").fillna(0, ["n_children"]), "nodes")
    weighed = nodes.withColumn("n_leaves", (F.col("n_children") == 0).cast("bigint"))
    weighed = weighed.withColumn("saved_tokens", (F.col("n_convs") - 1) * F.col("words"))
    totals = subtree_totals(weighed, ["n_leaves", "saved_tokens"])
    last = placed.select("conv_id", "depth", "node").join(convs, "conv_id").filter("depth = length").select("conv_id", "node")
    last = last.unionByName(convs.filter("length = 0").select("conv_id", root_name().alias("node")))
    ends = joined_digests(last, "node", "conv_id").select(F.col("group").alias("node"), F.col("digest").alias("ends_sha256"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        nodes.join(totals, "node").join(above, "parent", "left").join(ends, "node", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"), "node", "parent",
        )
    )


def word_count(text: str | Column) -> Column:
    return F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("bigint")


def shared_openings(conversations: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """The trie (see `opening_trie`) of conversations that open with turns of another one.

    Every `conv_id` c opens with the first h turns of conversation c - c % `group` (all it has; none if there is no such
    conversation), h being crc32 of c in decimal modulo `most`, and goes on with its own turns after its first h.

    Turns are ordered by `turn`, null first; equal ones by role and text, and rows that are equal throughout each count. A null
    role or text is empty. Rows with a null `conv_id` belong to no conversation. Texts are taken whole. Other columns are ignored. An
    empty table gives no rows.
    """
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).filter("conv_id IS NOT NULL")
    rows = rows.withColumns({f"says_{k}": c for k, c in enumerate(content_hashes())}).withColumn("words", word_count("text"))
    says = ["says_0", "says_1", "words"]
    own = cut_lineage(numbered(rows, ["conv_id"], ["turn", "role", "text"], says), "own-turns")
    lengths = own.groupBy("conv_id").agg(F.count("*").alias("own"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most))
    convs = lengths.select("conv_id", "own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    bases = lengths.select(F.col("conv_id").alias("base"), F.col("own").alias("_has"))
    taken = F.least("h", F.coalesce("_has", F.lit(0)))
    convs = convs.join(bases, "base", "left").withColumn("taken", taken)
    convs = cut_lineage(convs.withColumn("length", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).drop("_has", "own"), "convs")
    tail = own.join(convs.select("conv_id", "h", "taken"), "conv_id").filter("place > h")
    tail = tail.select("conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), *says)
    heads = own.filter((F.col("place") < most) & (F.col("conv_id") % group == 0)).withColumnRenamed("conv_id", "base")
    heads = heads.join(convs.select("conv_id", "base", "h"), "base").filter("place <= h")
    turns = tail.unionByName(heads.select("conv_id", F.col("place").alias("depth"), *says))
    return opening_trie(turns, convs.select("conv_id", "length"))
