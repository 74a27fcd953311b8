"""Conversations as token sequences that share their openings: prefix trees, written depth-first.

Conversations that begin with the same turn form a tree, whose nodes are their distinct sequences of opening turns. The tokens of a
node's last turn are written once. A node's `position` is the number of tokens before it in its own conversation, so position
ids restart where a branch leaves the trunk, and `attends` names the stretches of the tree's sequence that its ancestors fill: a
token sees these, and what stands before it in its own node.

A turn is written `[INST]role[/INST]text</s>`, the first one of a conversation after `<s>`. In roles and texts a backslash is doubled and
these four control strings are broken by a backslash after their first character, so none of them can be forged, and
taking the backslashes out again gives back what was said.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple
import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from runpulse.llm.turns import content_hashes, joined, numbered, prefix_nodes, running_sums
from runpulse.llm.words import pieces_of
from runpulse.session import cut_lineage

#: The control strings of the template.
BEGIN, OPEN, CLOSE, END = "<s>", "[INST]", "[/INST]", "</s>"
#: The role that a model learns to speak.
LEARNED = "assistant"
#: Bytes of text that are tokenized at once.
STEP = 1 << 20

_BREAK = re.compile(r"\\|<(?=/?s>)|\[(?=/?INST\])")
_MEND = re.compile(r"\\(\\?)")
_TURN = re.compile(r"(?s)(?:<s>)?\[INST\](.*?)\[/INST\](.*)</s>")


def escaped(text: str) -> str:
    return _BREAK.sub(lambda m: m[0] + "\\", text)


def unescaped(text: str) -> str:
    return _MEND.sub(r"\1", text)


class PackedTrees(NamedTuple):
    """`nodes`: `tree`, `node`, `parent` (null for a first turn), `depth`, `n_convs`, `start` (place of its first token in the tree's
    sequence), `position`, `n_tokens`, `ids`, `loss_start` and `loss_end` (its tokens under the loss mask), `attends`. `paths`: `conv_id`,
    `place` and `node`: the nodes of each conversation in order."""

    nodes: DataFrame
    paths: DataFrame


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True  # their strings in a text are ordinary text
    made.no_truncation()
    made.no_padding()
    return made


def _tokens(turns: DataFrame, path: str) -> DataFrame:
    """Add the tokens of each turn; the text goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for whole in batches:
            for batch in pieces_of(whole, "text", STEP):
                depth, role, text = (batch.column(c).to_pylist() for c in ("depth", "role", "text"))
                parts = []
                for d, r, t in zip(depth, role, text):
                    parts += [f"{BEGIN if d == 1 else ''}{OPEN}{escaped(r)}{CLOSE}", escaped(t), END]
                ids = [x.ids for x in tokenizer.encode_batch(parts, add_special_tokens=False)]
                rows = [head + body + tail for head, body, tail in zip(ids[::3], ids[1::3], ids[2::3])]
                learned = np.array([r == LEARNED for r in role], dtype=bool)
                begin = np.array([len(x) for x in ids[::3]], dtype=np.int64)
                end = begin + np.array([len(x) for x in ids[1::3]], dtype=np.int64)
                out = batch.drop_columns(["role", "text"])
                out = out.append_column("ids", pa.array(rows, pa.list_(pa.int32())))
                out = out.append_column("n_tokens", pa.array([len(x) for x in rows], pa.int64()))
                out = out.append_column("loss_start", pa.array(begin, mask=~learned))
                yield out.append_column("loss_end", pa.array(end, mask=~learned))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in turns.schema if f.name not in ("role", "text"))
    return turns.mapInArrow(run, f"{kinds}, ids array<int>, n_tokens bigint, loss_start bigint, loss_end bigint")


def pack_trees(conversations: DataFrame, tokenizer: str) -> PackedTrees:
    """The prefix trees of conversations as tokens of the tokenizer in the file `tokenizer`, a byte-level one.

    Turns are ordered by `turn`, null first, equal ones by role and text; rows that are equal throughout each count. A null role or
    text is empty. Rows with a null `conv_id` are one conversation. Conversations that are equal share all nodes. Texts are taken whole. Other
    columns are ignored. An empty table gives no rows.

    The depth-first order needs no walk: conversations are sorted by the children they take where their path branches, a node
    belongs to the first conversation that has it, and nodes are sorted by that conversation and their depth. A conversation
    that branches b times shares openings with others of b * b / 2 turns in all, so these sort keys stay short.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    own = cut_lineage(numbered(rows, ["conv_id"], ["turn", "role", "text"], ["role", "text"]), "chat-turns")
    named = own.select("conv_id", "place", *content_hashes())
    paths = cut_lineage(prefix_nodes(named, ["conv_id"], "place").select("conv_id", "place", "node", "parent"), "chat-paths")
    convs = _ordered(paths)
    ranked = joined(paths, convs.select("conv_id", "line"), ["conv_id"])
    nodes = ranked.groupBy("node", "parent", F.col("place").alias("depth")).agg(
        F.count("*").alias("n_convs"), F.min("line").alias("line")
    )
    nodes = cut_lineage(nodes.join(convs.select("line", "conv_id", "tree"), "line"), "chat-nodes")
    first = nodes.select("conv_id", F.col("depth").alias("place"), "node", "parent", "depth", "n_convs", "line", "tree")
    said = joined(own, first, ["conv_id", "place"])
    tokens = cut_lineage(_tokens(said.drop("place"), tokenizer), "chat-tokens")
    slim = tokens.select("tree", "line", "depth", "node", "n_tokens")
    slim = numbered(slim, ["tree"], ["line", "depth"], ["line", "node", "n_tokens"])
    starts = running_sums(slim, ["tree"], "place", {"_end": F.col("n_tokens")})
    starts = starts.select("node", "line", "n_tokens", (F.col("_end") - F.col("n_tokens")).alias("start"))
    starts = cut_lineage(starts, "chat-starts")
    placed = tokens.join(starts.select("node", "start"), "node").join(_ancestors(paths, convs, starts), "node", "left")
    top = F.col("depth") == 1
    return PackedTrees(
        placed.select(
            "tree", "node", F.when(~top, F.col("parent")).alias("parent"), "depth", "n_convs", "start", "position", "n_tokens", "ids",
            "loss_start", "loss_end", "attends",
        ),
        paths.select("conv_id", "place", "node"),
    )


def _ordered(paths: DataFrame) -> DataFrame:
    """`conv_id`, `tree` (the node of the first turn) and `line`: the conversation's place in an order that keeps openings together."""
    branches = paths.groupBy("parent", "node").agg(F.lit(1)).groupBy("parent").agg(F.count("*").alias("_ways")).filter("_ways > 1")
    # the first turns of all conversations have one parent, so they stay out of the join
    later = paths.filter("place > 1").join(branches, "parent", "left")
    later = later.select("conv_id", "place", F.when(F.col("_ways").isNotNull(), F.col("node")).alias("node"))
    marked = paths.filter("place = 1").select("conv_id", "place", "node").unionByName(later)
    step = F.when(F.col("node").isNotNull(), F.struct("place", "node"))
    keys = marked.groupBy("conv_id").agg(F.sort_array(F.collect_list(step)).alias("_steps"), F.max("place").alias("turns"))
    keys = keys.select("conv_id", "turns", F.col("_steps")["node"].alias("path"))
    keys = keys.withColumn("tree", F.col("path")[0])
    return cut_lineage(numbered(keys, [], ["path", "turns", "conv_id"], ["conv_id", "tree"], "line"), "chat-lines")


def _ancestors(paths: DataFrame, convs: DataFrame, starts: DataFrame) -> DataFrame:
    """`node`, its `position` and the stretches of the tree's sequence that it `attends` to, in order, besides its own.

    Read from the path of the conversation a node belongs to. What such a path has of one conversation's nodes is one stretch.
    """
    owners = convs.join(starts.select("line").distinct(), "line", "left_semi")
    path = joined(paths, owners.select("conv_id", F.col("line").alias("_reader")), ["conv_id"])
    path = path.join(starts, "node").select("_reader", "place", "node", "line", "start", "n_tokens")
    path = running_sums(path, ["_reader"], "place", {"_upto": F.col("n_tokens")})
    path = cut_lineage(path.withColumn("position", F.col("_upto") - F.col("n_tokens")).drop("_upto"), "chat-owners")
    stretch = path.groupBy("_reader", "line").agg(F.min("start").alias("from"), F.max(F.col("start") + F.col("n_tokens")).alias("to"))
    pair = F.struct("from", "to")
    above = stretch.groupBy("_reader").agg(
        F.sort_array(F.collect_list(F.when(F.col("line") != F.col("_reader"), pair))).alias("_above"),
        F.min(F.when(F.col("line") == F.col("_reader"), F.col("from"))).alias("_from"),
    )
    own = path.filter("line = _reader").join(above, "_reader")
    before = F.when(F.col("start") > F.col("_from"), F.array(F.struct(F.col("_from").alias("from"), F.col("start").alias("to"))))
    empty = F.array().cast("array<struct<from: bigint, to: bigint>>")
    return own.select("node", "position", F.concat("_above", F.coalesce(before, empty)).alias("attends"))


def read_turns(packed: PackedTrees, tokenizer: str) -> DataFrame:
    """Rows `conv_id`, `place`, `role`, `text`, `loss_text` and `chars` of all conversations, read from the tokens of their nodes.

    `loss_text` is what stands under the loss mask (null without), `chars` the code points of the turn as it is formatted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _tokenizer(tokenizer)
        for batch in batches:
            size = np.cumsum(batch.column("n_tokens").to_numpy())
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + STEP // 4, side="right")))
                part = batch.slice(at, to - at)
                ids, begin, end = (part.column(c).to_pylist() for c in ("ids", "loss_start", "loss_end"))
                plain = reader.decode_batch(ids, skip_special_tokens=False)
                learned = [i[b:e] for i, b, e in zip(ids, begin, end) if b is not None]
                learned = iter(reader.decode_batch(learned, skip_special_tokens=False))
                turns = [_TURN.fullmatch(t) for t in plain]
                yield pa.record_batch(
                    {
                        "node": part.column("node"),
                        "role": pa.array([unescaped(t[1]) for t in turns], pa.string()),
                        "text": pa.array([unescaped(t[2]) for t in turns], pa.string()),
                        "loss_text": pa.array([None if b is None else unescaped(next(learned)) for b in begin], pa.string()),
                        "chars": pa.array([len(t) for t in plain], pa.int64()),
                    }
                )
                at = to

    nodes = packed.nodes.select("node", "ids", "n_tokens", "loss_start", "loss_end")
    read = nodes.mapInArrow(run, "node string, role string, text string, loss_text string, chars bigint")
    return packed.paths.join(read, "node").select("conv_id", "place", "role", "text", "loss_text", "chars")


def conversation_digests(turns: DataFrame) -> DataFrame:
    """Per conversation of `read_turns`: `n_turns`, `turns_sha256` (of role, line feed, text, line feed per turn), `loss_chars`, `loss_sha256` and
    `formatted_chars`. Turns are fed to the hashes one after the other; no conversation is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def row():
            n, turns, learned, said, chars = state
            return pa.record_batch(
                {
                    "conv_id": pa.array([now], pa.int64()), "n_turns": pa.array([n], pa.int64()), "turns_sha256": [turns.hexdigest()],
                    "loss_chars": pa.array([learned], pa.int64()), "loss_sha256": [said.hexdigest()],
                    "formatted_chars": pa.array([chars], pa.int64()),
                }
            )

        for batch in batches:
            for c, _, role, text, learned, chars in zip(*(x.to_pylist() for x in batch.columns)):
                if state is None or c != now:
                    if state is not None:
                        yield row()
                    now, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if learned is not None:
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += chars
        if state is not None:
            yield row()

    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), "place", "role", "text", "loss_text", "chars")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    kinds = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    return rows.mapInArrow(run, kinds)
