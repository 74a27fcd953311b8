"""Test items inside documents: size-partitioned MinHash containment search, verified on the exact shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from runpulse.llm.bit_filters import bit_filter, passes
from runpulse.llm.columns import unused
from runpulse.llm.sampling import row_key
from runpulse.llm.words import mix, pieces_of, row_sets, row_words, shingles, signed

#: Slots of a signature: each holds the least hash among the shingles that fall into it.
SLOTS = 64
#: Smallest size class; an item of m shingles is in the class of the next power of two.
LEAST = 1


def _classes(sizes: np.ndarray) -> np.ndarray:
    return np.maximum(LEAST, 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))


def _signatures(hashes: np.ndarray, group: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """For each group the least hash of every slot that has one: (group, key). Keys tell slots apart."""
    slot = (mix(hashes) % np.uint64(SLOTS)).astype(np.int64)
    order = np.lexsort((hashes, slot, group))
    g, s, h = group[order], slot[order], hashes[order]
    first = np.ones(len(g), dtype=bool)
    first[1:] = (g[1:] != g[:-1]) | (s[1:] != s[:-1])
    return g[first], mix(h[first] + np.uint64(salt))


def _item_rows(items: DataFrame, text: str, size: int, keys: list[str]) -> DataFrame:
    """Items with their distinct shingles, size class and signature keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces_of(whole, text):
                hashes, sizes = row_sets(batch.column(text), size)
                row = np.repeat(np.arange(batch.num_rows), sizes)
                kind = _classes(sizes)
                sig_row, sig = [], []
                for c in np.unique(kind[sizes > 0]).tolist():
                    own = kind[row] == c
                    g, key = _signatures(hashes[own], row[own], c)
                    sig_row.append(g)
                    sig.append(key)
                sig_row = np.concatenate(sig_row) if sig_row else np.zeros(0, np.int64)
                sig = np.concatenate(sig) if sig else np.zeros(0, np.uint64)
                order = np.argsort(sig_row, kind="stable")
                sig_count = np.bincount(sig_row, minlength=batch.num_rows)
                lists = lambda values, counts: pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(signed(values))
                )
                out = batch.drop_columns([text])
                out = out.append_column("n_shingles", pa.array(sizes, pa.int64()))
                out = out.append_column("class", pa.array(kind, pa.int64()))
                out = out.append_column("shingles", lists(hashes, sizes))
                yield out.append_column("keys", lists(sig[order], sig_count))

    kinds = ", ".join(f"{k} {items.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{kinds}, n_shingles bigint, class bigint, shingles array<bigint>, keys array<bigint>"
    return items.select(*keys, text).mapInArrow(run, schema)


def contained_items(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text",
    threshold: float = 0.75, size: int = 5,
) -> DataFrame:
    """Rows `doc_id`, `item_id`, `n_shingles` (of the item), `n_found`, `containment`: items of whose distinct word
    shingles at least `threshold` stand in the document.

    Items are divided into size classes (powers of two). For each class a document is covered by
    overlapping windows of twice the class size, so that an item meets sets of its own order of size however long the
    document is, and no window is missed at an edge. Windows and items get one-permutation MinHash signatures; a
    shared key makes a candidate pair. A candidate is then verified on all shingles of the whole document.
    Documents are read once: two bit filters of fixed size, made from the items, let through only window keys
    and shingles that an item may have, and these alone are shuffled. With more items than the filters hold well, more
    rows pass, and the result stays the same.

    Words are runs of characters other than ASCII white space, A-Z lower-cased; a text of fewer words than `size` has its
    whole sequence as its one shingle. Null or empty texts, and items without words, match nothing. Documents that
    agree in id and text are one row of the result, as are equal items; null ids are kept. Other columns are ignored. If either
    table is empty there are no rows.
    """
    spark = docs.sparkSession
    listed = _item_rows(items.select(F.col(item_id).alias("_item"), F.col(text).alias("_text")), "_text", size, ["_item"])
    listed = listed.filter("n_shingles > 0").dropDuplicates(["_item", "shingles"])
    listed = listed.withColumn("_no", F.xxhash64(F.struct("_item", "shingles"))).persist()
    classes = sorted(r[0] for r in listed.select("class").distinct().collect())  # powers of two: 60 at most
    shingle_bits = spark.sparkContext.broadcast(bit_filter(listed.select(F.explode("shingles"))))
    key_bits = spark.sparkContext.broadcast(bit_filter(listed.select(F.explode("keys"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        in_items, in_keys = (np.frombuffer(b.value, np.uint8) for b in (shingle_bits, key_bits))
        for whole in batches:
            for batch in pieces_of(whole, "_text", 1 << 21):
                hashes, made = shingles(*row_words(batch.column("_text")), size)
                row = np.repeat(np.arange(batch.num_rows), made)
                place = np.arange(len(row)) - np.repeat(np.cumsum(made) - made, made)
                # a window without any shingle of an item cannot contain one: only hits and their windows go on
                hit = passes(in_items, hashes)
                if not hit.any():
                    continue
                found_row, found = [], []
                for c in classes:
                    for shift in (0, c):
                        number = (place + shift) // (2 * c)
                        start = np.r_[True, (row[1:] != row[:-1]) | (number[1:] != number[:-1])]
                        window = np.cumsum(start) - 1
                        live = np.bincount(window, hit)[window] > 0
                        g, key = _signatures(hashes[live], window[live], c)
                        pass_ = passes(in_keys, key)
                        found_row.append(row[np.flatnonzero(start)][g[pass_]])
                        found.append(key[pass_])
                keys = np.unique(np.stack([np.concatenate(found_row).astype(np.uint64), np.concatenate(found)]), axis=1)
                live_rows = np.unique(keys[0]).astype(np.int64)
                own = hit & np.isin(row, live_rows)
                rest = np.unique(np.stack([row[own].astype(np.uint64), hashes[own]]), axis=1)
                both = np.concatenate([keys, rest], axis=1)
                at = both[0].astype(np.int64)
                yield pa.record_batch(
                    {
                        "_doc": batch.column("_doc").take(pa.array(at)),
                        "_key": batch.column("_key").take(pa.array(at)),
                        "is_key": pa.array(np.r_[np.ones(keys.shape[1], bool), np.zeros(rest.shape[1], bool)]),
                        "hash": pa.array(signed(both[1])),
                    }
                )

    plain = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text"))
    plain = plain.withColumn("_key", F.xxhash64(F.coalesce("_text", F.lit(""))))
    kind = plain.schema["_doc"].dataType.simpleString()
    rows = plain.mapInArrow(run, f"_doc {kind}, _key bigint, is_key boolean, hash bigint")
    wanted = listed.select("_no", F.explode("shingles").alias("hash"), F.lit(False).alias("is_key")).unionByName(
        listed.select("_no", F.explode("keys").alias("hash"), F.lit(True).alias("is_key"))
    )
    met = rows.join(wanted, ["is_key", "hash"])
    counts = met.groupBy("_doc", "_key", "_no").agg(
        F.max("is_key").alias("candidate"), F.count_distinct(F.when(~F.col("is_key"), F.col("hash"))).alias("n_found")
    )
    sizes = listed.select("_no", F.col("_item").alias(item_id), "n_shingles")
    joined = counts.filter("candidate").join(sizes, "_no").filter(F.col("n_found") >= F.lit(threshold) * F.col("n_shingles"))
    best = joined.groupBy(F.col("_doc").alias(doc_id), item_id, "n_shingles").agg(F.max("n_found").alias("n_found"))
    return best.withColumn("containment", F.col("n_found") / F.col("n_shingles"))


def decontaminated(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents in which no item is contained, all columns kept."""
    row = unused(docs, "_row")
    keyed = docs.withColumn(row, row_key(docs))
    hits = contained_items(keyed, items, doc_id=row, text=text, **options).select(row).distinct()
    return keyed.join(hits, row, "left_anti").drop(row)
