"""Near-duplicate documents by min-max hashing.

A document is the set of its distinct 5-word shingles.  Each permutation of the
hashes gives two signature values, the minimum and the maximum, so ``BANDS *
ROWS`` values cost half as many permutations.  Documents that agree in all
values of a band fall into one bucket.  With 48 bands of 5 values a pair of
similarity 0.75 shares no bucket with probability (1 - 0.75**5)**48 = 2e-6.

Equal sets are one node.  Within a bucket every member is first compared with one
hub, so a bucket of n members emits n pairs.  Members that are in different
components after that are held against each other by 64 counts of their shingles,
which bound the intersection; only pairs with room for a link are made, each once,
so no link that a bucket shows is lost and texts that merely resemble each other
emit next to nothing.  All links are confirmed on the full sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import (
    distinct_by_text, dropped, fitting, gram_hashes, hashed_words, keyed_texts, map_batches, mixed, same_row, text_of, texts, written,
)
from starloom.llm.components import components

SHINGLE = 5
BANDS, ROWS = 48, 5

_draw = np.random.default_rng(20_111)
_FACTORS = (_draw.integers(0, 1 << 32, BANDS * ROWS // 2, np.uint64) | np.uint64(1)).astype(np.uint32)
_SHIFTS = _draw.integers(0, 1 << 32, BANDS * ROWS // 2, np.uint64).astype(np.uint32)
#: Shingles hashed at a time: rows of an array that stays in the processor's cache.
_BLOCK = 512
#: Counts that stand for a set where pairs are told apart before they are made; a power of two.
_SLOTS = 64


def words_of(text: bytes) -> list[bytes]:
    """Words with A-Z in lower case."""
    return text.lower().split()


def shingle_sets(batch_texts: list[bytes]) -> pa.ListArray:
    """Hashes of the distinct shingles of each text, sorted; a text of fewer words is one shingle."""
    hashes, starts = hashed_words([words_of(t) for t in batch_texts])
    at = fitting(starts, SHINGLE)
    owners, values = [text_of(starts, at)], [gram_hashes(hashes, SHINGLE)[at]]
    for i in np.flatnonzero((np.diff(starts) > 0) & (np.diff(starts) < SHINGLE)):
        part = hashes[starts[i] : starts[i + 1]]
        owners.append(np.array([i]))
        values.append(gram_hashes(part, len(part), seed=len(part)))
    return distinct_by_text(np.concatenate(owners), np.concatenate(values), len(batch_texts))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minima, then maxima, of all permutations of the set."""
    low, high = None, None
    for i in range(0, len(shingles), _BLOCK):
        block = (shingles[i : i + _BLOCK] >> np.uint64(32)).astype(np.uint32)[:, None] * _FACTORS + _SHIFTS
        least, most = block.min(0), block.max(0)
        low, high = (least, most) if low is None else (np.minimum(low, least), np.maximum(high, most))
    return np.concatenate([low, high])


def _signed(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = shingle_sets(batch.column("text").to_pylist())
    offsets, values = sets.offsets.to_numpy(), sets.flatten().to_numpy().view(np.uint64)
    parts = [values[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
    names = [xxhash.xxh3_128_digest(p.tobytes()) if len(p) else None for p in parts]
    filled = [signature(p) for p in parts if len(p)]
    keys = np.zeros((len(filled), BANDS), np.uint64)
    if filled:
        bands = np.stack(filled).reshape(len(filled), BANDS, ROWS).astype(np.uint64)
        for r in range(ROWS):
            keys = mixed(keys + np.uint64(0x9E3779B97F4A7C15) + bands[:, :, r])
        keys = mixed(keys ^ np.arange(1, BANDS + 1, dtype=np.uint64))
    ends = np.cumsum([0] + [BANDS * (len(p) > 0) for p in parts]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.reshape(-1).view(np.int64)))
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(np.diff(offsets).astype(np.int64)), pa.array(names, pa.binary()), lists], ["doc_id", "text_key", "n_shingles", "name", "bands"])


def _sets(batch: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), shingle_sets(batch.column("text").to_pylist())], ["node", "shingles"])


def _close(left: Column, right: Column, percent: int) -> Column:
    """100 * intersection >= percent * union, on distinct elements."""
    both = F.size(F.array_intersect(left, right))
    return both * 100 >= (F.size(left) + F.size(right) - both) * percent


def pairs_across(rest: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members (key, node, n, label) of one bucket, of different labels, that can be close.

    Each pair comes once, from the first bucket that it shares.  It comes only if the
    shingles that other members have, counted by the last bits of their hashes, leave room
    for a large enough intersection: the sum of the smaller counts is never less than
    the intersection, and for texts that resemble each other it is little more.
    """
    open_nodes = rest.groupBy("node").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    grams = sets.join(open_nodes, "node", "left_semi").select("node", F.explode("shingles").alias("gram"))
    shared = written(grams.groupBy("gram").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("gram"))
    by_slot = grams.join(shared, "gram", "left_semi").groupBy("node", F.col("gram").bitwiseAND(F.lit(_SLOTS - 1)).cast("int").alias("slot")).agg(F.count(F.lit(1)).cast("int").alias("times"))
    held = by_slot.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("slot", "times"))).alias("held"))
    slots = F.sequence(F.lit(0), F.lit(_SLOTS - 1))
    counts = held.select("node", F.transform(slots, lambda i: F.coalesce(F.try_element_at("held", i), F.lit(0))).alias("counts"))
    left = written(rest.join(written(open_nodes.join(counts, "node")), "node"))
    right = left.select(*[F.col(c).alias(f"{c}2") for c in left.columns])
    most = F.aggregate(F.zip_with("counts", "counts2", lambda x, y: F.least(x, y)), F.lit(0), lambda total, x: total + x)
    found = left.join(
        right,
        (F.col("key") == F.col("key2"))
        & (F.col("node") < F.col("node2"))
        & (F.col("label") != F.col("label2"))
        & (F.least("n", "n2") * 100 >= F.greatest("n", "n2") * percent)
        & (most * 100 >= (F.col("n") + F.col("n2") - most) * percent)
        & (F.col("key") == F.element_at(F.array_intersect("keys", "keys2"), 1)),
    )
    dropped(shared)
    return found.select(F.col("node").alias("a"), F.col("node2").alias("b"))


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """Components of documents whose shingle sets overlap by ``percent`` or more.

    One row per row of ``docs``: doc_id, text_key, n_shingles, component_id (the
    smallest doc_id of the component) and kept (doc_id = component_id).  Null and
    empty texts have no shingles and are linked with nothing.  Rows that repeat
    a doc_id are one document with the links of each of its texts.  A row without
    doc_id is linked with nothing, has no component_id and is kept.
    """
    docs = keyed_texts(docs)
    signed = written(map_batches(docs, "doc_id long, text_key long, n_shingles long, name binary, bands array<long>", _signed))
    # A node is the smallest document of those with one set.
    filled = signed.where("n_shingles > 0")
    classes = written(filled.where("doc_id IS NOT NULL").groupBy("name").agg(F.min("doc_id").alias("node")))
    members = filled.join(classes, "name").where("doc_id = node").select(F.explode("bands").alias("key"), "node")
    shared = members.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("key")
    members = written(members.join(shared, "key"))
    nodes = members.select("node").distinct()
    sets = written(map_batches(docs.join(nodes, docs["doc_id"] == nodes["node"], "left_semi").select("doc_id", "text"), "node long, shingles array<long>", _sets))

    # Shingles that no other node of these has are in no intersection.
    grams = sets.select("node", F.explode("shingles").alias("gram"))
    common = grams.groupBy("gram").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("holders")).where("low < high").select("gram", "holders")
    counts = grams.join(common, "gram").groupBy("node").agg(F.count(F.lit(1)).alias("c"), F.sum("holders").alias("holders"))
    sizes = sets.groupBy("node").agg(F.min(F.size("shingles")).cast("long").alias("n"))
    possible = counts.join(sizes, "node").where(F.col("c") * 100 >= F.col("n") * percent)
    members = written(members.join(possible, "node"))

    def may_link(a: dict[str, Column], b: dict[str, Column]) -> Column:
        """The intersection is at most the smaller number of common shingles."""
        most = F.least(a["c"], b["c"])
        return most * 100 >= (a["n"] + b["n"] - most) * percent

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) whose sets are close."""
        a, b = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left")), sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
        return pairs.join(a, "a").join(b, "b").where(_close(F.col("left"), F.col("right"), percent)).select("a", "b").distinct()

    own = {"n": F.col("n"), "c": F.col("c")}
    # The node whose shingles most nodes have, on average, is the one most likely to be what others were copied from.
    hub = members.groupBy("key").agg(F.max(F.struct((F.col("holders") / F.col("n")).alias("share"), (-F.col("node")).alias("last"), "n", "c")).alias("hub"))
    spokes = members.join(hub, "key").withColumn("other", -F.col("hub.last")).where((F.col("node") != F.col("other")) & may_link(own, {"n": F.col("hub.n"), "c": F.col("hub.c")}))
    tested = written(spokes.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct())
    links = written(confirmed(tested))
    label = components(links)

    # Buckets whose members are not all in one component yet: their pairs across components.
    labelled = members.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_keys = written(labelled.groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l < h").select("key"))
    rest = written(labelled.join(open_keys, "key", "left_semi").select("key", "node", "n", "label"))
    pairs = pairs_across(rest, sets, percent)
    more = written(confirmed(pairs.join(tested, ["a", "b"], "left_anti")))
    if not more.isEmpty():
        label = components(links.unionByName(more))
    dropped(members, rest, tested, sets)

    named = classes.join(label, "node", "left").select("name", F.coalesce("label", "node").alias("component"))
    rows = signed.select("doc_id", "text_key", "n_shingles", "name").join(named, "name", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.least(F.coalesce("component", "doc_id"), F.col("doc_id")))
    return rows.select("doc_id", "text_key", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose document is the first of its component; rows without text are kept.

    Of rows that repeat a doc_id all are kept or none.
    """
    gone = near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("_gone_id")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["_gone_id"], "left_anti")
