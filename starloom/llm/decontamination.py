"""Benchmark decontamination by winnowing.

Every span of ``window`` words contains ``window - k + 1`` k-grams; the smallest
of their hashes is the fingerprint of the span.  It depends on the span alone,
so a span that occurs in a document and in a benchmark item has one fingerprint
in both, and no shared span can be missed.  Documents send their distinct
fingerprints to the join (about a seventh of their words), and only
fingerprints met in the benchmark are extended: the spans around them are
compared by the hash of the whole span.  Items shorter than a window are
one span of their own length, with fingerprints for that length.

Spans are compared by two 64-bit hashes (fingerprint and whole span).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import (
    distinct_by_text, dropped, fitting, gram_hashes, hashed_words, keyed_texts, map_batches, same_row, sliding_minimum, text_of, texts, written,
)

WINDOW = 13

#: Bytes between words: ASCII other than digits and letters.  Bytes of other characters belong to words.
_SEPARATORS = bytes(b if b > 0x7F or chr(b).isalnum() else 0x20 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words with A-Z in lower case."""
    return text.lower().translate(_SEPARATORS).split()


def spans(words: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, fingerprint and whole hash of every span of ``size`` words."""
    at = fitting(starts, size)
    k = (size + 1) // 2
    prints = sliding_minimum(gram_hashes(words, k, seed=size), size - k + 1)
    return at, prints[at], gram_hashes(words, size, seed=64 + size)[at]


def _item_spans(batch: pa.RecordBatch) -> pa.RecordBatch:
    ids = np.array(batch.column(0).to_pylist(), np.int64)
    hashes, starts = hashed_words([words_of(t) for t in batch.column(1).to_pylist()])
    lengths = np.diff(starts)
    columns = [[], [], [], []]
    for size in sorted({min(int(n), WINDOW) for n in lengths if n}):
        at, prints, wholes = spans(hashes, starts, size)
        owner = text_of(starts, at)
        keep = (lengths[owner] == size) | (size == WINDOW)
        for column, values in zip(columns, (ids[owner[keep]], np.full(keep.sum(), size, np.int32), prints[keep], wholes[keep]), strict=True):
            column.append(values)
    if not columns[0]:
        return None
    ids, sizes, prints, wholes = map(np.concatenate, columns)
    return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(sizes), pa.array(prints.view(np.int64)), pa.array(wholes.view(np.int64))], ["item_id", "size", "print", "whole"])


def _fingerprints(sizes: list[int]):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, starts = hashed_words([words_of(t) for t in batch.column("text").to_pylist()])
        owners, values = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for size in sizes:
            at, prints, _ = spans(hashes, starts, size)
            owner = text_of(starts, at)
            # Neighbouring spans mostly share their fingerprint: one of each run will do.
            new = np.ones(len(at), bool)
            new[1:] = (prints[1:] != prints[:-1]) | (owner[1:] != owner[:-1])
            owners.append(owner[new])
            values.append(prints[new])
        lists = distinct_by_text(np.concatenate(owners), np.concatenate(values), batch.num_rows)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(np.diff(starts)), lists], ["doc_id", "text_key", "n_words", "prints"])

    return work


def _extended(sizes: list[int]):
    """The spans whose fingerprint is among those of the document that the benchmark has."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, starts = hashed_words([words_of(t) for t in batch.column("text").to_pylist()])
        met = batch.column("met")
        met_of, met_values = np.repeat(np.arange(batch.num_rows), np.diff(met.offsets.to_numpy())), met.flatten().to_numpy().view(np.uint64)
        met_keys = np.unique(met_values ^ met_of.astype(np.uint64))
        rows, out = [], []
        for size in sizes:
            at, prints, wholes = spans(hashes, starts, size)
            owner = text_of(starts, at)
            # A stray match of another text's key is harmless: whole spans are joined afterwards.
            keep = np.isin(prints ^ owner.astype(np.uint64), met_keys)
            rows.append(owner[keep])
            out.append((at[keep] - starts[owner[keep]], np.full(keep.sum(), size), prints[keep].view(np.int64), wholes[keep].view(np.int64)))
        rows = pa.array(np.concatenate(rows))
        at, size, prints, wholes = (np.concatenate(x) for x in zip(*out, strict=True))
        columns = [batch.column("doc_id").take(rows), batch.column("text_key").take(rows), pa.array(at.astype(np.int64)), pa.array(size.astype(np.int32)), pa.array(prints), pa.array(wholes)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "start", "size", "print", "whole"])

    return work


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Words of each document that lie in spans it shares with benchmark items.

    One row per row of ``docs``: doc_id, text_key, n_words, n_hit, item_ids
    (distinct, sorted as text) and contaminated (at least one hit word, and at
    least a twentieth of the words).  Null and empty texts have no words and no
    hits; rows that repeat a doc_id are judged one by one; a null doc_id is
    kept.  Benchmark rows without id or words count for nothing; repeated items
    count once.  Columns other than doc_id, text and item_id are ignored.
    """
    spark = docs.sparkSession
    docs = keyed_texts(docs)
    items = texts(benchmark.select(F.col("item_id").alias("doc_id"), "text")).where("doc_id IS NOT NULL")
    items = written(map_batches(items, "item_id long, size int, print long, whole long", _item_spans).distinct())
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect()) or [WINDOW]

    prints = written(map_batches(docs, "doc_id long, text_key long, n_words long, prints array<long>", _fingerprints(sizes)))
    # Spark broadcasts the benchmark's side only if the written table is below its size limit.
    met = (
        prints.select("doc_id", "text_key", F.explode("prints").alias("print"))
        .join(items.select("print").distinct(), "print", "left_semi")
        .groupBy("doc_id", "text_key").agg(F.collect_set("print").alias("met"))
    )
    met = written(met)
    candidates = docs.join(met, same_row(docs, met)).select(docs["doc_id"], docs["text_key"], "text", "met")
    found = map_batches(candidates, "doc_id long, text_key long, start long, size int, print long, whole long", _extended(sizes))
    span = ["print", "whole", "size"]
    hits = written(found.join(items.select(span).distinct(), span, "left_semi"))
    dropped(met)

    # Spans in order of their start: each adds the words beyond the furthest end so far.
    reach = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", "size"))),
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("sum")),
        lambda a, s: F.struct(
            F.greatest(a["end"], s["start"] + s["size"]).alias("end"),
            (a["sum"] + F.greatest(F.lit(0).cast("long"), s["start"] + s["size"] - F.greatest(a["end"], s["start"]))).alias("sum"),
        ),
    )["sum"]
    covered = hits.groupBy("doc_id", "text_key").agg(reach.alias("n_hit"))
    met_items = (
        hits.select("doc_id", "text_key", *span).distinct().join(items, span).select("doc_id", "text_key", F.col("item_id").cast("string").alias("item_id"))
        .groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    )
    judged = covered.join(met_items, same_row(covered, met_items)).select(covered["doc_id"], covered["text_key"], "n_hit", "item_ids")
    rows = prints.select("doc_id", "text_key", "n_words")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.join(judged, same_row(rows, judged), "left").select(
        rows["doc_id"], rows["text_key"], "n_words", n_hit.alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((n_hit > 0) & (n_hit * 20 >= F.col("n_words"))).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    bad = contamination(docs, benchmark).where("contaminated").select(F.col("doc_id").alias("_bad_id"), F.col("text_key").alias("_bad_key")).distinct()
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["_bad_id"]) & (key == bad["_bad_key"]), "left_anti")
