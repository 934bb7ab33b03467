"""Repeated spans across documents by recompression.

A text is a sequence of symbols, at first its words.  A round names maximal runs
of one symbol, then pairs: each symbol falls to the left or right side by a bit
of its hash and the round, and a left symbol followed by a right one becomes one
symbol.  The name of a run or pair is the hash of its parts, so every Spark task
gives equal parts equal names in every round, without a dictionary to exchange.
Rounds go on until a text is one symbol.

Whether two neighbours merge depends on them and their neighbours alone, so
equal spans have equal symbols inside, up to their margins.  The anchor of a
window is one of the symbols of the highest usable round that the window determines
by itself, taken together with the words that determine it; a word of the window if
there is none.  Of several the one with the smallest hash is taken.  Equal
windows have equal anchors, hence no repeat is missed: only anchors that occur
in two documents are looked at.  Neighbouring windows with one anchor are a run;
runs of equal words are one run, which its first document stands for, and the
windows of runs that differ are compared by the hash of all their words.  Texts
with one top symbol are copies of each other and need no windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import (
    distinct_by_text, dropped, fitting, gram_hashes, hashed_words, keyed_texts, map_batches, mixed, span_hashes, text_of, written,
)

WINDOW = 13
#: Rounds whose symbols may become anchors.  Those of round 2 fit into most windows, but give 2.5 times the anchors, and disk is short.
ANCHOR_ROUNDS = 1
#: Most neighbouring windows of one row: bounds the row for texts that repeat one word.
RUN = 64
_RUN, _PAIR = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


class Symbols:
    """Symbols of many texts one after another; ``low`` and ``high`` bound the words that determine each."""

    def __init__(self, names, owner, low, high):
        self.names, self.owner, self.low, self.high = names, owner, low, high

    def _merged(self, names, first, last):
        """Symbols made of the symbols ``first`` to ``last``, whose neighbours decide too."""
        owner = self.owner[first]
        before, after = np.maximum(first - 1, 0), np.minimum(last + 1, len(self.names) - 1)
        # A text's end is not part of a window's words, so what touches it is determined by no window.
        low = np.where((first > 0) & (self.owner[before] == owner), self.low[before], -1)
        high = np.where((last + 1 < len(self.names)) & (self.owner[after] == owner), self.high[after], np.iinfo(np.int64).max)
        return Symbols(names, owner, low, high)

    def runs(self) -> Symbols:
        """Maximal runs of one symbol become one; others stay."""
        new = np.ones(len(self.names), bool)
        new[1:] = (self.names[1:] != self.names[:-1]) | (self.owner[1:] != self.owner[:-1])
        first = np.flatnonzero(new)
        length = np.diff(np.append(first, len(self.names)))
        names = self.names[first]
        names = np.where(length > 1, mixed(names * _RUN + length.astype(np.uint64)), names)
        return self._merged(names, first, first + length - 1)

    def pairs(self, number: int) -> Symbols:
        """A left symbol before a right one becomes one with it."""
        right = (mixed(self.names ^ mixed(np.full(1, number + 1, np.uint64))) & np.uint64(1)).astype(bool)
        joins = np.zeros(len(self.names), bool)
        joins[:-1] = ~right[:-1] & right[1:] & (self.owner[:-1] == self.owner[1:])
        first = np.flatnonzero(~np.concatenate([[False], joins[:-1]]))
        two = joins[first]
        names = self.names[first]
        after = self.names[np.minimum(first + 1, len(self.names) - 1)]
        names = np.where(two, mixed(names * _PAIR + mixed(after + _RUN)), names)
        return self._merged(names, first, first + two)


def parsed(hashes: np.ndarray, starts: np.ndarray, rounds: int | None = None) -> tuple[list[Symbols], np.ndarray]:
    """Symbols after each of the first rounds, and the top symbol of every text (0: no words)."""
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    at = np.arange(len(hashes))
    now = Symbols(hashes, owner, at, at + 1)
    levels, top = [now], np.zeros(len(starts) - 1, np.uint64)
    number = 0
    while len(now.names) and (rounds is None or number < rounds):
        now = now.runs().pairs(number)
        number += 1
        if number <= ANCHOR_ROUNDS:
            levels.append(now)
        alone = np.bincount(now.owner, minlength=len(top))[now.owner] == 1
        top[now.owner[alone]] = now.names[alone]
        if alone.any() and rounds is None and number >= ANCHOR_ROUNDS:
            now = Symbols(now.names[~alone], now.owner[~alone], now.low[~alone], now.high[~alone])
    return levels, top


def anchors(hashes: np.ndarray, starts: np.ndarray, levels: list[Symbols]) -> tuple[np.ndarray, np.ndarray]:
    """Start and anchor of every window."""
    best = np.full(len(hashes) + 1, _NONE)
    hash_of = span_hashes(hashes)
    for level, symbols in enumerate(levels):
        fits = (symbols.low >= 0) & (symbols.high - symbols.low <= WINDOW) & (symbols.high <= len(hashes))
        low, high, names = symbols.low[fits], symbols.high[fits], symbols.names[fits]
        # The top bits rank the rounds, so a symbol of a higher round wins; those of a round differ by hash.
        rank = (mixed(names + hash_of(low, high)) >> np.uint64(2)) | np.uint64((len(levels) - 1 - level) << 62)
        # ``low`` differs between the symbols of a round, so no two write to one place at a time.
        for back in range(WINDOW):
            use = (high - low + back <= WINDOW) & (low >= back)
            place = low[use] - back
            best[place] = np.minimum(best[place], rank[use])
    at = fitting(starts, WINDOW)
    return at, best[at]


def _marked(batch: pa.RecordBatch) -> pa.RecordBatch:
    lists = [t.split() for t in batch.column("text").to_pylist()]
    hashes, starts = hashed_words(lists)
    levels, top = parsed(hashes, starts)
    at, anchor = anchors(hashes, starts, levels)
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    marks = distinct_by_text(text_of(starts, at[new]), anchor[new], batch.num_rows)
    whole = [hashlib.sha256(b" ".join(words)).digest() for words in lists]
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("text_key"), pa.array(np.diff(starts)), pa.array(top.view(np.int64)), pa.array(whole, pa.binary()), marks],
        ["doc_id", "text_key", "n_words", "top", "whole", "anchors"],
    )


def _runs(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Neighbouring windows that have one of the document's shared anchors in common, with a hash of all words they cover."""
    hashes, starts = hashed_words([t.split() for t in batch.column("text").to_pylist()])
    levels, _ = parsed(hashes, starts, ANCHOR_ROUNDS)
    at, anchor = anchors(hashes, starts, levels)
    owner = text_of(starts, at)
    shared = batch.column("shared")
    of, values = np.repeat(np.arange(batch.num_rows), np.diff(shared.offsets.to_numpy())), shared.flatten().to_numpy().view(np.uint64)
    keep = np.isin(mixed(anchor) + owner.astype(np.uint64), mixed(values) + of.astype(np.uint64))
    at, anchor, owner = at[keep], anchor[keep], owner[keep]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    # Where a run is cut does not matter: windows of different runs are compared one by one.
    place = np.arange(len(at))
    new |= (place - np.maximum.accumulate(np.where(new, place, 0))) % RUN == 0
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(at)))
    wholes = gram_hashes(hashes, WINDOW, seed=WINDOW)[at]
    span = span_hashes(hashes)(at[first], at[first] + size - 1 + WINDOW)
    rows = pa.array(owner[first])
    columns = [
        batch.column("doc_id").take(rows), batch.column("text_key").take(rows), pa.array(at[first] - starts[owner[first]]), pa.array(anchor[first].view(np.int64)),
        pa.array(span.view(np.int64)), pa.ListArray.from_arrays(pa.array(np.append(first, len(at)).astype(np.int32)), pa.array(wholes.view(np.int64))),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "start", "anchor", "span", "wholes"])


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    counts, kept = [], []
    for text, repeats in zip(batch.column("text").to_pylist(), batch.column("repeats").to_pylist(), strict=True):
        words = text.split()
        edges = np.zeros(len(words) + 1, np.int64)
        start, size = np.divmod(np.asarray(repeats), RUN + 1)
        np.add.at(edges, start, 1)
        np.add.at(edges, start + size - 1 + WINDOW, -1)
        stay = np.cumsum(edges[:-1]) == 0
        counts.append(len(words) - int(stay.sum()))
        kept.append(b" ".join(w for w, s in zip(words, stay.tolist(), strict=True) if s))
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(counts, pa.int64()), pa.array([k.decode() for k in kept], pa.string())], ["doc_id", "text_key", "n_cut", "kept_text"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """Each document without the words that an earlier document (by doc_id) has in a window of 13 words.

    One row per row of ``docs``: doc_id, text_key, n_words, n_removed and
    kept_text, the words that stay joined by one space; null where nothing is
    removed (then all words stay).  Windows are judged on the input.  Null and
    empty texts have no words.  Rows that repeat a doc_id are cut one by one, and
    neither is earlier.  A row without doc_id is neither cut nor a cause of cuts.
    """
    docs, row = keyed_texts(docs), ["doc_id", "text_key"]
    schema = "doc_id long, text_key long, n_words long, top long, whole binary, anchors array<long>"
    marked = written(map_batches(docs, schema, _marked))
    base = written(marked.drop("anchors"))
    can_repeat = f"doc_id IS NOT NULL AND n_words >= {WINDOW}"
    # Texts of one top symbol, confirmed by a digest of all words: the copies go whole and need no windows.
    earliest = written(base.where(can_repeat).groupBy("top", "whole").agg(F.min("doc_id").alias("first_id")))
    copies = written(base.where(can_repeat).join(earliest, ["top", "whole"]).where("doc_id > first_id").select(*row).distinct().withColumn("copy", F.lit(True)))
    firsts = written(marked.where(can_repeat).join(earliest, ["top", "whole"]).where("doc_id = first_id").select(*row, "anchors"))
    dropped(marked, earliest)
    occurrences = firsts.select(*row, F.explode("anchors").alias("anchor"))
    shared = written(occurrences.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("anchor"))
    lists = written(occurrences.join(shared, "anchor", "left_semi").groupBy(*row).agg(F.collect_set("anchor").alias("shared")))
    dropped(firsts, shared)

    # Identical rows have one result.
    candidates = written(docs.join(lists, row).select(*row, "text", "shared").dropDuplicates(row))
    dropped(lists)
    runs = written(map_batches(candidates, "doc_id long, text_key long, start long, anchor long, span long, wholes array<long>", _runs))
    # The first document of equal runs stands for them: all windows of the others are in it.
    equal = written(runs.groupBy("anchor", "span").agg(F.min("doc_id").alias("low")))
    first = F.col("doc_id") == F.col("low")
    judged = written(runs.join(equal, ["anchor", "span"]).select(*row, "start", "anchor", F.size("wholes").alias("size"), F.when(first, F.col("wholes")).alias("wholes")))
    dropped(runs, equal)
    windows = judged.where("wholes IS NOT NULL").select(*row, "anchor", "start", F.posexplode("wholes").alias("i", "whole"))
    earlier = written(windows.groupBy("anchor", "whole").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").drop("high"))
    single = windows.join(earlier, ["anchor", "whole"]).where("doc_id > low").select(*row, (F.col("start") + F.col("i")).alias("start"), F.lit(1).alias("size"))
    cuts = judged.where("wholes IS NULL").select(*row, "start", "size").unionByName(single)
    # Start and number of neighbouring windows as one long.
    repeats = written(cuts.groupBy(*row).agg(F.collect_list(F.col("start") * (RUN + 1) + F.col("size")).alias("repeats")))
    dropped(judged, earlier)
    cut = map_batches(candidates.join(repeats, row).select(*row, "text", "repeats"), "doc_id long, text_key long, n_cut long, kept_text string", _cut)

    # A row without doc_id meets neither.
    return base.join(copies, row, "left").join(cut, row, "left").select(
        *row, "n_words",
        F.when(F.col("copy"), F.col("n_words")).otherwise(F.coalesce("n_cut", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(F.col("copy"), F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
        F.lower(F.hex("whole")).alias("whole_sha256"),
    )
