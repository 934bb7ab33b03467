"""Ranked lexical search by a dual-tree walk over items and documents.

An item and a document are vectors over terms, and a score is their inner product:
how much a term weighs for the item, times how much of it the document has for its
length.  Both sides stand in hierarchies whose nodes hold, term by term, the maximum
over what is below them.  The inner product of two nodes' maxima is a bound on the
scores of all items of the one with all documents of the other, so if it is below
the weakest of those items' current last places, the whole batch is left out.
Bounds that are not below go on with the children of both nodes; leaves are scored
exactly.  Nothing that could be ranked is lost.

Items are taken in blocks of bounded size.  For a block, the documents are read
once and written as sparse vectors over the block's terms, the corpus counts come
from that table, and the walk goes over it with the item hierarchy broadcast.  Each
task keeps the best documents of each item over all it reads, so later documents
meet high thresholds, and passes on no more than ``places`` rows an item.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import bounded_batches, map_batches, texts, written

PLACES = 10
#: Items and bytes of text in a block, by which what is broadcast is bounded (one longer item is a block of its own).
BLOCK_ITEMS, BLOCK_BYTES = 4096, 4 << 20
#: Items and documents below the nodes of each level, from the top.
ITEM_LEVELS, DOC_LEVELS = (64, 8, 1), (512, 64, 8)
#: Documents in one hierarchy.
BATCH_DOCS = 2048
#: Parts of a term's share in a document.
UNIT = 1_000_000_000

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Maximal stretches of ASCII letters and digits and of all other characters above ASCII; A-Z in lower case."""
    return text.translate(_LOWER).split()


class Postings:
    """Rows of a sparse matrix by column: which rows have a term, and how much of it."""

    def __init__(self, rows: np.ndarray, terms: np.ndarray, values: np.ndarray, n_rows: int, n_terms: int):
        order = np.lexsort((rows, terms))
        self.rows, self.values, self.n_rows = rows[order], values[order], n_rows
        self.first = np.searchsorted(terms[order], np.arange(n_terms + 1))

    def products(self, terms: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Inner product of every row with one sparse vector, exact in integers."""
        first, size = self.first[terms], self.first[terms + 1] - self.first[terms]
        at = np.repeat(first - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
        out = np.zeros(self.n_rows, np.int64)
        np.add.at(out, self.rows[at], self.values[at] * np.repeat(values, size))
        return out


def maxima(owner: np.ndarray, terms: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Coordinate maxima of the vectors of each owner, as (owner, term, value) sorted by owner and term."""
    order = np.lexsort((terms, owner))
    owner, terms, values = owner[order], terms[order], values[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (terms[1:] != terms[:-1])
    first = np.flatnonzero(new)
    return owner[first], terms[first], np.maximum.reduceat(values, first) if len(first) else values


def _heaviest_first(owner: np.ndarray, terms: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """An order of the vectors in which those with one heaviest term stand together."""
    order = np.lexsort((terms, -values, owner))
    heaviest = np.full(n, -1, np.int64)
    heaviest[owner[order][::-1]] = terms[order][::-1]
    second = np.full(n, -1, np.int64)
    rest = order[heaviest[owner[order]] != terms[order]]
    second[owner[rest][::-1]] = terms[rest][::-1]
    return np.lexsort((second, heaviest))


class ItemTree:
    """The items of a block in a hierarchy, with the best documents found so far."""

    def __init__(self, owner: np.ndarray, terms: np.ndarray, weights: np.ndarray, n: int, n_terms: int, places: int):
        self.order = _heaviest_first(owner, terms, weights, n)
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        owner = place[owner]
        self.n, self.levels = n, []
        for size in ITEM_LEVELS:
            nodes, node_terms, most = maxima(owner // size, terms, weights)
            self.levels.append(Postings(nodes, node_terms, most, -(-n // size), n_terms))
        self.scores = np.zeros((n, places), np.int64)
        self.ids = np.full((n, places), np.iinfo(np.int64).max)
        self.compared = self.possible = 0

    def weakest(self, level: int) -> np.ndarray:
        """The lowest last place of the items of each node."""
        return np.minimum.reduceat(self.scores[:, -1], np.arange(0, self.n, ITEM_LEVELS[level]))

    def add(self, items: np.ndarray, doc_ids: np.ndarray, scores: np.ndarray) -> None:
        """Documents that may be among the best of some items; ``scores`` has a row per item."""
        last, last_id = self.scores[items, -1], self.ids[items, -1]
        better = (scores > last[:, None]) | ((scores == last[:, None]) & (doc_ids < last_id[:, None]) & (scores > 0))
        improved = better.any(1)
        items, scores, better = items[improved], scores[improved], better[improved]
        if not len(items):
            return
        every = np.concatenate([self.scores[items], np.where(better, scores, 0)], axis=1)
        ids = np.concatenate([self.ids[items], np.where(better, doc_ids, np.iinfo(np.int64).max)], axis=1)
        best = np.lexsort((ids, -every), axis=1)[:, : self.scores.shape[1]]
        self.scores[items] = np.take_along_axis(every, best, 1)
        self.ids[items] = np.take_along_axis(ids, best, 1)

    def walk(self, doc_ids: np.ndarray, owner: np.ndarray, terms: np.ndarray, shares: np.ndarray) -> None:
        """Rank documents, given as a sparse matrix (owner, term, share)."""
        order = _heaviest_first(owner, terms, shares, len(doc_ids))
        place = np.empty(len(doc_ids), np.int64)
        place[order] = np.arange(len(doc_ids))
        doc_ids, owner = doc_ids[order], place[owner]
        by_doc = maxima(owner, terms, shares)
        levels = [maxima(by_doc[0] // size, *by_doc[1:]) for size in DOC_LEVELS]
        starts = [np.searchsorted(nodes, np.arange(-(-len(doc_ids) // size) + 1)) for (nodes, _, _), size in zip(levels, DOC_LEVELS, strict=True)]
        doc_starts = np.searchsorted(by_doc[0], np.arange(len(doc_ids) + 1))
        self.possible += self.n * len(doc_ids)

        def visit(level: int, node: int, parents: np.ndarray) -> None:
            a, b = starts[level][node : node + 2]
            bound = self.levels[level].products(levels[level][1][a:b], levels[level][2][a:b])
            # An equal score may still win its place by a smaller id.
            alive = parents & (bound > 0) & (bound >= self.weakest(level))
            if not alive.any():
                return
            if level + 1 < len(DOC_LEVELS):
                per = DOC_LEVELS[level] // DOC_LEVELS[level + 1]
                below = np.repeat(alive, ITEM_LEVELS[level] // ITEM_LEVELS[level + 1])[: self.levels[level + 1].n_rows]
                for child in range(node * per, min((node + 1) * per, len(starts[level + 1]) - 1)):
                    visit(level + 1, child, below)
                return
            items = np.flatnonzero(alive)
            docs = range(node * DOC_LEVELS[level], min((node + 1) * DOC_LEVELS[level], len(doc_ids)))
            self.compared += len(items) * len(docs)
            spans = [slice(doc_starts[d], doc_starts[d + 1]) for d in docs]
            scores = np.stack([self.levels[-1].products(by_doc[1][s], by_doc[2][s])[items] for s in spans], axis=1)
            self.add(items, doc_ids[docs.start : docs.stop], scores)

        for node in range(len(starts[0]) - 1):
            visit(0, node, np.ones(self.levels[0].n_rows, bool))

    def ranked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, doc_id, score) of the places that are taken."""
        place, column = np.nonzero(self.scores > 0)
        return self.order[place], self.ids[place, column], self.scores[place, column]


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Of each text: doc_id, n (its terms), and term and times of those in the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        known = shared.value.get
        sizes, terms, times, offsets = [], [], [], [0]
        for text in batch.column("text").to_pylist():
            words = terms_of(text)
            sizes.append(len(words))
            counts = Counter(map(known, words))
            counts.pop(None, None)
            terms.extend(counts.keys())
            times.extend(counts.values())
            offsets.append(len(terms))
        at = pa.array(offsets, pa.int32())
        lists = [pa.ListArray.from_arrays(at, pa.array(x, kind)) for x, kind in ((terms, pa.int32()), (times, pa.int64()))]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "times"])

    return map_batches(texts(docs), "doc_id long, n long, terms array<int>, times array<long>", work)


def _shares(sizes: np.ndarray, times: np.ndarray, total: int, documents: int) -> np.ndarray:
    """What each term gives to a score: more with its times, less with the length of the text."""
    length = 100 - 75 + (75 * sizes * documents) // total
    return (UNIT * times) // (1000 * times + 8 * length)


def _search_block(docs: DataFrame, items: list[tuple], places: int) -> DataFrame:
    """The best documents of a block of (item row, text)."""
    spark = docs.sparkSession
    counts = [Counter(terms_of(text)) for _, text in items]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
    vectors = written(_vectors(docs, vocabulary))
    documents, total = vectors.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # One row per term of the block.
    holders = dict(vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator())
    owner, terms, weights = [], [], []
    for i, own in enumerate(counts):
        for term, repeats in own.items():
            number = vocabulary[term]
            if number in holders:
                owner.append(i)
                terms.append(number)
                weights.append(repeats * math.floor(1000 * math.log((2 * documents + 2) / (2 * holders[number] + 1))))
    matrix = spark.sparkContext.broadcast([np.array(x, np.int64) for x in (owner, terms, weights)])
    n_items, n_terms = len(items), len(vocabulary)
    numbers = [row for row, _ in items]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = ItemTree(*matrix.value, n_items, n_terms, places)
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH_DOCS):
                part = batch.slice(first, BATCH_DOCS)
                lists, times = part.column("terms"), part.column("times").flatten().to_numpy()
                sizes = part.column("n").to_numpy()
                of = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
                tree.walk(part.column("doc_id").to_numpy(), of, lists.flatten().to_numpy().astype(np.int64), _shares(sizes[of], times, total, documents))
        item, doc_id, score = tree.ranked()
        if len(item):
            yield pa.RecordBatch.from_arrays([pa.array(np.array(numbers, np.int64)[item]), pa.array(doc_id), pa.array(score)], ["item_row", "doc_id", "score"])

    if not owner:
        return spark.createDataFrame([], "item_row long, doc_id long, score long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_DOCS))
    found = written(vectors.where("doc_id IS NOT NULL AND size(terms) > 0").mapInArrow(run, "item_row long, doc_id long, score long"))
    bounded_batches(spark)
    return found


def search(docs: DataFrame, items: DataFrame, places: int = PLACES) -> DataFrame:
    """The ``places`` best documents of each item, by score, then by doc_id.

    One row per place taken: item_id, rank (from 1), doc_id and score (above 0).
    ``items`` has item_id and text.  Null and empty texts have no terms: such an
    item has no rows, such a document is not counted and never ranked.  A document
    row without doc_id counts in the corpus statistics but is not ranked.  Rows
    that repeat a doc_id are documents of their own, rows that repeat an item_id
    are ranked each by itself, and a null item_id is kept.  Other columns are
    ignored.
    """
    items = items.select("item_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    # Item rows are numbered in a written table; the running size of the texts deals them into blocks.
    numbered = written(items.withColumn("item_row", F.monotonically_increasing_id()))
    sizes = numbered.select("item_row", F.length("text").cast("long").alias("size"))
    found, block, held = [], [], 0
    start = None
    cuts = []
    for row in sizes.orderBy("item_row").toLocalIterator():
        if block and (len(block) == BLOCK_ITEMS or held + row["size"] > BLOCK_BYTES):
            cuts.append((start, block[-1]))
            block, held = [], 0
        start = row["item_row"] if not block else start
        block.append(row["item_row"])
        held += row["size"]
    if block:
        cuts.append((start, block[-1]))
    for first, last in cuts:
        rows = numbered.where(F.col("item_row").between(first, last)).select("item_row", "text").collect()
        found.append(_search_block(docs, [(r["item_row"], bytes(r["text"])) for r in rows], places))
    if not found:
        return numbered.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where("false")
    order = Window.partitionBy("item_row").orderBy(F.desc("score"), F.asc("doc_id"))
    best = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= places)
    return best.join(numbered.select("item_row", "item_id"), "item_row").select("item_id", "rank", "doc_id", "score")
