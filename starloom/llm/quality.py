"""Quality classifier: a regularised quadratic discriminant on document statistics.

Each class has its own covariance, shrunk towards the covariance of both and
towards a multiple of the identity.  A score is the logistic of the difference
of the two log densities, whose Mahalanobis distances come from Cholesky factors
that are computed once, and of the log odds of the labels.
"""

from __future__ import annotations

import operator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import held_out, map_batches, texts, written

#: Weight of the covariance of both classes, and of the identity, in a class's covariance.
TO_POOLED, TO_IDENTITY = 0.05, 0.01
#: A document counts as good from this score on.
THRESHOLD = 0.7

_UPPER, _LOWER, _DIGITS = slice(65, 91), slice(97, 123), slice(48, 58)
_SYMBOLS = np.frombuffer(b"#*$%&|<>~^@_\\{}[]=+", np.uint8)


def statistics(text: bytes) -> list[float]:
    """Transformed statistics of a text: logarithms of counts and of shares, so that their tails are short."""
    bytes_ = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    n, size = len(words), len(text)
    letters = int(bytes_[_UPPER].sum() + bytes_[_LOWER].sum() + bytes_[128:].sum())
    upper, symbols, marks = int(bytes_[_UPPER].sum()), int(bytes_[_SYMBOLS].sum()), int(bytes_[33] + bytes_[63])
    doubled = sum(map(operator.eq, words, words[1:]))
    distinct = len(set(words))
    counts = [n, upper, symbols, marks, doubled, n - distinct, len(lines) - len(set(lines)), int(bytes_[_DIGITS].sum())]
    shares = [
        (upper, letters), (symbols, size), (marks, n), (doubled, n), (distinct, n), (int(bytes_[46] + bytes_[44]), n),
        (int(bytes_[32]), size), (letters, size), (len(lines), n),
    ]
    return [float(np.log1p(c)) for c in counts] + [float(np.log((a + 0.5) / (b + 1.0))) for a, b in shares]


#: Number of statistics.
SIZE = len(statistics(b""))


class Discriminant:
    """Means, Cholesky factors and log determinants of two classes, from their counts, sums and sums of products."""

    def __init__(self, count: np.ndarray, total: np.ndarray, products: np.ndarray):
        mean = total / np.maximum(count, 1)[:, None]
        scatter = products - count[:, None, None] * mean[:, :, None] * mean[:, None, :]
        pooled = scatter.sum(0) / max(count.sum() - 2, 1)
        # Scale by the pooled spread, so that the identity means the same for every statistic.
        self.scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
        outer = np.outer(self.scale, self.scale)
        self.mean, self.factor, self.half_log_det = mean / self.scale, [], []
        for k in (0, 1):
            own = scatter[k] / max(count[k] - 1, 1) / outer
            shrunk = (1 - TO_POOLED) * own + TO_POOLED * pooled / outer
            shrunk = (1 - TO_IDENTITY) * shrunk + TO_IDENTITY * max(np.trace(shrunk) / SIZE, 1e-3) * np.eye(SIZE)
            factor = np.linalg.cholesky(shrunk)
            self.factor.append(np.linalg.inv(factor))
            self.half_log_det.append(float(np.log(np.diag(factor)).sum()))
        self.log_odds = float(np.log((count[1] + 0.5) / (count[0] + 0.5)))
        self.known = bool(min(count) >= 2)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1; the share of label 1 where a class has fewer than two rows."""
        if not self.known:
            return np.full(len(x), 1 / (1 + np.exp(-self.log_odds)))
        density = [-0.5 * (((x / self.scale - self.mean[k]) @ self.factor[k].T) ** 2).sum(1) - self.half_log_det[k] for k in (0, 1)]
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0] + self.log_odds, -500, 500)))


def _described(batch: pa.RecordBatch) -> pa.RecordBatch:
    rows = np.array([statistics(t) for t in batch.column("text").to_pylist()])
    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * SIZE), pa.array(rows.reshape(-1)))
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), batch.column("held_out"), lists], ["doc_id", "text_key", "held_out", "x"])


def _products(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Per label: the count, the sums and the sums of products of a batch, as numbered cells."""
    x = batch.column("x").flatten().to_numpy().reshape(-1, SIZE)
    y = batch.column("quality").to_numpy()
    cells = []
    for label in (0, 1):
        own = x[y == label]
        cells.append(np.concatenate([[len(own)], own.sum(0), (own.T @ own).reshape(-1)]))
    width = len(cells[0])
    labels, places = np.repeat([0, 1], width), np.tile(np.arange(width), 2)
    return pa.RecordBatch.from_arrays([pa.array(labels.astype(np.int32)), pa.array(places.astype(np.int32)), pa.array(np.concatenate(cells))], ["label", "place", "value"])


def fit(described: DataFrame, labels: DataFrame) -> Discriminant:
    """Discriminant of all labelled rows that are not held out.

    Sums are added up by Spark; the driver gets one number per cell.  Labels
    other than 0 and 1 and rows without doc_id are left out.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where("quality IN (0, 1) AND doc_id IS NOT NULL")
    rows = described.where("NOT held_out").join(marks, "doc_id").select("x", "quality")
    sums = map_batches(rows, "label int, place int, value double", _products).groupBy("label", "place").agg(F.sum("value").alias("value"))
    cells = np.zeros((2, 1 + SIZE + SIZE * SIZE))
    for row in sums.collect():
        cells[row["label"], row["place"]] = row["value"]
    return Discriminant(cells[:, 0], cells[:, 1 : 1 + SIZE], cells[:, 1 + SIZE :].reshape(2, SIZE, SIZE))


def score_quality(docs: DataFrame, labels: DataFrame, modulus: int = 4, remainder: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, held_out, score and predicted (1 from a score of 0.7 on).

    Held out are the rows whose id as text has the crc32 remainder; their labels
    are not looked at.  Null and empty texts are scored as texts without words.
    Rows that repeat a doc_id are scored one by one, and each trains with the
    label; a label that is repeated counts again.  A null doc_id is kept and not held
    out.  With fewer than two rows of a label every score is the share of label 1.
    """
    bounded = texts(docs).withColumn("text_key", F.xxhash64("text")).withColumn("held_out", held_out("doc_id", modulus, remainder))
    described = written(map_batches(bounded, "doc_id long, text_key long, held_out boolean, x array<double>", _described))
    shared = docs.sparkSession.sparkContext.broadcast(fit(described, labels))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = shared.value.scores(batch.column("x").flatten().to_numpy().reshape(-1, SIZE))
        arrays = [batch.column(c) for c in ("doc_id", "text_key", "held_out")]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))], ["doc_id", "text_key", "held_out", "score", "predicted"])

    return map_batches(described, "doc_id long, text_key long, held_out boolean, score double, predicted int", work)


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier does not reject."""
    bad = score_quality(docs, labels).where("predicted = 0").select(F.col("doc_id").alias("_bad_id"), F.col("text_key").alias("_bad_key")).distinct()
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["_bad_id"]) & (key == bad["_bad_key"]), "left_anti")
