"""How often each word occurs in a corpus."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import written

#: Distinct words that a task counts before it passes them on: bounds its memory.
HELD_WORDS = 200_000


def counted(docs: DataFrame, words_of: Callable[[bytes], list[bytes]]) -> DataFrame:
    """(word, n_all, n_used): occurrences in all rows, and in those with ``used``.  ``docs`` has text as bytes and used.

    Tasks count what they read before the shuffle, so a word in every text costs one row per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both: tuple[Counter, Counter] = (Counter(), Counter())

        def passed_on() -> pa.RecordBatch:
            words = list(both[0].keys() | both[1].keys())
            used = [both[1][w] for w in words]
            every = [both[0][w] + u for w, u in zip(words, used, strict=True)]
            for c in both:
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(every, pa.int64()), pa.array(used, pa.int64())], ["word", "n_all", "n_used"])

        for batch in batches:
            for text, used in zip(batch.column("text").to_pylist(), batch.column("used").to_pylist(), strict=True):
                both[used].update(words_of(text))
                if len(both[0]) + len(both[1]) > HELD_WORDS:
                    yield passed_on()
        if both[0] or both[1]:
            yield passed_on()

    counts = docs.select("text", "used").mapInArrow(run, "word binary, n_all long, n_used long")
    return counts.groupBy("word").agg(F.sum("n_all").alias("n_all"), F.sum("n_used").alias("n_used"))


def least_count(counts: DataFrame, most: int) -> int:
    """The smallest count such that at most ``most`` words occur so often or oftener.

    Reads the number of words per count: one row for each different count.
    """
    total, least = 0, None
    per_count = counts.groupBy("n_all").count().orderBy(F.desc("n_all")).select("n_all", "count")
    for row in per_count.toLocalIterator():
        total += row["count"]
        if total > most:
            break
        least = row["n_all"]
    return least if least is not None else 1 << 62


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows of the most frequent words, ``most`` at the most."""
    return counts.where(F.col("n_all") >= least_count(counts, most))


def written_counts(docs: DataFrame, words_of: Callable[[bytes], list[bytes]]) -> DataFrame:
    """`counted`, written once for the steps that read it."""
    return written(counted(docs, words_of))
