"""Small steps that several operators share: batches, word hashes, windows, written tables."""

from __future__ import annotations

import gc
import hashlib
import io
import itertools
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.sources.files import delete
from starloom.sources.staging import shared_folder, stage

#: Rows and bytes of an Arrow batch: bounds what a Python worker holds at once.
BATCH_ROWS, BATCH_BYTES = 500, 16 << 20

#: Odd multiplier of the polynomial over word hashes, and the constants of the 64-bit finaliser of splitmix.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def published(spark: SparkSession, content: bytes, ending: str) -> str:
    """Put a file into the shared folder, named by its content and deleted when the session's JVM ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark), f"starloom-{hashlib.sha256(content).hexdigest()[:32]}{ending}")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        out = system.create(path, True)
        # A call's argument is held several times over on its way.
        for i in range(0, len(content), 1 << 20):
            out.write(bytearray(content[i : i + (1 << 20)]))
        out.close()
        system.deleteOnExit(path)
    return system.makeQualified(path).toString()


def _send_package(spark: SparkSession) -> None:
    """Have executors fetch this package, so that their Python workers can import it wherever the driver was started."""
    context = spark.sparkContext
    if getattr(context, "_starloom_sent", False):
        return
    root = Path(__file__).resolve().parent.parent
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.writestr(zipfile.ZipInfo(str(Path(root.name) / file.relative_to(root))), file.read_bytes())
    context.addPyFile(published(spark, buffer.getvalue(), ".zip"))
    context._starloom_sent = True


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches small enough for long texts, read by workers that have this package."""
    _send_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text has the remainder; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and the whole text as UTF-8 bytes (null: empty); other columns are dropped."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def keyed_texts(docs: DataFrame) -> DataFrame:
    """`texts` with a hash of the text: (doc_id, text_key) tells rows apart that repeat a doc_id."""
    return texts(docs).withColumn("text_key", F.xxhash64("text"))


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Join condition on (doc_id, text_key) where a null doc_id equals itself."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_key"] == right["text_key"])


def written(df: DataFrame) -> DataFrame:
    """A staged copy of ``df``.  Shuffle files of the jobs before it are let go, so that they do not add up on disk."""
    out = stage(df)
    del df
    gc.collect()
    out.sparkSession.sparkContext._jvm.System.gc()
    return out


def dropped(*staged: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in staged:
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            delete(df.sparkSession, path)


def map_batches(df: DataFrame, schema: str, work: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := work(batch)) is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixing, so that close values become unrelated."""
    x = (x ^ (x >> _S30)) * _MIX1
    x = (x ^ (x >> _S27)) * _MIX2
    return x ^ (x >> _S31)


def hashed_words(lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words one after another, and where each text starts (with the end as last)."""
    starts = np.zeros(len(lists) + 1, np.int64)
    np.cumsum([len(words) for words in lists], out=starts[1:])
    return np.fromiter(map(xxhash.xxh3_64_intdigest, itertools.chain.from_iterable(lists)), np.uint64, int(starts[-1])), starts


def gram_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of the ``size`` words from each position on; the last ``size - 1`` positions have none."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, np.uint64(seed * 2 + 1))
    for i in range(size):
        total *= _BASE
        total += words[i : i + n]
    return mixed(total)


def span_hashes(words: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function of (first, end) positions that gives the hash of the words between them."""
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(words), _BASE)]), dtype=np.uint64)
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    undo = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(words), inverse)]), dtype=np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(words * powers[:-1], dtype=np.uint64)])
    return lambda first, end: mixed((sums[end] - sums[first]) * undo[first] + (end - first).astype(np.uint64))


def sliding_minimum(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each ``size`` neighbouring values, by doubling."""
    n = len(values) - size + 1
    if n <= 0:
        return values[:0]
    have, low = 1, values
    while have * 2 <= size:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    return np.minimum(low[:n], low[size - have : size - have + n])


def fitting(starts: np.ndarray, size: int) -> np.ndarray:
    """Positions from which ``size`` words lie in one text."""
    lengths = np.diff(starts)
    ends = np.repeat(starts[1:], lengths)
    return np.flatnonzero(np.arange(starts[-1]) + size <= ends)


def text_of(starts: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Index of the text that each position lies in."""
    return np.searchsorted(starts, positions, side="right") - 1


def distinct_by_text(owner: np.ndarray, values: np.ndarray, texts_: int) -> pa.ListArray:
    """The distinct values of each text as a list column of longs."""
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    first = np.ones(len(values), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    owner, values = owner[first], values[first]
    offsets = np.searchsorted(owner, np.arange(texts_ + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))
