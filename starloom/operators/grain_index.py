"""What a written fact part holds, so that later batches need not read it.

For each file of a part the index has the range of every grain column and a blocked
Bloom filter of the grains: a grain sets four bits of one 64-bit word.  A batch is held
against the ranges first, then against the words its grains fall on, and only files that
may hold one of them are opened.  A filter errs to one side only: a file it leaves out
has none of the batch's grains.

The index is two tables of plain rows, made by grouped aggregates over the new part's
grain columns and read with column pruning; a batch meets the words in an equi-join.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.columns import all_of, col, q

PART, FILE = "__part", "__file"
#: Bits of filter a row gets, and the number of words of a file's filter: a power of two within these.
BITS_PER_ROW, LEAST_WORDS, MOST_WORDS = 32, 64, 1 << 20

FILTER_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in (PART, FILE)] + [T.StructField(n, T.LongType()) for n in ("words", "word", "bits")]
)
_NAMES = T.StructType(FILTER_SCHEMA.fields[:2])


def range_schema(schema: T.StructType, grain: Sequence[str]) -> T.StructType:
    """Schema of the table with a row per file."""
    fields = [T.StructField(PART, T.StringType()), T.StructField(FILE, T.StringType()), T.StructField("words", T.LongType())]
    for c in grain:
        fields += [T.StructField(f"least_{c}", schema[c].dataType), T.StructField(f"most_{c}", schema[c].dataType), T.StructField(f"missing_{c}", T.BooleanType())]
    return T.StructType(fields)


def _hash(grain: Sequence[str]) -> Column:
    return F.xxhash64(*map(col, grain))


def _word(words: Column) -> Column:
    return F.col("__hash").bitwiseAND(words - 1)


def _bits() -> Column:
    """Four of the 64 bits, by the upper half of the hash."""
    one = F.lit(1).cast("long")
    chosen = [F.call_function("shiftleft", one, F.shiftrightunsigned(F.col("__hash"), s).bitwiseAND(F.lit(63)).cast("int")) for s in (40, 46, 52, 58)]
    return reduce(Column.bitwiseOR, chosen)


def _ranges(df: DataFrame, grain: Sequence[str]) -> list[Column]:
    out = []
    for c in grain:
        out += [F.min(col(c)).alias(f"least_{c}"), F.max(col(c)).alias(f"most_{c}"), F.coalesce(F.max(col(c).isNull()), F.lit(False)).alias(f"missing_{c}")]
    return out


def filter_words(rows: int, files: int) -> int:
    """Words of the filters of a part; files of twice the mean still get all their bits."""
    enough = max(LEAST_WORDS, 2 * rows * BITS_PER_ROW // (64 * max(1, files)))
    return min(MOST_WORDS, 1 << (enough - 1).bit_length())


def file_ranges(part: DataFrame, grain: Sequence[str], name: str, words: int) -> DataFrame:
    """One row per file of a written part: the ranges of its grain columns."""
    rows = part.select(*map(q, grain), F.col("_metadata.file_name").alias(FILE))
    found = rows.groupBy(FILE).agg(*_ranges(rows, grain)).withColumns({PART: F.lit(name), "words": F.lit(words).cast("long")})
    return found.select(*map(q, range_schema(part.schema, grain).names))


def file_filters(part: DataFrame, grain: Sequence[str], name: str, words: int) -> DataFrame:
    """The words of each file's filter that have any bit."""
    rows = part.select(F.col("_metadata.file_name").alias(FILE), _hash(grain).alias("__hash"))
    found = rows.groupBy(FILE, _word(F.lit(words).cast("long")).alias("word")).agg(F.bit_or(_bits()).alias("bits"))
    return found.withColumns({PART: F.lit(name), "words": F.lit(words).cast("long")}).select(*FILTER_SCHEMA.names)


def _may_overlap(batch: DataFrame, grain: Sequence[str]) -> Column:
    """Condition on the ranges of a file that the batch's ranges, one row, become literals of."""
    own = batch.agg(F.count(F.lit(1)).alias("__rows"), *_ranges(batch, grain)).first()
    if not own["__rows"]:
        return F.lit(False)
    conditions = []
    for c in grain:
        dtype = batch.schema[c].dataType
        least, most = (F.lit(own[f"{s}_{c}"]).cast(dtype) for s in ("least", "most"))
        inside = F.coalesce((F.col(q(f"most_{c}")) >= least) & (F.col(q(f"least_{c}")) <= most), F.lit(False))
        conditions.append(inside | (F.lit(own[f"missing_{c}"]) & F.col(q(f"missing_{c}"))))
    return all_of(conditions)


def files_that_may_hold(ranges: DataFrame, filters: DataFrame, in_batch: DataFrame, grain: Sequence[str]) -> DataFrame:
    """(part, file) of the files that may have a grain of the batch; ``in_batch`` has the grains in the parts' types.

    The driver gets the batch's ranges and the names of files that they meet.  Filters of
    other files are not joined.
    """
    near = ranges.filter(_may_overlap(in_batch, grain)).select(PART, FILE, "words")
    files = [tuple(r) for r in near.collect()]
    found: set[tuple[str, str]] = set()
    # A large batch meets most files in a few words already; the others are then read for the files left over only.
    for few in (True, False):
        open_files = [f for f in files if f[:2] not in found]
        if open_files:
            found |= {tuple(r) for r in _held(filters, in_batch, grain, open_files, few).collect()}
    return in_batch.sparkSession.createDataFrame(sorted(found), _NAMES)


def _held(filters: DataFrame, in_batch: DataFrame, grain: Sequence[str], files: Sequence[tuple[str, str, int]], few: bool) -> DataFrame:
    """Those of the files, (part, file, words), whose filters have a grain of the batch; with ``few`` by one word of `LEAST_WORDS`."""
    sizes = sorted({words for _, _, words in files})
    names = F.broadcast(in_batch.sparkSession.createDataFrame([f[:2] for f in files], _NAMES))
    hashed = in_batch.select(_hash(grain).alias("__hash")).withColumn("words", F.explode(F.array(*[F.lit(s).cast("long") for s in sizes])))
    hashed = hashed.withColumn("word", _word(F.col("words")))
    if few:
        chosen = F.col("word").bitwiseAND(F.lit(LEAST_WORDS - 1)) == 0
        hashed, filters = hashed.filter(chosen), filters.filter(chosen)
    # Dealt by the columns of the join, so that the distinct rows and the join share one shuffle.
    wanted = hashed.select("words", "word", _bits().alias("wanted")).repartition("words", "word").distinct()
    held = filters.join(names, [PART, FILE], "left_semi").alias("f").join(
        wanted.alias("w"),
        (F.col("f.words") == F.col("w.words")) & (F.col("f.word") == F.col("w.word")) & (F.col("f.bits").bitwiseAND(F.col("w.wanted")) == F.col("w.wanted")),
        "left_semi",
    )
    return held.select(PART, FILE).distinct()
