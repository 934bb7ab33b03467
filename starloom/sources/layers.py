"""Layer tables: one folder per table, one partition per batch."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.columns import batch_id, col
from starloom.sources.files import create_new, delete, names

BATCH = "_batch_id"
ATTEMPT = "_attempt"
#: Folder of a table's entries; readers of the table pass over a folder with such a name.
ENTRIES = "_entries"
FORMATS = ("parquet", "json", "csv")

# CSV as these tables are written: line breaks, blanks and quotes in texts, and times to the
# microsecond come back as they were.  A null is written as \\N and an empty text as \\E; a
# text that starts with a backslash gets one more, so no text is taken for either.
NULL_TEXT, EMPTY_TEXT = "\\N", "\\E"
TIME_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "multiLine": True,
    "nullValue": NULL_TEXT,
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    **TIME_OPTIONS,
}
OPTIONS = {"csv": CSV_OPTIONS, "json": TIME_OPTIONS, "parquet": {}}


def _checked(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}, expected one of {FORMATS}")
    return fmt


def _texts(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]


def encoded(df: DataFrame, fmt: str) -> DataFrame:
    """Texts as they are written in a format."""
    if fmt != "csv":
        return df
    marked = {
        c: F.when(col(c) == "", F.lit(EMPTY_TEXT)).when(col(c).startswith("\\"), F.concat(F.lit("\\"), col(c))).otherwise(col(c))
        for c in _texts(df.schema)
    }
    return df.withColumns(marked) if marked else df


def decoded(df: DataFrame, fmt: str) -> DataFrame:
    """Texts as they were before `encoded`."""
    if fmt != "csv":
        return df
    plain = {
        c: F.when(col(c) == EMPTY_TEXT, F.lit("")).when(col(c).startswith("\\"), F.substring(col(c), F.lit(2), F.length(col(c)))).otherwise(col(c))
        for c in _texts(df.schema)
    }
    return df.withColumns(plain) if plain else df


def writer(df: DataFrame, fmt: str) -> DataFrameWriter:
    """Writer of a format, with texts encoded for it."""
    return encoded(df, _checked(fmt)).write.format(fmt).options(**OPTIONS[fmt])


def reader(spark: SparkSession, fmt: str) -> DataFrameReader:
    """Reader of a format; texts are still to be `decoded`."""
    return spark.read.format(_checked(fmt)).options(**OPTIONS[fmt])


def partition_path(root: str, table: str, batch: str) -> str:
    return f"{root}/{table}/{BATCH}={batch}"


def _entries(spark: SparkSession, root: str, table: str) -> dict[str, str]:
    """Batch to attempt that its last entry names, from one listing."""
    newest: dict[str, str] = {}
    for name in names(spark, f"{root}/{table}/{ENTRIES}"):
        batch, _, attempt = name.split(".")
        newest[batch] = attempt  # names are in order
    return newest


def _batches(spark: SparkSession, root: str, table: str) -> Iterator[tuple[str, str, bool]]:
    """Batches of a layer table, newest first: identifier, folder, whether an entry names it.

    A folder of attempts without an entry is what a write that did not end has left.  Folders
    of other writers hold their files themselves.
    """
    entries = _entries(spark, root, table)
    folders = [n.split("=", 1)[1] for n in names(spark, f"{root}/{table}") if n.startswith(f"{BATCH}=")]
    for batch in sorted(folders, reverse=True):
        path = partition_path(root, table, batch)
        if batch in entries:
            yield batch, f"{path}/{ATTEMPT}={entries[batch]}", True
        elif not any(n.startswith(f"{ATTEMPT}=") for n in names(spark, path)):
            yield batch, path, False


def write_layer(df: DataFrame, root: str, table: str, batch_ts: datetime, fmt: str = "parquet") -> str:
    """Write ``df`` as the batch's partition; writing the batch again replaces it.

    Every write has a folder of its own, and counts once an entry names it, so a write that
    dies leaves what was there.  Entries are empty files whose names hold the batch, a
    number and the attempt: they need nothing of the file system but that a file that was
    made is listed, and of two writers of one batch the same one counts for every reader.
    """
    spark, batch, attempt = df.sparkSession, batch_id(batch_ts), uuid.uuid4().hex
    path = f"{partition_path(root, table, batch)}/{ATTEMPT}={attempt}"
    writer(df, fmt).mode("errorifexists").save(path)
    numbers = [int(n.split(".")[1]) for n in names(spark, f"{root}/{table}/{ENTRIES}") if n.startswith(f"{batch}.")]
    create_new(spark, f"{root}/{table}/{ENTRIES}/{batch}.{max(numbers, default=0) + 1:09d}.{attempt}", "")
    return path


def remove_replaced(spark: SparkSession, root: str, table: str) -> list[str]:
    """Delete the attempts that no entry names any more and return their folders; not to be called while a write or an older read runs."""
    entries, gone = _entries(spark, root, table), []
    for batch in [n.split("=", 1)[1] for n in names(spark, f"{root}/{table}") if n.startswith(f"{BATCH}=")]:
        path = partition_path(root, table, batch)
        attempts = [n for n in names(spark, path) if n.startswith(f"{ATTEMPT}=")]
        gone += [f"{path}/{n}" for n in attempts if n.split("=", 1)[1] != entries.get(batch)]
    for path in gone:
        delete(spark, path)
    return gone


def read_layer(
    spark: SparkSession,
    root: str,
    table: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    batch_ts: datetime | None = None,
) -> DataFrame:
    """Read all batches with their ``_batch_id``, or one batch without it."""
    if batch_ts is not None:
        batch = batch_id(batch_ts)
        attempt = _entries(spark, root, table).get(batch)
        path = partition_path(root, table, batch) + (f"/{ATTEMPT}={attempt}" if attempt else "")
        found = reader(spark, fmt)
        return decoded((found.schema(schema) if schema else found).load(path), fmt)
    parts = []
    batches = list(_batches(spark, root, table))
    for named in (True, False):
        paths = [path for _, path, with_entry in batches if with_entry is named]
        if paths:
            found = reader(spark, fmt).option("basePath", f"{root}/{table}")
            if schema is not None:
                stamps = [BATCH, *([ATTEMPT] if named else [])]
                found = found.schema(T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in stamps]]))
            part = decoded(found.load(paths), fmt)
            # Without a schema Spark takes identifiers of digits alone for numbers.
            parts.append(part.withColumn(BATCH, F.col(BATCH).cast("string")).drop(ATTEMPT))
    if not parts:
        raise ValueError(f"no batch of {table} in {root}")
    return reduce(DataFrame.unionByName, parts)


def newest_batch(spark: SparkSession, root: str, table: str) -> str | None:
    """Identifier of the newest batch of a layer table, from the names of its folders."""
    return next((batch for batch, _, _ in _batches(spark, root, table)), None)


def read_newest(
    spark: SparkSession, root: str, table: str, schema: T.StructType | None = None, fmt: str = "parquet"
) -> DataFrame:
    """The newest batch with its ``_batch_id``; no other partition is opened."""
    newest = next(_batches(spark, root, table), None)
    if newest is None:
        raise ValueError(f"no batch of {table} in {root}")
    found = reader(spark, fmt)
    found = found.schema(schema) if schema else found
    return decoded(found.load(newest[1]), fmt).withColumn(BATCH, F.lit(newest[0]))
