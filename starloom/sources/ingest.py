"""Raw sources: CSV, frames, rows of dicts."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.columns import col, timestamp
from starloom.sources.layers import read_layer, write_layer

# Texts that mean "missing" in a CSV field.
MISSING_MARKERS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

SOURCE_SYSTEM = "raw_ingestion"
FILE_ORDER = ("_source_file", "_source_offset", "_source_row")

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    record_order: bool = False,
    lenient: bool = False,
    **options: Any,
) -> DataFrame:
    """Read CSV with a header; quoted commas and doubled quotes are understood (A1).

    Fields are read as text, missing markers become null, then the columns get the types
    of ``schema``, or inferred ones.  A value that does not fit ``schema`` fails the read,
    or, if ``lenient``, leaves its whole column as text.  ``record_order`` adds
    ``FILE_ORDER`` columns that sort rows as they stand in the files.

    Line breaks inside quotes need ``multiLine=True``, which keeps Spark from splitting
    files.  Without it a line with an odd number of quotes raises, as it would give
    two broken records.
    """
    if not options.get("multiLine"):
        whole_lines(spark, path)
    reader = spark.read.options(header=True, quote='"', escape='"', **options)
    if schema is not None:
        as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        reader = reader.schema(as_text).options(enforceSchema=False)
    text = reader.csv(path)
    names = text.columns
    fields = [F.when(~col(c).isin(*MISSING_MARKERS), col(c)).alias(c) for c in names]
    place = []
    if record_order:
        found = (
            F.col("_metadata.file_path"),
            F.col("_metadata.file_block_start"),
            F.monotonically_increasing_id(),
        )
        place = [c.alias(n) for c, n in zip(found, FILE_ORDER, strict=True)]
    text = text.select(*fields, *place)
    if schema is not None:
        types = {f.name: f.dataType for f in schema.fields}
        if lenient:
            odd = text.agg(
                *[F.count_if(col(c).isNotNull() & col(c).try_cast(types[c]).isNull()).alias(c) for c in names]
            ).first()
            types = {c: T.StringType() if odd[c] else types[c] for c in names}
    else:
        types = infer_types(text, names)
    return text.select(*[col(c).cast(types[c]).alias(c) for c in names], *(FILE_ORDER if record_order else ()))


def whole_lines(spark: SparkSession, path: str) -> None:
    """Raise if a line has an odd number of quotes: a quoted field goes on in the next line."""
    value = F.col("value")
    quotes = F.length(value) - F.length(F.translate(value, '"', ""))
    broken = spark.read.text(path).filter(quotes % 2 == 1).take(1)
    if broken:
        raise ValueError(f"line breaks inside quotes in {path}: read it with multiLine=True; first line: {broken[0][0][:80]}")


def infer_types(text: DataFrame, names: Iterable[str]) -> dict[str, T.DataType]:
    """Narrowest of bigint, double, boolean that holds all values of a text column, in one pass.

    Columns with other values, or with none at all, stay text.
    """
    misfits = []
    names = list(names)
    for c in names:
        value = col(c)
        misfits += [
            F.count(value).alias(f"{c}|values"),
            F.count_if(value.isNotNull() & value.try_cast("bigint").isNull()).alias(f"{c}|bigint"),
            F.count_if(value.isNotNull() & ~value.rlike(_NUMBER)).alias(f"{c}|double"),
            F.count_if(value.isNotNull() & ~F.lower(value).isin("true", "false")).alias(f"{c}|boolean"),
        ]
    counts = text.agg(*misfits).first().asDict()
    candidates = {"bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}
    return {
        c: next(
            (t for n, t in candidates.items() if counts[f"{c}|values"] and not counts[f"{c}|{n}"]),
            T.StringType(),
        )
        for c in names
    }


def stamp(df: DataFrame, batch_ts: datetime, source_system: str = SOURCE_SYSTEM) -> DataFrame:
    """Add when and from which system the batch came."""
    return df.withColumns(
        {"_ingestion_timestamp": timestamp(batch_ts), "_source_system": F.lit(source_system)}
    )


def in_given_order(df: DataFrame) -> DataFrame:
    """``FILE_ORDER`` columns for a source that is no file: the order of its partitions."""
    place = (F.lit(""), F.lit(0).cast("bigint"), F.monotonically_increasing_id())
    return df.withColumns(dict(zip(FILE_ORDER, place, strict=True)))


def as_frame(
    spark: SparkSession,
    source: DataFrame | str | os.PathLike | Iterable[Mapping[str, Any]],
    schema: T.StructType | None = None,
    record_order: bool = False,
    options: Mapping[str, Any] | None = None,
) -> DataFrame:
    """A frame, a CSV path, or rows as dicts (A2-A4); errors of the source surface.

    ``options`` go to the CSV reader.
    """
    if isinstance(source, DataFrame):
        return in_given_order(source) if record_order else source
    if isinstance(source, (str, os.PathLike)):
        return read_csv(spark, os.fspath(source), schema, record_order, **(options or {}))
    if isinstance(source, Iterable):
        rows = list(source)
        if not rows:
            raise ValueError("no rows to ingest")
        # What must not be missing is for the checks to say, not for the reader.
        relaxed = schema and T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
        frame = spark.createDataFrame(rows, relaxed)
        return in_given_order(frame) if record_order else frame
    raise ValueError(f"cannot ingest a {type(source).__name__}; give a frame, a CSV path or rows")


def describe(source: object) -> str:
    """Name of a source for the run log."""
    return os.fspath(source) if isinstance(source, (str, os.PathLike)) else type(source).__name__


def ingest(
    spark: SparkSession,
    source: DataFrame | str | os.PathLike | Iterable[Mapping[str, Any]],
    root: str,
    table: str,
    batch_ts: datetime,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    record_order: bool = False,
    options: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Stamp a source, write it as one batch of the raw layer, return what was written."""
    stamped = stamp(as_frame(spark, source, schema, record_order, options), batch_ts)
    write_layer(stamped, root, table, batch_ts, fmt)
    return read_layer(spark, root, table, stamped.schema, fmt, batch_ts)
