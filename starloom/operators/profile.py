"""Table profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import col, is_missing, q
from starloom.functions.typenames import name_of, struct
from starloom.sources.rows import small_frame

_COLUMNS = struct(__nth="bigint", column_name="string", column_type="string")


def profile(df: DataFrame) -> DataFrame:
    """Per column: type, rows, missing values, exact number of distinct values.

    The table is scanned once.  Each row is turned into one (column, value) row per column,
    with a slot for each type that occurs, and the values are folded with their counts
    before the one shuffle that brings equal ones together, so a hot value is one row per
    task.  What is left is one row per column and task.
    """
    types = list(dict.fromkeys(f.dataType for f in df.schema.fields))

    def entry(nth: int, name: str) -> Column:
        gone, own = is_missing(df, name), df.schema[name].dataType
        slots = [(F.when(~gone, col(name)) if t == own else F.lit(None).cast(t)).alias(f"__value_{i}") for i, t in enumerate(types)]
        return F.struct(F.lit(nth).cast("bigint").alias("__nth"), gone.alias("__gone"), *slots)

    slots = [q(f"__value_{i}") for i in range(len(types))]
    entries = F.array(*[entry(i, c) for i, c in enumerate(df.columns)])
    values = df.select(F.inline(entries)).groupBy("__nth", "__gone", *slots).agg(F.count(F.lit(1)).alias("__n"))
    found = values.groupBy("__nth").agg(
        F.sum("__n").alias("row_count"),
        F.coalesce(F.sum(F.when(F.col("__gone"), F.col("__n"))), F.lit(0)).alias("missing_count"),
        F.count_if(~F.col("__gone")).alias("distinct_count"),
    )
    names = [{"__nth": i, "column_name": c, "column_type": name_of(df.schema[c].dataType)} for i, c in enumerate(df.columns)]
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in ("row_count", "missing_count", "distinct_count")]
    return small_frame(df.sparkSession, names, _COLUMNS).join(found, "__nth", "left").select("column_name", "column_type", *counts)
