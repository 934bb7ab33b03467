"""Dense surrogate keys (K1-K3)."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import col, q
from starloom.functions.typenames import struct
from starloom.operators.positions import CHUNK, in_order, row_in_chunk
from starloom.sources.rows import small_frame

_STARTS = struct(**{CHUNK: "bigint", "__start": "bigint"})


def _nulls_first(order_by: Sequence[str | Column]) -> list[Column]:
    return [c if isinstance(c, Column) else col(c).asc_nulls_first() for c in order_by]


def dense_keys(
    df: DataFrame, key: str, order_by: Sequence[str | Column] = (), offset: int = 0
) -> DataFrame:
    """Number rows ``offset + 1 .. offset + n`` and put the key first.

    Rows are written once, range-sorted by ``order_by``, counted per sorted partition,
    and numbered from the total of the partitions before.  The driver sees one count per
    partition; the totals go back as a local relation.  Without ``order_by`` any dense
    numbering will do and the rows are not shuffled.
    """
    columns = [c for c in df.columns if c != key]
    placed = in_order(df.select(*map(q, columns)), _nulls_first(order_by))
    sizes = sorted(placed.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("__rows")).collect())
    totals = accumulate((r["__rows"] for r in sizes), initial=offset)
    starts = small_frame(df.sparkSession, [{CHUNK: r[CHUNK], "__start": start} for r, start in zip(sizes, totals)], _STARTS)
    number = (F.col("__start") + row_in_chunk() + 1).cast("bigint")
    return placed.join(starts, CHUNK).select(number.alias(key), *map(q, columns))


def max_key(df: DataFrame, key: str) -> int:
    """Largest key in use, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(col(key)), F.lit(0)).cast("bigint")).first()[0]


def next_key(df: DataFrame, key: str) -> int:
    """The key the next new row gets."""
    return max_key(df, key) + 1
