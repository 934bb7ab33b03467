"""Positions of rows in a global order, without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.sources.staging import stage

POSITION = "__position"
CHUNK = "__chunk"

# monotonically_increasing_id: partition number above, row number in the lower 33 bits.
_ROW_BITS = 33


def in_order(df: DataFrame, order: Sequence[Column] = ()) -> DataFrame:
    """Stage ``df`` range-sorted by ``order`` with its position in that order.

    ``POSITION`` grows along the order and is read back from the staged table, so
    it never changes.  ``CHUNK`` numbers the sorted partition a row came from.
    Without ``order`` rows keep the partition they are in and nothing is shuffled.

    One table is written.  The sort looks at its input once more to find the ranges;
    what that repeats is the work since the input's last shuffle, which is less than
    writing the input would be.
    """
    ordered = df.sort(*order) if order else df
    staged = stage(ordered.withColumn(POSITION, F.monotonically_increasing_id()))
    return staged.withColumn(CHUNK, F.shiftright(POSITION, _ROW_BITS))


def row_in_chunk() -> Column:
    return F.col(POSITION).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
