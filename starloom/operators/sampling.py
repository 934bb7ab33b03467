"""A seeded sample of an exact number of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import col, q, total_order
from starloom.sources.staging import stage

#: Hexadecimal digits looked at in a round, and rows that are small enough to be sorted.
DIGITS, SORTED_ROWS = 4, 100_000
_ALL_DIGITS = 32


def keyed_hash(seed: int, by: Sequence[str]) -> Column:
    """md5 of the seed and the columns as text, in hexadecimal; a missing value is not an empty one."""
    parts = [F.coalesce(F.concat(F.lit("="), col(c).cast("string")), F.lit("-")) for c in by]
    return F.md5(F.concat_ws("\x1f", F.lit(str(seed)), *parts).cast("binary"))


def sample_rows(df: DataFrame, n: int, seed: int, by: Sequence[str] | None = None) -> DataFrame:
    """``n`` rows without replacement, all of them if there are fewer.

    The rows with the smallest hashes of the seed and the columns ``by`` (all sortable ones by
    default) are taken, so the sample is the same however the rows are partitioned and
    ordered, and a sample of fewer rows is part of one of more.  Ties are settled by the
    other columns; equal rows are as good as each other.

    No sort over all rows: rows are counted by the first digits of their hash, those
    below the digits where the count is reached are taken in place, and only rows with
    just those digits are looked at further.  The driver sees counts of 65,536 beginnings.
    """
    if n < 0:
        raise ValueError(f"cannot take {n} rows")
    by = total_order(df, ()) if by is None else list(by)
    hashed = df.withColumn("__hash", keyed_hash(seed, by))
    taken, open_rows, left, depth = [], hashed, n, 0
    while True:
        start = F.substring("__hash", depth + 1, DIGITS)
        counts = sorted(tuple(r) for r in open_rows.groupBy(start.alias("start")).count().collect())
        total = sum(count for _, count in counts)
        if total <= left:
            taken.append(open_rows)
            break
        border, below = next((s, b) for s, b, count in _running(counts) if b + count > left)
        if below:
            taken.append(open_rows.filter(start < border))
        left -= below
        depth += DIGITS
        at_border = open_rows.filter(start == border)
        if dict(counts)[border] <= SORTED_ROWS or depth >= _ALL_DIGITS:
            taken.append(at_border.orderBy("__hash", *map(q, total_order(df, by))).limit(left))
            break
        open_rows = stage(at_border)
    found = taken[0]
    for part in taken[1:]:
        found = found.unionByName(part)
    return found.drop("__hash")


def _running(counts: Sequence[tuple[str, int]]):
    """(beginning, rows before it, its rows)."""
    before = 0
    for start, count in counts:
        yield start, before, count
        before += count
