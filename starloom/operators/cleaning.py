"""Cleaning operators: names, duplicates, missing values, types, outliers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.columns import (
    STAMP_COLUMNS,
    all_of,
    col,
    data_columns,
    is_floating,
    is_missing,
    is_present,
    nan_to_null,
    numeric_columns,
    q,
    timestamp,
    total_order,
)
from starloom.functions.typenames import spark_name
from starloom.operators.positions import CHUNK, POSITION, in_order

STRATEGIES = ("drop", "fillna_mean", "fillna_forward", "fillna_value")


def standardize_column_names(df: DataFrame) -> DataFrame:
    """Lower-case and trim names, blanks inside become underscores."""
    names = [c.lower().strip().replace(" ", "_") for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1})
    if clashes:
        raise ValueError(f"column names clash after standardizing: {clashes}")
    return df.toDF(*names)


def remove_duplicates(
    df: DataFrame, subset: Sequence[str] | None = None, order_by: Sequence[str] = ()
) -> DataFrame:
    """Keep one row per whole row, or the first per ``subset`` in ``order_by`` order.

    Whole rows are compared on data columns, so the stamp of a batch does not hide a
    copy that came with another batch; of such copies the earliest stamps are kept.
    """
    if subset is None:
        stamps = [c for c in df.columns if c in STAMP_COLUMNS]
        if not stamps:
            return df.dropDuplicates()
        subset, order_by = data_columns(df), [*order_by, *stamps]
    return _one_per_key(df, subset, [col(c).asc_nulls_first() for c in total_order(df, order_by)])


def keep_last(df: DataFrame, subset: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep the last row per ``subset`` in ``order_by`` order."""
    return _one_per_key(df, subset, [col(c).desc_nulls_last() for c in total_order(df, order_by)])


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # Spark limits each group to its first row before the shuffle (WindowGroupLimit),
    # so a hot key sends one row per input task.
    window = Window.partitionBy(*map(q, keys)).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def distinct_combinations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations, those with nulls included."""
    return df.select(*map(q, columns)).distinct()


def count_missing(df: DataFrame) -> Column:
    """Aggregate: number of missing cells over all columns of ``df``."""
    return reduce(lambda a, b: a + b, [F.count_if(is_missing(df, c)) for c in df.columns])


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a missing value in any (given) column.

    One condition per column rather than ``na.drop``: Spark pushes each to the scan, and
    plans it in linear time where columns were renamed before.
    """
    return df.filter(all_of(is_present(df, c) for c in (df.columns if subset is None else subset)))


def fill_mean(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Fill numeric columns that miss values with their mean (F2).

    Named ``columns`` become doubles whether they miss values or not, so that every batch
    of a table has the same types.  Without names all numeric columns are looked at, those
    with gaps become doubles, and complete ones keep their type.  Columns without any value
    stay as they are, named ones as doubles.
    """
    df = nan_to_null(df)
    if columns is not None:
        df = df.withColumns({c: col(c).cast("double") for c in columns})
    numeric = numeric_columns(df) if columns is None else list(columns)
    if not numeric:
        return df
    found = df.agg(
        F.struct(*[F.avg(col(c)).cast("double").alias(c) for c in numeric]).alias("mean"),
        F.struct(*[F.count_if(col(c).isNull()).alias(c) for c in numeric]).alias("missing"),
    ).first()
    filled = {
        c: F.coalesce(col(c).cast("double"), F.lit(found.mean[c]))
        for c in numeric
        if found.missing[c] and found.mean[c] is not None
    }
    return df.withColumns(filled) if filled else df


def fill_forward(
    df: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Carry the last value forward in ``order_by`` order, per ``partition_by`` group.

    The rows are range sorted by group and order, then filled inside each sorted chunk,
    so neither a hot group nor the whole-table case ends up in one task.  A chunk starts
    in the middle of at most one group, and what that group carries over is one row per
    chunk; Spark chooses how to join it by its size.
    """
    if not order_by:
        raise ValueError("forward fill needs order_by")
    if columns is None:
        columns = [c for c in df.columns if c not in order_by and c not in partition_by]
    names = df.columns
    df = nan_to_null(df, columns)
    groups = list(partition_by)
    tie_break = [c for c in total_order(df, order_by) if c not in groups]
    placed = in_order(df, [col(c).asc_nulls_first() for c in [*groups, *tie_break]])

    so_far = Window.partitionBy(CHUNK, *map(q, groups)).orderBy(POSITION).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    inside = placed.withColumns(
        {f"__in_{c}": F.last(col(c), ignorenulls=True).over(so_far) for c in columns}
    )

    # Last value of each column at the end of a group's chunk, then carried over chunks.
    ends = placed.groupBy(*map(q, groups), CHUNK).agg(
        *[F.max_by(col(c), F.when(col(c).isNotNull(), F.col(POSITION))).alias(c) for c in columns]
    )
    earlier = Window.partitionBy(*map(q, groups)).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        F.col(CHUNK).alias("__to"),
        *[col(g).alias(f"__group_{g}") for g in groups],
        F.row_number().over(Window.partitionBy(*map(q, groups)).orderBy(CHUNK)).alias("__nth"),
        *[F.last(col(c), ignorenulls=True).over(earlier).alias(f"__carried_{c}") for c in columns],
    ).filter("__nth > 1")

    same = all_of([F.col(CHUNK) == F.col("__to"), *[col(g).eqNullSafe(col(f"__group_{g}")) for g in groups]])
    filled = {c: F.coalesce(col(f"__in_{c}"), col(f"__carried_{c}")).alias(c) for c in columns}
    return inside.join(carried, same, "left").select(*[filled.get(c, col(c)) for c in names])


def fill_value(df: DataFrame, value: Any) -> DataFrame:
    """Fill with one value, or with a value per column."""
    return df.na.fill(dict(value) if isinstance(value, Mapping) else value)


def handle_missing_values(
    df: DataFrame,
    strategy: str = "drop",
    *,
    subset: Sequence[str] | None = None,
    value: Any = None,
    order_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Apply one of ``STRATEGIES``."""
    if strategy == "drop":
        return drop_missing(df, subset)
    if strategy == "fillna_mean":
        return fill_mean(df, subset)
    if strategy == "fillna_forward":
        return fill_forward(df, order_by, partition_by, subset)
    if strategy == "fillna_value":
        return fill_value(df, value)
    raise ValueError(f"unknown strategy {strategy!r}, expected one of {STRATEGIES}")


MISFITS = ("keep", "sibling", "fail")


def coerce_types(
    df: DataFrame, mapping: Mapping[str, str], on_misfit: str = "keep"
) -> tuple[DataFrame, list[str]]:
    """Cast columns.

    Returns the frame and the columns that have values that do not fit.  One pass over the
    mapped columns decides for all of them; nulls fit any type.  ``on_misfit`` says what
    happens to such columns: ``keep`` casts all-or-nothing, so they stay as they are;
    ``fail`` raises; ``sibling`` gives every mapped column its type in every batch and puts
    the text of values that do not fit into ``<column>_text``, without a pass of its own
    (the returned list is empty).
    """
    if on_misfit not in MISFITS:
        raise ValueError(f"unknown on_misfit {on_misfit!r}, expected one of {MISFITS}")
    wanted = {c: spark_name(t) for c, t in mapping.items() if c in df.columns}
    wanted = {c: t for c, t in wanted.items() if df.schema[c].dataType.simpleString() != t}
    if not wanted:
        return df, []
    if on_misfit == "sibling":
        fits = {c: col(c).try_cast(t) for c, t in wanted.items()}
        texts = {f"{c}_text": F.when(~is_missing(df, c) & fits[c].isNull(), col(c).cast("string")) for c in wanted}
        return df.withColumns({**fits, **texts}), []
    misfits = df.agg(
        *[
            F.count_if(~is_missing(df, c) & col(c).try_cast(t).isNull()).alias(c)
            for c, t in wanted.items()
        ]
    ).first().asDict()
    failed = [c for c, n in misfits.items() if n]
    if failed and on_misfit == "fail":
        raise ValueError(f"values that do not fit their type in {failed}")
    casts = {c: col(c).try_cast(t) for c, t in wanted.items() if not misfits[c]}
    return (df.withColumns(casts) if casts else df), failed


def remove_outliers(
    df: DataFrame, columns: Sequence[str] | None = None, z_score_threshold: float = 3.0
) -> DataFrame:
    """Keep rows with ``abs(z) < threshold``, one column after the other.

    Each column's mean and sample deviation come from the rows the previous columns
    left, so one small aggregate runs per column and its two numbers enter the plan as
    literals.  It scans the columns used so far; give it a table, not a long plan.
    A missing value or a constant column has no z score, and such rows go.
    """
    for c in numeric_columns(df) if columns is None else columns:
        if c not in df.columns:
            continue
        value = col(c).cast("double")
        if is_floating(df.schema[c].dataType):
            value = F.when(~F.isnan(value), value)
        mean, deviation = df.agg(F.avg(value), F.stddev_samp(value)).first()
        score = F.try_divide(value - F.lit(mean).cast("double"), F.lit(deviation).cast("double"))
        df = df.filter(F.abs(score) < F.lit(float(z_score_threshold)))
    return df


def apply_transformations(
    df: DataFrame, transformations: Sequence[Callable[[DataFrame], DataFrame]]
) -> DataFrame:
    """Apply the caller's own steps in order (P5)."""
    return reduce(DataFrame.transform, transformations, df)


def add_processing_metadata(df: DataFrame, batch_ts: datetime, layer: str = "silver") -> DataFrame:
    """Stamp when and for which layer the rows were processed."""
    return df.withColumns({"_processing_timestamp": timestamp(batch_ts), "_layer": F.lit(layer)})

