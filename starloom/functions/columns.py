"""Expressions over columns: missing values, comparison, time, total order."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# End date of an open dimension version.
OPEN_END = datetime(2999, 12, 31)

# Metadata columns this library writes beside the data; no other name counts as metadata.
STAMP_COLUMNS = (
    "_ingestion_timestamp",
    "_source_system",
    "_processing_timestamp",
    "_layer",
    "_batch_id",
    "_source_file",
    "_source_offset",
    "_source_row",
)


def q(name: str) -> str:
    """Quote a column name so that dots and blanks in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(q(name))


def timestamp(value: datetime) -> Column:
    """A naive wall-clock literal; it does not move with the session time zone."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def batch_id(batch_ts: datetime) -> str:
    """Sortable batch identifier of one run, to the microsecond."""
    return batch_ts.strftime("%Y%m%d_%H%M%S_%f")


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, and NaN too for floating columns."""
    if is_floating(df.schema[name].dataType):
        return col(name).isNull() | F.isnan(col(name))
    return col(name).isNull()


def is_present(df: DataFrame, name: str) -> Column:
    """The opposite of ``is_missing``, in a form that reaches the scan."""
    if is_floating(df.schema[name].dataType):
        return col(name).isNotNull() & ~F.isnan(col(name))
    return col(name).isNotNull()


def nan_to_null(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Turn NaN into null so that ``isNull`` is enough downstream."""
    names = df.columns if names is None else names
    floating = [n for n in names if is_floating(df.schema[n].dataType)]
    return df.withColumns({n: F.when(~F.isnan(col(n)), col(n)) for n in floating}) if floating else df


def differs(left: Column, right: Column) -> Column:
    """Null-safe inequality; never null itself."""
    return ~left.eqNullSafe(right)


def any_of(conditions: Iterable[Column]) -> Column:
    result = F.lit(False)
    for condition in conditions:
        result = result | condition
    return result


def all_of(conditions: Iterable[Column]) -> Column:
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result


def equal_on(left: str, right: str, names: Sequence[str], null_safe: bool) -> Column:
    """Join condition on equally named columns of two aliased frames."""
    pairs = [(F.col(f"{left}.{q(n)}"), F.col(f"{right}.{q(n)}")) for n in names]
    return all_of(a.eqNullSafe(b) if null_safe else a == b for a, b in pairs)


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric data columns, identifiers included."""
    names = data_columns(df)
    return [f.name for f in df.schema.fields if f.name in names and isinstance(f.dataType, T.NumericType)]


def data_columns(df: DataFrame) -> list[str]:
    """Columns that carry data: all but the stamps this library writes."""
    return [c for c in df.columns if c not in STAMP_COLUMNS]


def orderable(dtype: T.DataType) -> bool:
    return not isinstance(dtype, (T.MapType, T.VariantType))


def total_order(df: DataFrame, order_by: Sequence[str]) -> list[str]:
    """``order_by`` followed by the other sortable columns, so ties are settled."""
    rest = [f.name for f in df.schema.fields if f.name not in order_by and orderable(f.dataType)]
    return [*order_by, *rest]
