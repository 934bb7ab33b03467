"""Dimension rows and their merge by SCD type."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.columns import all_of, any_of, col, differs, equal_on, is_present, orderable, q, timestamp, total_order
from starloom.operators.cleaning import distinct_combinations, drop_missing, keep_last
from starloom.operators.keys import dense_keys, max_key
from starloom.operators.scd import (
    close_versions,
    current_records,
    open_versions,
    replaced_keys,
    require_single_current,
    scd2_changes,
)
from starloom.plans.specs import DimensionSpec
from starloom.sources.staging import stage

_AUDIT_TYPES = {"is_current": T.BooleanType()}


def dimension_schema(source: DataFrame, spec: DimensionSpec) -> T.StructType:
    """Schema of the dimension built from ``source``."""
    fields = [T.StructField(spec.key, T.LongType())]
    fields += [T.StructField(c, source.schema[c].dataType) for c in spec.business_columns]
    fields += [T.StructField(c, _AUDIT_TYPES.get(c, T.TimestampNTZType())) for c in spec.audit_columns]
    return T.StructType(fields)


def dimension_rows(source: DataFrame, spec: DimensionSpec) -> DataFrame:
    """One row per natural key, without surrogate key and audit columns."""
    if spec.scd == 0:
        return distinct_combinations(source, spec.natural_keys)
    needed = list(dict.fromkeys([*spec.business_columns, *spec.order_by]))
    known = drop_missing(source.select(*map(q, needed)), spec.natural_keys)
    return keep_last(known, spec.natural_keys, spec.order_by).select(*map(q, spec.business_columns))


_DIM, _LAST = "__dim", "__last_{}"


def _by_last(source: DataFrame, spec: DimensionSpec) -> list[str]:
    """The columns that decide which row of a key is the last, in that order; all that its row needs."""
    needed = list(dict.fromkeys([*spec.business_columns, *spec.order_by]))
    return total_order(source.select(*map(q, needed)), spec.order_by)


def foldable(source: DataFrame, spec: DimensionSpec) -> bool:
    """Whether the rows of the dimension can be folded with those of others: all columns can be compared."""
    return all(orderable(source.schema[c].dataType) for c in spec.business_columns)


def folded_rows(source: DataFrame, specs: Sequence[DimensionSpec]) -> DataFrame:
    """The rows of several dimensions of one source, from one scan and one shuffle.

    Every source row stands once for each dimension, with its natural key and, where the
    last row counts, the columns that decide; tasks fold these per key before they
    shuffle them, so a hot key is one row per task.  ``rows_from_fold`` takes them apart.
    """
    keys = list(dict.fromkeys(c for s in specs for c in s.natural_keys))
    lasts = [s for s in specs if s.scd != 0]

    def entry(number: int, spec: DimensionSpec) -> Column:
        own = [(col(c) if c in spec.natural_keys else F.lit(None).cast(source.schema[c].dataType)).alias(c) for c in keys]
        payloads = []
        for s in lasts:
            fields = F.struct(*map(col, _by_last(source, s)))
            payloads.append((fields if s is spec else F.when(F.lit(False), fields)).alias(_LAST.format(s.name)))
        return F.struct(F.lit(number).alias(_DIM), *own, *payloads)

    needed = list(dict.fromkeys([*keys, *(c for s in lasts for c in _by_last(source, s))]))
    present = [
        (F.col(_DIM) != i) | all_of(is_present(source, c) for c in s.natural_keys) for i, s in enumerate(specs) if s.scd != 0
    ]
    rows = source.select(*map(q, needed)).select(F.inline(F.array(*[entry(i, s) for i, s in enumerate(specs)]))).filter(all_of(present))
    return rows.groupBy(_DIM, *map(q, keys)).agg(*[F.max(_LAST.format(s.name)).alias(_LAST.format(s.name)) for s in lasts], F.lit(1).alias("__one")).drop("__one")


def rows_from_fold(folded: DataFrame, specs: Sequence[DimensionSpec]) -> dict[str, DataFrame]:
    """What ``dimension_rows`` gives for each dimension, from their fold."""
    out = {}
    for i, spec in enumerate(specs):
        own = folded.filter(F.col(_DIM) == i)
        last = _LAST.format(spec.name)
        columns = [col(c) for c in spec.natural_keys] + [F.col(last)[c].alias(c) for c in spec.attributes]
        out[spec.name] = own.select(*columns)
    return out


def build_dimension(
    source: DataFrame, spec: DimensionSpec, batch_ts: datetime, rows: DataFrame | None = None
) -> DataFrame:
    """Full build: keys 1..n in natural-key order; ``rows`` if the dimension's rows are there already."""
    rows = dense_keys(dimension_rows(source, spec) if rows is None else rows, spec.key, spec.natural_keys)
    return _with_audit(rows, spec, dimension_schema(source, spec), batch_ts)


def merge_dimension(
    existing: DataFrame | None,
    source: DataFrame,
    spec: DimensionSpec,
    batch_ts: datetime,
    touch_unchanged: bool = True,
    rows: DataFrame | None = None,
    last_key: int | None = None,
) -> DataFrame:
    """Merge the dimension rows of a batch into the existing dimension.

    Keys of existing rows never change; new rows continue after the largest key.
    """
    if existing is None:
        return build_dimension(source, spec, batch_ts, rows)
    # The rows feed several joins below: reduce the source to them only once.
    rows = stage(dimension_rows(source, spec)) if rows is None else rows
    if spec.scd == 0:
        return merge_type0(existing, rows, spec, batch_ts, last_key)
    if spec.scd == 1:
        return merge_scd1(existing, rows, spec, batch_ts, touch_unchanged, last_key)
    return merge_scd2(existing, rows, spec, batch_ts, last_key)


def dimension_delta(
    existing: DataFrame,
    source: DataFrame,
    spec: DimensionSpec,
    batch_ts: datetime,
    last_key: int,
    touch_unchanged: bool = True,
    rows: DataFrame | None = None,
) -> DataFrame:
    """The rows a batch adds to the dimension or changes in it, whole, each once.

    The existing dimension is filtered in place to the rows whose natural key the batch
    has; everything after that works on those.  ``last_key`` is the largest key in use.
    """
    rows = stage(dimension_rows(source, spec)) if rows is None else rows
    known = current_records(existing) if spec.scd == 2 else existing
    same = equal_on("e", "r", spec.natural_keys, null_safe=spec.scd == 0)
    met = stage(known.alias("e").join(rows.select(*map(q, spec.natural_keys)).alias("r"), same, "left_semi"))
    if spec.scd == 0:
        return merge_type0(met, rows, spec, batch_ts, last_key).filter(col(spec.key) > last_key)
    if spec.scd == 1:
        merged = merge_scd1(met, rows, spec, batch_ts, touch_unchanged, last_key)
        stamp = timestamp(batch_ts).cast(existing.schema["dw_update_date"].dataType)
        return merged.filter(col("dw_update_date") == stamp)
    # Of the versions that were open only those that the batch has closed are changed.
    return merge_scd2(met, rows, spec, batch_ts, last_key).filter((col(spec.key) > last_key) | ~col("is_current"))


def newest_rows(base: DataFrame, deltas: Sequence[DataFrame], key: str) -> DataFrame:
    """A dimension from its base and what later batches added or changed, oldest first.

    The base is filtered in place by the keys of the deltas, which are small beside it, and
    is not shuffled where Spark can broadcast them.
    """
    if not deltas:
        return base
    tagged = reduce(DataFrame.unionByName, [d.withColumn("__nth", F.lit(i)) for i, d in enumerate(deltas)])
    last = Window.partitionBy(q(key)).orderBy(F.desc("__nth"))
    newest = tagged.withColumn("__back", F.row_number().over(last)).filter("__back = 1").drop("__back", "__nth")
    return base.join(newest.select(q(key)), key, "left_anti").select(*map(q, base.columns)).unionByName(newest)


def merge_type0(
    existing: DataFrame, rows: DataFrame, spec: DimensionSpec, batch_ts: datetime, last_key: int | None = None
) -> DataFrame:
    """Insert unseen natural keys, never update."""
    new = _unseen(existing, rows, spec.natural_keys, null_safe=True)
    return _append(existing, new, spec, batch_ts, _last(existing, spec, last_key))


def merge_scd1(
    existing: DataFrame,
    rows: DataFrame,
    spec: DimensionSpec,
    batch_ts: datetime,
    touch_unchanged: bool = True,
    last_key: int | None = None,
) -> DataFrame:
    """Overwrite the attributes of known keys, nulls included, and insert new keys."""
    hit = rows.select(
        *[col(c).alias(f"__new_{c}") for c in spec.business_columns], F.lit(True).alias("__hit")
    )
    # One full outer join, written once, gives the rows that stay, change and come new.
    same = all_of(col(c) == col(f"__new_{c}") for c in spec.natural_keys)
    joined = stage(existing.withColumn("__known", F.lit(True)).join(hit, same, "full_outer"))
    found = F.coalesce(F.col("__hit"), F.lit(False))
    touched = found
    if not touch_unchanged:
        touched = found & any_of(differs(col(c), col(f"__new_{c}")) for c in spec.attributes)
    values = {
        c: F.when(found, col(f"__new_{c}").cast(existing.schema[c].dataType)).otherwise(col(c)).alias(c)
        for c in spec.attributes
    }
    values["dw_update_date"] = (
        F.when(touched, timestamp(batch_ts).cast(existing.schema["dw_update_date"].dataType))
        .otherwise(col("dw_update_date"))
        .alias("dw_update_date")
    )
    updated = joined.filter("__known").select(*[values.get(c, col(c)) for c in existing.columns])
    new = joined.filter("__known IS NULL").select(*[col(f"__new_{c}").alias(c) for c in spec.business_columns])
    return _append(updated, new, spec, batch_ts, _last(existing, spec, last_key))


def merge_scd2(
    existing: DataFrame, rows: DataFrame, spec: DimensionSpec, batch_ts: datetime, last_key: int | None = None
) -> DataFrame:
    """Close the open version of changed keys and add keyed new versions."""
    require_single_current(existing, spec.natural_keys)
    changes = scd2_changes(existing, rows, spec.natural_keys, spec.attributes)
    keyed = dense_keys(changes, spec.key, spec.natural_keys, _last(existing, spec, last_key))
    kept = close_versions(existing, replaced_keys(keyed, spec.natural_keys), spec.natural_keys, batch_ts)
    return kept.unionByName(_with_audit(keyed, spec, existing.schema, batch_ts))


def _last(existing: DataFrame, spec: DimensionSpec, last_key: int | None) -> int:
    """The largest key in use, looked up if the caller does not know it."""
    return max_key(existing, spec.key) if last_key is None else last_key


def _unseen(existing: DataFrame, rows: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    known = existing.select(*map(q, keys))
    return rows.alias("r").join(known.alias("k"), equal_on("r", "k", keys, null_safe), "left_anti")


def _append(
    existing: DataFrame, new: DataFrame, spec: DimensionSpec, batch_ts: datetime, offset: int
) -> DataFrame:
    keyed = dense_keys(new, spec.key, spec.natural_keys, offset)
    return existing.unionByName(_with_audit(keyed, spec, existing.schema, batch_ts))


def _with_audit(
    rows: DataFrame, spec: DimensionSpec, schema: T.StructType, batch_ts: datetime
) -> DataFrame:
    stamps = [c for c in spec.audit_columns if c.startswith("dw_")]
    rows = rows.withColumns({c: timestamp(batch_ts).cast(schema[c].dataType) for c in stamps})
    if spec.scd == 2:
        rows = open_versions(rows, schema, batch_ts)
    return rows.select(*map(q, spec.columns))
