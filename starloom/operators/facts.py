"""Fact build, incremental append and rollup."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import all_of, col, equal_on, is_missing, q, timestamp
from starloom.operators.cleaning import remove_duplicates
from starloom.operators.keys import dense_keys
from starloom.operators.scd import current_records
from starloom.plans.specs import DimensionSpec, FactSpec, StarSpec
from starloom.sources.staging import stage


def lookup(dim: DataFrame, spec: DimensionSpec, version: str = "current") -> DataFrame:
    """Natural keys and surrogate key of a dimension; of type 2 the open versions.

    ``version='all'`` keeps every version, which multiplies the facts of a key that
    has a history.
    """
    if version not in ("current", "all"):
        raise ValueError(f"unknown version {version!r}")
    if spec.scd == 2 and version == "current":
        dim = current_records(dim)
    return dim.select(*[col(c).alias(f"__nk_{c}") for c in spec.natural_keys], col(spec.key))


def source_columns(star: StarSpec) -> list[str]:
    """The columns of the fact's source that the joins and the layout need."""
    fact = star.fact
    nk_columns = [fact.on.get(c, c) for d in fact.dimensions for c in star.dimension(d).natural_keys]
    return list(dict.fromkeys([*nk_columns, *fact.measures, *fact.flags.values()]))


def bind_fact(
    source: DataFrame,
    dims: Mapping[str, DataFrame],
    star: StarSpec,
    batch_ts: datetime,
    version: str = "current",
) -> DataFrame:
    """Facts with foreign keys, measures, flags and audit columns, but no key of their own.

    A row that misses a dimension is dropped, so the joins are inner joins.  Spark
    broadcasts the lookups that are small by their file size and shuffles the others.
    Keys of type 0 match null with null.
    """
    fact = star.fact
    # Only these columns travel with the rows.
    bound = source.select(*map(q, source_columns(star)))
    for name in fact.dimensions:
        spec = star.dimension(name)
        pairs = [(col(fact.on.get(c, c)), col(f"__nk_{c}")) for c in spec.natural_keys]
        same = all_of(a.eqNullSafe(b) if spec.scd == 0 else a == b for a, b in pairs)
        bound = bound.join(lookup(dims[name], spec, version), same, "inner").drop(
            *[f"__nk_{c}" for c in spec.natural_keys]
        )
    present = {flag: (~is_missing(source, c)).cast("bigint") for flag, c in fact.flags.items()}
    stamps = {c: timestamp(batch_ts) for c in ("dw_insert_date", "dw_update_date")}
    return bound.withColumns({**present, **stamps}).select(
        *[col(star.dimension(d).key) for d in fact.dimensions],
        *map(q, fact.measures),
        *map(q, fact.flags),
        *stamps,
    )


def number_facts(bound: DataFrame, fact: FactSpec, offset: int = 0) -> DataFrame:
    """Give bound facts unique result keys after ``offset`` (K2)."""
    order = [*fact.order_by, *[c for c in bound.columns if c not in fact.order_by]] if fact.order_by else ()
    return dense_keys(bound, fact.key, order, offset)


def build_fact(
    source: DataFrame,
    dims: Mapping[str, DataFrame],
    star: StarSpec,
    batch_ts: datetime,
    version: str = "current",
    offset: int = 0,
) -> DataFrame:
    """The whole fact of one source."""
    return number_facts(bind_fact(source, dims, star, batch_ts, version), star.fact, offset)


def unseen_facts(
    existing: DataFrame | Callable[[DataFrame], DataFrame], bound: DataFrame, grain: Sequence[str], dedup_batch: bool = False
) -> DataFrame:
    """Facts of the batch whose grain is not in the existing fact yet.

    The existing fact is first reduced to the grains the batch has.  It is the large
    side: with a small batch it is filtered in place by a broadcast semi join and never
    shuffled.  The grains are written in between, narrow and one row each: Spark then
    knows their size, and can split a grain with many copies on the other side.
    ``bound`` is read more than once and should be a table.  A missing part of a grain
    equals a missing part.  ``existing`` may be a function of the batch's grains that gives
    the facts among which they can be, so that the others are not read at all.
    """
    grain_columns = list(map(q, grain))
    if dedup_batch:
        bound = remove_duplicates(bound, grain)
    same = equal_on("old", "new", grain, null_safe=True)
    in_batch = stage(bound.select(*grain_columns).distinct())
    if not isinstance(existing, DataFrame):
        existing = existing(in_batch)
    kept = existing.select(*grain_columns).alias("old").join(in_batch.alias("new"), same, "left_semi")
    seen = stage(kept.distinct())
    return bound.alias("new").join(seen.alias("old"), same, "left_anti")


def append_stats(mode: str, new_rows: int, appended: int) -> dict[str, object]:
    """Counts of one load."""
    return {
        "mode": mode,
        "new_rows": new_rows,
        "appended_rows": appended,
        "duplicate_keys_skipped": 0 if mode == "full" else new_rows - appended,
    }


def star_rollup(
    fact: DataFrame,
    dims: Mapping[str, DataFrame],
    star: StarSpec,
    by: Mapping[str, Sequence[str]],
    averages: Sequence[str] = (),
    sums: Sequence[str] = (),
    digits: int | None = None,
    fold_first: Sequence[str] = (),
) -> DataFrame:
    """Averages and sums of measures by dimension attributes.

    ``by`` maps a dimension to the attributes to group by.  Dimensions Spark can
    broadcast are joined in place, and the facts are folded by attribute before any
    shuffle.  Name a dimension too large for that in ``fold_first``: the facts are then
    summed per key of it before they are shuffled to it, so a hot key arrives as few rows.
    """

    rows = _measured(fact, star, list(by), averages, sums)
    for name in by:
        if name not in fold_first:
            rows = _with_attributes(rows, dims, star, name, by[name])
    if fold_first:
        rows = _folded(rows)
        for name in fold_first:
            rows = _with_attributes(rows, dims, star, name, by[name])
    return _rolled_up(rows, by, averages, sums, digits)


def rollup_state(
    part: DataFrame, star: StarSpec, by: Sequence[str], averages: Sequence[str] = (), sums: Sequence[str] = ()
) -> DataFrame:
    """What a part of a fact adds to the rollups by attributes of the dimensions ``by``.

    Rows, sums and counts per combination of those dimensions' surrogate keys.  States of
    several parts add up, so an append needs its own part's state only; and as they hold
    keys, not attributes, a change of type 1 moves what it concerns when the state is read.
    """
    return _folded(_measured(part, star, by, averages, sums))


def rollup_from_states(
    states: DataFrame,
    dims: Mapping[str, DataFrame],
    star: StarSpec,
    by: Mapping[str, Sequence[str]],
    averages: Sequence[str] = (),
    sums: Sequence[str] = (),
    digits: int | None = None,
) -> DataFrame:
    """`star_rollup` from the united states of all parts, which must have been made for these dimensions and measures."""
    rows = _folded(states)
    for name in by:
        rows = _with_attributes(rows, dims, star, name, by[name])
    return _rolled_up(rows, by, averages, sums, digits)


def _measured(fact: DataFrame, star: StarSpec, by: Sequence[str], averages: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Surrogate keys of the dimensions, and what is summed."""
    value = {c: F.when(~is_missing(fact, c), col(c)) for c in dict.fromkeys([*averages, *sums])}
    return fact.select(
        *[q(star.dimension(d).key) for d in by],
        F.lit(1).cast("bigint").alias("__rows"),
        *[v.alias(f"__sum_{c}") for c, v in value.items()],
        *[value[c].isNotNull().cast("bigint").alias(f"__n_{c}") for c in averages],
    )


def _is_total(name: str) -> bool:
    return name == "__rows" or name.startswith(("__sum_", "__n_"))


def _folded(rows: DataFrame) -> DataFrame:
    totals = [c for c in rows.columns if _is_total(c)]
    return rows.groupBy(*[q(c) for c in rows.columns if c not in totals]).agg(*[F.sum(col(t)).alias(t) for t in totals])


def _with_attributes(rows: DataFrame, dims: Mapping[str, DataFrame], star: StarSpec, name: str, attributes: Sequence[str]) -> DataFrame:
    key = star.dimension(name).key
    return rows.join(dims[name].select(q(key), *map(q, attributes)), key, "inner").drop(key)


def _rolled_up(
    rows: DataFrame, by: Mapping[str, Sequence[str]], averages: Sequence[str], sums: Sequence[str], digits: int | None
) -> DataFrame:
    attributes = [a for names in by.values() for a in names]
    shorten = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    return rows.groupBy(*map(q, attributes)).agg(
        F.sum("__rows").alias("fact_rows"),
        *[shorten(F.try_divide(F.sum(col(f"__sum_{c}")), F.sum(col(f"__n_{c}")))).alias(f"avg_{c}") for c in averages],
        *[F.sum(col(f"__sum_{c}")).alias(f"sum_{c}") for c in sums],
    )
