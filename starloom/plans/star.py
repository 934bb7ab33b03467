"""Star-schema builds: full and incremental."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.cleaning import remove_duplicates
from starloom.functions.columns import batch_id, q
from starloom.operators import check_states
from starloom.operators.check_states import TableState
from starloom.operators.dimensions import build_dimension, dimension_delta, foldable, folded_rows, merge_dimension, rows_from_fold
from starloom.operators.keys import max_key
from starloom.operators.facts import append_stats, bind_fact, build_fact, number_facts, unseen_facts
from starloom.operators.quality import Check, meets_gate, run_suite
from starloom.operators.concurrent import side_by_side
from starloom.plans.specs import DimensionSpec, StarSpec
from starloom.sources.staging import stage, temporary_stages
from starloom.sources.warehouse import (
    Snapshot, chain_of, last_promoted, link, next_slot, promote, read_chain, read_dimension, read_fact, read_fact_near, read_states,
    write_grain_index, write_state, write_table,
)


#: Largest key from which a dimension is kept as a base and deltas, and links after which it is written whole.
DELTA_KEYS, LONGEST_CHAIN = 1_000_000, 16


class QualityGateError(RuntimeError):
    """A batch failed its checks and was not promoted."""


@dataclass(frozen=True)
class Loaded:
    """Dimensions after the load, the batch's new facts, all facts, counts, number of the manifest entry."""

    dims: dict[str, DataFrame]
    new_facts: DataFrame
    fact: DataFrame
    stats: dict[str, object]
    slot: int


def build_dimensions(
    sources: Mapping[str, DataFrame], star: StarSpec, batch_ts: datetime
) -> dict[str, DataFrame]:
    """All dimensions from scratch, keyed and staged side by side; a source of several is read once."""
    spark = sources[star.fact.source].sparkSession
    rows = rows_of_dimensions(sources, star)
    steps = {d.name: partial(build_dimension, sources[d.source], d, batch_ts, rows.get(d.name)) for d in star.dimensions}
    return side_by_side(spark, steps)


def rows_of_dimensions(sources: Mapping[str, DataFrame], star: StarSpec) -> dict[str, DataFrame]:
    """The rows of the dimensions that share a source, folded in one pass over it and written."""
    groups: dict[str, list[DimensionSpec]] = {}
    for spec in star.dimensions:
        if foldable(sources[spec.source], spec):
            groups.setdefault(spec.source, []).append(spec)
    shared = {name: specs for name, specs in groups.items() if len(specs) > 1}
    spark = sources[star.fact.source].sparkSession
    steps = {name: partial(stage, folded_rows(sources[name], specs)) for name, specs in shared.items()}
    folded = side_by_side(spark, steps) if steps else {}
    return {d: rows for name, specs in shared.items() for d, rows in rows_from_fold(folded[name], specs).items()}


def build_star(
    sources: Mapping[str, DataFrame], star: StarSpec, batch_ts: datetime, version: str = "current"
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Dimensions and fact from scratch, nothing saved."""
    dims = build_dimensions(sources, star, batch_ts)
    return dims, build_fact(sources[star.fact.source], dims, star, batch_ts, version)


def create_star(
    sources: Mapping[str, DataFrame], star: StarSpec, root: str, batch_ts: datetime
) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """Full build saved as one promoted batch; also returns the rows per table."""
    loaded = load_star(sources, star, root, batch_ts, rebuild=True)
    tables = {**loaded.dims, star.fact.name: loaded.fact}
    summary = reduce(
        DataFrame.unionByName,
        [t.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table"), "row_count") for n, t in tables.items()],
    )
    return loaded.dims, loaded.fact, summary


def load_star(
    sources: Mapping[str, DataFrame],
    star: StarSpec,
    root: str,
    batch_ts: datetime,
    *,
    version: str = "current",
    dedup_batch: bool = False,
    checks: Sequence[Check] = (),
    min_pass_rate: float = 0.95,
    check_new_facts_only: bool = True,
    rebuild: bool = False,
    fmt: str = "parquet",
    deltas: bool | None = None,
    keep_states: bool = False,
) -> Loaded:
    """Merge the dimensions, append the facts whose grain is new, check, promote.

    Everything is written to folders of this attempt first; what is promoted is not touched
    before the checks have passed, nor by a replay of the batch.  ``check_new_facts_only``
    spares the checks the facts that passed them when they were loaded; keys cannot collide,
    as new ones start above the manifest's last one.  ``rebuild`` ignores what is there:
    dimensions and facts of this batch take the place of all earlier ones.  ``fmt`` is the
    format of this batch's tables.  With ``deltas`` a batch writes of each dimension only the
    rows it adds or changes, and a reader takes the newest row of each key; without, it writes
    the dimension whole.  Left open, dimensions of ``DELTA_KEYS`` keys and more get deltas.  A chain of
    ``LONGEST_CHAIN`` is written whole again.  ``keep_states`` writes the state of the new facts
    for these checks; with states of all parts the checks answer for the whole fact without
    reading the earlier facts, whatever ``check_new_facts_only`` says.
    """
    spark = sources[star.fact.source].sparkSession
    with temporary_stages(spark):
        return _load(
            spark, sources, star, root, batch_ts, version, dedup_batch, checks, min_pass_rate,
            check_new_facts_only, rebuild, fmt, deltas, keep_states,
        )


def _load(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    star: StarSpec,
    root: str,
    batch_ts: datetime,
    version: str,
    dedup_batch: bool,
    checks: Sequence[Check],
    min_pass_rate: float,
    check_new_facts_only: bool,
    rebuild: bool,
    fmt: str,
    deltas: bool | None,
    keep_states: bool,
) -> Loaded:
    slot, attempt = next_slot(spark, root), uuid.uuid4().hex
    previous = last_promoted(spark, root, batch_ts)
    if rebuild:
        previous = None
    existing_fact = read_fact(spark, root, star.fact.name, previous)

    own = link(batch_id(batch_ts), attempt, fmt)
    folded = rows_of_dimensions(sources, star)

    def merge(spec: DimensionSpec) -> tuple[DataFrame, tuple[str, ...], int]:
        """The dimension after this batch, its chain, and its largest key."""
        known = read_dimension(spark, root, spec.name, previous)
        last = None if previous is None else previous.last_keys.get(spec.name)
        links = () if previous is None else chain_of(previous, spec.name)
        if known is None or last is None or len(links) >= LONGEST_CHAIN or not (last >= DELTA_KEYS if deltas is None else deltas):
            merged = merge_dimension(known, sources[spec.source], spec, batch_ts, rows=folded.get(spec.name), last_key=last)
            written = write_table(merged, root, spec.name, batch_ts, attempt, fmt)
            return written, (own,), max_key(written, spec.key)
        delta = dimension_delta(known, sources[spec.source], spec, batch_ts, last, rows=folded.get(spec.name))
        added = write_table(delta, root, spec.name, batch_ts, attempt, fmt)
        links = (*links, own)
        return read_chain(spark, root, spec.name, links, known.schema), links, max(last, max_key(added, spec.key))

    merged = side_by_side(spark, {d.name: partial(merge, d) for d in star.dimensions})
    dims = {name: table for name, (table, _, _) in merged.items()}
    chains, last_keys = ({name: found[i] for name, found in merged.items()} for i in (1, 2))

    bound = bind_fact(sources[star.fact.source], dims, star, batch_ts, version)
    if existing_fact is None:
        mode, offset = "full", 0
        fresh = remove_duplicates(bound, star.fact.grain) if dedup_batch else bound
    else:
        mode, offset = "incremental", previous.last_key
        bound = stage(bound)
        near = partial(read_fact_near, spark, root, star.fact.name, previous, grain=star.fact.grain)
        fresh = unseen_facts(near, bound, star.fact.grain, dedup_batch)
    written = write_table(number_facts(fresh, star.fact, offset), root, star.fact.name, batch_ts, attempt, fmt)
    # The next batches look up their grains here instead of reading these facts.
    write_grain_index(written, root, star.fact.name, batch_ts, attempt, star.fact.grain)
    # Row counts of Parquet tables come from the file footers.
    appended = written.count()
    new_rows = bound.count() if mode == "incremental" else appended
    stats = append_stats(mode, new_rows, 0 if mode == "full" else appended)
    fact = written if existing_fact is None else existing_fact.unionByName(written)

    states, watching = {}, None
    if keep_states:
        foreign, unique = check_states.watched(checks, star.fact.name)
        state = _state_of(spark, written, star, root, previous, batch_ts, foreign, unique)
        state = write_state(state, root, star.fact.name, batch_ts, attempt)
        watching = {"foreign": foreign, "unique": list(map(check_states.key_name, unique))}
        before = read_states(spark, root, star.fact.name, previous)
        # Earlier states that watched other keys are of no use for these checks.
        same = before is not None and all(dict(w) == watching for w in previous.watched.values())
        if previous is None or same:
            every = state if previous is None else {kind: before[kind].unionByName(state[kind]) for kind in state}
            states[star.fact.name] = TableState.of(every, foreign, unique)
    whole = bool(states) or not check_new_facts_only
    checked = {**dims, star.fact.name: fact if whole else written}
    if checks and not meets_gate(run_suite(checked, checks, states), min_pass_rate):
        raise QualityGateError(f"batch of {batch_ts} is below a pass rate of {min_pass_rate}")
    schemas = {name: table.schema for name, table in {**dims, star.fact.name: written}.items()}
    promote(spark, root, slot, batch_ts, attempt, schemas, stats, offset + appended, fmt, star.fact.grain, chains, last_keys, watching)
    return Loaded(dims, written, fact, stats, slot)


def _state_of(
    spark: SparkSession,
    written: DataFrame,
    star: StarSpec,
    root: str,
    previous: Snapshot | None,
    batch_ts: datetime,
    foreign: Sequence[str],
    unique: Sequence[Sequence[str]],
) -> dict[str, DataFrame]:
    """The state of the new facts; earlier facts are read only where they may hold one of their keys."""
    part, fact = batch_id(batch_ts), star.fact

    def earlier(keys: Sequence[str]) -> DataFrame:
        if previous is None:
            return written.limit(0)
        if tuple(keys) == tuple(fact.grain):
            return read_fact_near(spark, root, fact.name, previous, written.select(*map(q, keys)), keys)
        if tuple(keys) == (fact.key,) and (written.agg(F.min(q(fact.key))).first()[0] or previous.last_key + 1) > previous.last_key:
            return written.limit(0)
        return read_fact(spark, root, fact.name, previous)

    copies = [check_states.doubled(written, earlier(keys), part, keys) for keys in unique]
    return {
        "counts": check_states.counts(written, part),
        "used": check_states.used(written, part, foreign) if foreign else spark.createDataFrame([], check_states.SCHEMAS["used"]),
        "doubled": reduce(DataFrame.unionByName, copies) if copies else spark.createDataFrame([], check_states.SCHEMAS["doubled"]),
    }


def check_star(spark: SparkSession, star: StarSpec, root: str, checks: Sequence[Check]) -> DataFrame:
    """The suite over all promoted tables; the fact's states answer for it where all its parts have one (Q9)."""
    at = last_promoted(spark, root)
    tables, found = read_star(spark, star, root), read_states(spark, root, star.fact.name, at)
    foreign, unique = check_states.watched(checks, star.fact.name)
    states = {}
    if found is not None:
        known = list(at.watched.values())
        foreign = [c for c in foreign if all(c in w["foreign"] for w in known)]
        unique = [keys for keys in unique if all(check_states.key_name(keys) in w["unique"] for w in known)]
        states[star.fact.name] = TableState.of(found, foreign, unique)
    return run_suite(tables, checks, states)


def read_star(spark: SparkSession, star: StarSpec, root: str) -> dict[str, DataFrame]:
    """All promoted tables of a star."""
    batch = last_promoted(spark, root)
    if batch is None:
        raise ValueError(f"nothing promoted yet in {root}")
    tables = {d.name: read_dimension(spark, root, d.name, batch) for d in star.dimensions}
    return {**tables, star.fact.name: read_fact(spark, root, star.fact.name, batch)}
