"""Dimensional tables as batch snapshots with one manifest.

Every attempt at a batch writes its dimensions whole and its new facts to a folder of its
own, and nothing that was written is ever written again.  A batch becomes visible, all
tables at once, when one manifest entry names its attempt; so an attempt that failed its
checks, or whose driver died, changes nothing, replays included.  Entries are numbered, and
an entry can be made only once: a load that began before another one was promoted cannot
take the other's place.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import partial
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.columns import batch_id, col
from starloom.functions.typenames import struct
from starloom.operators import check_states, grain_index
from starloom.operators.concurrent import side_by_side
from starloom.operators.dimensions import newest_rows
from starloom.sources.files import create_new, delete, names
from starloom.sources.layers import ATTEMPT, BATCH, decoded, partition_path, reader, writer
from starloom.sources.rows import small_frame

MANIFEST = "manifest"
INDEX_KINDS = ("ranges", "filters")
MANIFEST_SCHEMA = struct(
    **{BATCH: "string"},
    mode="string",
    new_rows="bigint",
    appended_rows="bigint",
    duplicate_keys_skipped="bigint",
    last_key="bigint",
    promoted_at="timestamp",
)
_ENTRY_SCHEMA = T.StructType(
    [
        T.StructField("slot", T.LongType()),
        T.StructField(ATTEMPT, T.StringType()),
        T.StructField("fmt", T.StringType()),
        T.StructField("schemas", T.MapType(T.StringType(), T.StringType())),
        T.StructField("indexed", T.ArrayType(T.StringType())),
        T.StructField("chains", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
        T.StructField("last_keys", T.MapType(T.StringType(), T.LongType())),
        T.StructField("watched", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
        *MANIFEST_SCHEMA.fields,
    ]
)


class MovedBaseError(RuntimeError):
    """Another batch was promoted while this one was being loaded."""


@dataclass(frozen=True)
class Snapshot:
    """What a promoted batch consists of: (batch, attempt, format, schema by table) per fact part, its own last.

    ``indexed`` has the grain columns of the parts that have an index, by batch.  ``chains``
    has for each dimension the links it is made of, its base first and then the rows that
    later batches added or changed; ``last_keys`` the largest key in use; ``watched`` by batch
    the foreign and unique keys that its state knows, for parts that have one.
    """

    batch: str
    last_key: int
    parts: tuple[tuple[str, str, str, Mapping[str, str]], ...]
    indexed: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    chains: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    last_keys: Mapping[str, int] = field(default_factory=dict)
    watched: Mapping[str, Mapping[str, Sequence[str]]] = field(default_factory=dict)


def _entries(spark: SparkSession, root: str) -> DataFrame:
    if not names(spark, f"{root}/{MANIFEST}"):
        return small_frame(spark, [], _ENTRY_SCHEMA)
    return spark.read.schema(_ENTRY_SCHEMA).json(f"{root}/{MANIFEST}")


def _effective(spark: SparkSession, root: str) -> DataFrame:
    """The last entry of each batch: a replay's entry takes the place of the earlier one."""
    every = F.struct(*_ENTRY_SCHEMA.names)
    return _entries(spark, root).groupBy(BATCH).agg(F.max_by(every, "slot").alias("e")).select("e.*")


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """Promoted batches; no rows for a new warehouse."""
    return _effective(spark, root).select(*MANIFEST_SCHEMA.names)


def next_slot(spark: SparkSession, root: str) -> int:
    """Number of the manifest entry that a load starting now may make."""
    return max((int(n.split(".")[0]) for n in names(spark, f"{root}/{MANIFEST}")), default=0) + 1


def last_promoted(spark: SparkSession, root: str, batch_ts: datetime | None = None) -> Snapshot | None:
    """Newest promoted batch; with ``batch_ts`` the newest before it.

    A batch older than the newest cannot be replayed: later ones were built on it.  The
    driver reads the manifest, one row per batch.
    """
    entries = sorted(_effective(spark, root).collect(), key=lambda r: r[BATCH])
    if batch_ts is not None:
        batch = batch_id(batch_ts)
        if entries and entries[-1][BATCH] > batch:
            raise ValueError(f"batch {entries[-1][BATCH]}, later than {batch}, is already promoted")
        entries = [r for r in entries if r[BATCH] < batch]
    if not entries:
        return None
    first = max(i for i, r in enumerate(entries) if r["mode"] == "full")
    parts = tuple((r[BATCH], r[ATTEMPT], r["fmt"], r["schemas"]) for r in entries[first:])
    indexed = {r[BATCH]: tuple(r["indexed"]) for r in entries[first:] if r["indexed"]}
    newest = entries[-1]
    chains = {name: tuple(links) for name, links in (newest["chains"] or {}).items()}
    watched = {r[BATCH]: r["watched"] for r in entries[first:] if r["watched"]}
    return Snapshot(newest[BATCH], newest["last_key"], parts, indexed, chains, newest["last_keys"] or {}, watched)


def _path(root: str, name: str, batch: str, attempt: str) -> str:
    return f"{partition_path(root, name, batch)}/{ATTEMPT}={attempt}"


def link(batch: str, attempt: str, fmt: str) -> str:
    """Name of one table in a dimension's chain."""
    return "/".join((batch, attempt, fmt))


def chain_of(at: Snapshot, name: str) -> tuple[str, ...]:
    """The links of a dimension; one that the manifest has no chain for was written whole."""
    batch, attempt, fmt, _ = at.parts[-1]
    return at.chains.get(name) or (link(batch, attempt, fmt),)


def read_chain(spark: SparkSession, root: str, name: str, links: Sequence[str], schema: T.StructType) -> DataFrame:
    """A dimension from its links; its first column is its surrogate key."""
    tables = []
    for batch, attempt, fmt in (x.split("/") for x in links):
        tables.append(decoded(reader(spark, fmt).schema(schema).load(_path(root, name, batch, attempt)), fmt))
    return newest_rows(tables[0], tables[1:], schema.names[0])


def read_dimension(spark: SparkSession, root: str, name: str, at: Snapshot | None) -> DataFrame | None:
    """The dimension as of a promoted batch, None if there is no such batch (A5)."""
    if at is None:
        return None
    schema = T.StructType.fromJson(json.loads(at.parts[-1][3][name]))
    return read_chain(spark, root, name, chain_of(at, name), schema)


def read_fact(spark: SparkSession, root: str, name: str, at: Snapshot | None) -> DataFrame | None:
    """Facts of the promoted batches up to a batch, from the last full load on.

    Only the folders that the manifest names are opened.
    """
    if at is None:
        return None
    schema = T.StructType.fromJson(json.loads(at.parts[-1][3][name]))
    found = None
    for fmt in sorted({p[2] for p in at.parts}):
        paths = [_path(root, name, batch, attempt) for batch, attempt, f, _ in at.parts if f == fmt]
        part = decoded(reader(spark, fmt).schema(schema).load(paths), fmt)
        found = part if found is None else found.unionByName(part)
    return found


def _index_path(root: str, name: str, kind: str, batch: str, attempt: str) -> str:
    # Readers of the part pass over folders with such a name, and the folder goes when the part goes.
    return f"{_path(root, name, batch, attempt)}/_{kind}"


def write_grain_index(part: DataFrame, root: str, name: str, batch_ts: datetime, attempt: str, grain: Sequence[str]) -> None:
    """Write the grain index of a fact part that this attempt has written."""
    spark, batch = part.sparkSession, batch_id(batch_ts)
    # Counted from the file footers where the format has them.
    words = grain_index.filter_words(part.count(), len(part.inputFiles()))
    tables = {
        "ranges": grain_index.file_ranges(part, grain, batch, words),
        "filters": grain_index.file_filters(part, grain, batch, words),
    }
    side_by_side(spark, {
        kind: partial(table.write.mode("errorifexists").parquet, _index_path(root, name, kind, batch, attempt)) for kind, table in tables.items()
    })


def read_fact_near(spark: SparkSession, root: str, name: str, at: Snapshot, in_batch: DataFrame, grain: Sequence[str]) -> DataFrame:
    """The promoted facts in files that may have one of the grains ``in_batch``; of parts without an index all files.

    The driver gets the names of those files.
    """
    schema = T.StructType.fromJson(json.loads(at.parts[-1][3][name]))
    wanted = in_batch.select(*[col(c).cast(schema[c].dataType).alias(c) for c in grain])
    attempts = {batch: attempt for batch, attempt, _, _ in at.parts}
    known = [batch for batch in attempts if at.indexed.get(batch) == tuple(grain)]
    files: dict[str, list[str]] = {}
    if known:
        paths = {kind: [_index_path(root, name, kind, batch, attempts[batch]) for batch in known] for kind in INDEX_KINDS}
        ranges = spark.read.schema(grain_index.range_schema(schema, grain)).parquet(*paths["ranges"])
        filters = spark.read.schema(grain_index.FILTER_SCHEMA).parquet(*paths["filters"])
        for r in grain_index.files_that_may_hold(ranges, filters, wanted, grain).collect():
            files.setdefault(r[grain_index.PART], []).append(r[grain_index.FILE])
    found = spark.createDataFrame([], schema)
    for fmt in sorted({p[2] for p in at.parts}):
        paths = []
        for batch, attempt, f, _ in at.parts:
            folder = _path(root, name, batch, attempt)
            if f == fmt:
                paths += [f"{folder}/{file}" for file in sorted(files.get(batch, ()))] if batch in known else [folder]
        if paths:
            found = found.unionByName(decoded(reader(spark, fmt).schema(schema).load(paths), fmt))
    return found


def write_state(tables: Mapping[str, DataFrame], root: str, name: str, batch_ts: datetime, attempt: str) -> dict[str, DataFrame]:
    """Write the state of a fact part and return it."""
    spark = next(iter(tables.values())).sparkSession
    paths = {kind: _index_path(root, name, kind, batch_id(batch_ts), attempt) for kind in tables}
    side_by_side(spark, {kind: partial(table.write.mode("errorifexists").parquet, paths[kind]) for kind, table in tables.items()})
    return {kind: spark.read.schema(check_states.SCHEMAS[kind]).parquet(path) for kind, path in paths.items()}


def read_states(spark: SparkSession, root: str, name: str, at: Snapshot | None) -> dict[str, DataFrame] | None:
    """The states of all fact parts, None if some part has none."""
    if at is None or any(batch not in at.watched for batch, _, _, _ in at.parts):
        return None
    paths = {kind: [_index_path(root, name, kind, batch, attempt) for batch, attempt, _, _ in at.parts] for kind in check_states.SCHEMAS}
    return {kind: spark.read.schema(schema).parquet(*paths[kind]) for kind, schema in check_states.SCHEMAS.items()}


def write_table(
    df: DataFrame, root: str, name: str, batch_ts: datetime, attempt: str, fmt: str = "parquet"
) -> DataFrame:
    """Write a table of this attempt, not yet promoted, and return it."""
    path = _path(root, name, batch_id(batch_ts), attempt)
    writer(df, fmt).mode("errorifexists").save(path)
    return decoded(reader(df.sparkSession, fmt).schema(df.schema).load(path), fmt)


def promote(
    spark: SparkSession,
    root: str,
    slot: int,
    batch_ts: datetime,
    attempt: str,
    schemas: Mapping[str, T.StructType],
    stats: Mapping[str, Any],
    last_key: int,
    fmt: str = "parquet",
    indexed: Sequence[str] = (),
    chains: Mapping[str, Sequence[str]] | None = None,
    last_keys: Mapping[str, int] | None = None,
    watched: Mapping[str, Sequence[str]] | None = None,
) -> None:
    """Make the attempt visible with its manifest entry (A13), unless another load made that entry."""
    entry = {
        "slot": slot,
        BATCH: batch_id(batch_ts),
        ATTEMPT: attempt,
        "fmt": fmt,
        "schemas": {name: json.dumps(schema.jsonValue()) for name, schema in schemas.items()},
        "indexed": list(indexed),
        "chains": {name: list(links) for name, links in (chains or {}).items()},
        "last_keys": dict(last_keys or {}),
        "watched": watched,
        **stats,
        "last_key": last_key,
        "promoted_at": batch_ts.strftime("%Y-%m-%dT%H:%M:%S.%f"),
    }
    _make_entry(spark, root, slot, entry)


def compact_dimensions(spark: SparkSession, root: str, dimensions: Sequence[str]) -> list[str]:
    """Write the dimensions that have become long chains whole again; returns those that were.

    What is read does not change.  The newest batch gets a new manifest entry with the
    same facts; a load that was promoted meanwhile makes this raise `MovedBaseError`.
    """
    slot, attempt = next_slot(spark, root), uuid.uuid4().hex
    at = last_promoted(spark, root)
    long = [] if at is None else [name for name in dimensions if len(chain_of(at, name)) > 1]
    if not long:
        return []
    batch, fact_attempt, fmt, schemas = at.parts[-1]
    chains = {name: list(chain_of(at, name)) for name in dimensions}
    for name in long:
        writer(read_dimension(spark, root, name, at), fmt).mode("errorifexists").save(_path(root, name, batch, attempt))
        chains[name] = [link(batch, attempt, fmt)]
    entry = _effective(spark, root).filter(F.col(BATCH) == batch).first().asDict(recursive=True)
    entry |= {"slot": slot, "chains": {**at.chains, **chains}, "promoted_at": entry["promoted_at"].strftime("%Y-%m-%dT%H:%M:%S.%f")}
    _make_entry(spark, root, slot, entry)
    return long


def _make_entry(spark: SparkSession, root: str, slot: int, entry: Mapping[str, Any]) -> None:
    if not create_new(spark, f"{root}/{MANIFEST}/{slot:012d}.json", json.dumps(entry)):
        raise MovedBaseError(f"another load was promoted in {root} while this one ran; load the batch again")


def remove_superseded(spark: SparkSession, root: str, tables: Mapping[str, bool]) -> list[str]:
    """Delete what the newest batch does not need and return the folders deleted.

    ``tables`` says for each table whether it is a fact: of a fact all listed parts stay, of
    a dimension the links of its newest chain.  Not to be called while a load or an older read runs.
    """
    at = last_promoted(spark, root)
    gone = []
    for name, is_fact in tables.items():
        if at is None:
            needed = set()
        elif is_fact:
            needed = {(p[0], p[1]) for p in at.parts}
        else:
            needed = {tuple(x.split("/")[:2]) for x in chain_of(at, name)}
        for batch in [n.split("=", 1)[1] for n in names(spark, f"{root}/{name}") if n.startswith(f"{BATCH}=")]:
            for attempt in [n.split("=", 1)[1] for n in names(spark, partition_path(root, name, batch)) if n.startswith(f"{ATTEMPT}=")]:
                if (batch, attempt) not in needed:
                    gone.append(_path(root, name, batch, attempt))
    for path in gone:
        delete(spark, path)
    return gone
