"""Run log and fact checkpoints kept as append-only tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.columns import batch_id
from starloom.functions.typenames import struct
from starloom.sources.files import create_new, delete, exists, names, read_text
from starloom.sources.rows import small_frame

TRANSFORMATION = struct(
    name="string", timestamp="timestamp", details=T.MapType(T.StringType(), T.StringType())
)

RUN_SCHEMA = struct(
    run_id="string",
    layer="string",
    table_name="string",
    source="string",
    start_time="timestamp",
    status="string",
    row_count_in="bigint",
    row_count_out="bigint",
    transformations=T.ArrayType(TRANSFORMATION),
    end_time="timestamp",
    errors=T.ArrayType(T.StringType()),
)

CHECKPOINT_SCHEMA = struct(
    fact_table_size="bigint", new_rows_processed="bigint", checkpoint_timestamp="timestamp", position="bigint"
)
#: Folders of the folded log and of the entries that switch to them; record files after which a run that ends folds the log.
FOLDED, FOLDS, LONGEST_TAIL = "_folded", "_folds", 200
STATES = ("running", "success", "partial", "failed")


@dataclass
class Run:
    """What a layer run reports while it is going on."""

    layer: str
    table_name: str
    source: str | None
    clock: Callable[[], datetime]
    row_count_in: int | None = None
    row_count_out: int | None = None
    transformations: list[dict[str, Any]] = field(default_factory=list)
    errors: list[str] = field(default_factory=list)
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)

    def error(self, message: str) -> None:
        """Note an error the run goes on after; it will end as ``partial``."""
        self.errors.append(message)

    def transformation(self, name: str, details: Mapping[str, Any] | None = None) -> None:
        pairs = [(k, str(v)) for k, v in (details or {}).items()]
        self.transformations.append({"name": name, "timestamp": self.clock(), "details": pairs})


def append_run(
    spark: SparkSession,
    path: str,
    run: Run,
    start_time: datetime,
    end_time: datetime | None,
    status: str,
    errors: Sequence[str] = (),
) -> None:
    """Add a record of a run's state; ``end_time`` stays empty until the run has ended (L1)."""
    if status not in STATES:
        raise ValueError(f"unknown status {status!r}, expected one of {STATES}")
    record = {
        "run_id": run.run_id,
        "layer": run.layer,
        "table_name": run.table_name,
        "source": run.source,
        "start_time": start_time,
        "status": status,
        "row_count_in": run.row_count_in,
        "row_count_out": run.row_count_out,
        "transformations": run.transformations,
        "end_time": end_time,
        "errors": list(errors),
    }
    small_frame(spark, [record], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    if status != "running":
        compact_runs(spark, path, LONGEST_TAIL)


@contextmanager
def logged_run(
    spark: SparkSession,
    path: str,
    layer: str,
    table_name: str,
    source: str | None = None,
    clock: Callable[[], datetime] = datetime.now,
) -> Iterator[Run]:
    """Log a layer run around a block: as running when it starts, and how it ended.

    A failure is logged and raised again; a run whose driver dies stays ``running``.
    """
    run = Run(layer, table_name, source, clock)
    start = clock()
    append_run(spark, path, run, start, None, "running")
    try:
        yield run
    except Exception as error:
        append_run(spark, path, run, start, clock(), "failed", [*run.errors, str(error)])
        raise
    append_run(spark, path, run, start, clock(), "partial" if run.errors else "success", run.errors)


def _read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not exists(spark, path):
        return small_frame(spark, [], schema)
    return spark.read.schema(schema).parquet(path)


def _records(spark: SparkSession, path: str) -> tuple[int, list[str], list[str]]:
    """Number of the newest fold, the record files it covers, and the paths that hold all records."""
    folds = names(spark, f"{path}/{FOLDS}")
    number, fold = (int(folds[-1].split(".")[0]), json.loads(read_text(spark, f"{path}/{FOLDS}/{folds[-1]}"))) if folds else (0, None)
    covered = fold["covers"] if fold else []
    files = [n for n in names(spark, path) if n.endswith(".parquet") and n not in set(covered)]
    return number, covered, [f"{path}/{n}" for n in files] + ([f"{path}/{FOLDED}/{fold['folder']}"] if fold else [])


def _read_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(*paths) if paths else small_frame(spark, [], RUN_SCHEMA)


def compact_runs(spark: SparkSession, path: str, at_least: int = 1) -> bool:
    """Fold the records of the log, one row per run, into one file under a new name.

    An entry that lists the record files it covers switches readers to the fold, so a
    compaction that dies, or that another one was faster than, changes nothing.  Files that
    the fold before it covered are deleted; a reader that began before the switch still has
    those it listed.  A record that is read twice does no harm: of a run the last counts.
    Returns whether the log was folded; it is not with fewer than ``at_least`` record files.
    """
    number, covered, paths = _records(spark, path)
    files = [p.rsplit("/", 1)[1] for p in paths if p.endswith(".parquet")]
    if len(files) < at_least:
        return False
    folder = f"{number + 1:09d}-{uuid.uuid4().hex}"
    last_states(_read_records(spark, paths)).coalesce(1).write.parquet(f"{path}/{FOLDED}/{folder}")
    if not create_new(spark, f"{path}/{FOLDS}/{number + 1:09d}.json", json.dumps({"folder": folder, "covers": files})):
        delete(spark, f"{path}/{FOLDED}/{folder}")
        return False
    for name in covered:
        delete(spark, f"{path}/{name}")
    # The newest fold and the one before it stay.
    for kind in (FOLDED, FOLDS):
        for name in names(spark, f"{path}/{kind}"):
            if int(name[:9]) < number:
                delete(spark, f"{path}/{kind}/{name}")
    return True


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """One row per run, in its last state."""
    return last_states(_read_records(spark, _records(spark, path)[2]))


def last_states(records: DataFrame) -> DataFrame:
    """Of the records of each run the last."""
    ended = F.struct((F.col("status") != "running").alias("ended"), "end_time")
    return records.groupBy("run_id").agg(F.max_by(F.struct(*RUN_SCHEMA.names), ended).alias("r")).select("r.*")


def run_history(runs: DataFrame, layer: str | None = None, table_name: str | None = None) -> DataFrame:
    """Runs of a layer and/or table (L2)."""
    if layer is not None:
        runs = runs.filter(F.col("layer") == layer)
    if table_name is not None:
        runs = runs.filter(F.col("table_name") == table_name)
    return runs


def run_report(runs: DataFrame) -> DataFrame:
    """Flat report with transformations and errors as counts (L3)."""
    return runs.select(
        "layer",
        F.col("table_name").alias("table"),
        "source",
        "status",
        "start_time",
        "end_time",
        F.col("row_count_in").alias("rows_in"),
        F.col("row_count_out").alias("rows_out"),
        *[
            F.coalesce(F.size(F.col(c)), F.lit(0)).cast("bigint").alias(c)
            for c in ("transformations", "errors")
        ],
    )


def write_run_report(runs: DataFrame, path: str) -> None:
    """The report as CSV, in order of the start over its files."""
    run_report(runs).orderBy("start_time").write.mode("overwrite").option("header", True).csv(path)


def store_checkpoint(
    spark: SparkSession,
    path: str,
    fact_table_size: int,
    new_rows_processed: int,
    timestamp: datetime,
    position: int | None = None,
    batch: str | None = None,
) -> None:
    """Remember the size of the fact after a load (L4).

    ``position`` is the place in the order of loads, the number of the manifest entry;
    without it loads are in order of their time.  A replay of a batch takes the place of
    what was stored for it.
    """
    if position is None:
        position = int((timestamp - datetime(1970, 1, 1)).total_seconds() * 1_000_000)
    batch = batch_id(timestamp) if batch is None else batch
    values = (fact_table_size, new_rows_processed, timestamp, position)
    row = dict(zip(CHECKPOINT_SCHEMA.names, values, strict=True))
    small_frame(spark, [row], CHECKPOINT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_checkpoints(spark: SparkSession, path: str) -> DataFrame:
    return _read_or_empty(spark, path, CHECKPOINT_SCHEMA).select(*CHECKPOINT_SCHEMA.names)


def latest_checkpoint(checkpoints: DataFrame) -> DataFrame:
    """The last checkpoint stored, or no row."""
    newest = F.max_by(F.struct(*CHECKPOINT_SCHEMA.names), "position")
    return checkpoints.agg(newest.alias("c")).filter("c IS NOT NULL").select("c.*")
