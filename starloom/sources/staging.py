"""Written intermediate tables.

Some steps need a result that stays the same however often it is read: row
positions after a sort, batches that feed several joins, statistics that become
literals.  Those results are written as Parquet into the folder the cluster
shares (``spark.checkpoint.dir``) and read back, so a lost executor can neither
change nor lose them, and later reads are column pruned.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from starloom.sources.files import delete, delete_at_exit

_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a fresh one in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starloom-"))
    return spark.sparkContext.getCheckpointDir()


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and return a scan of what was written."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/starloom-stage-{uuid.uuid4().hex}"
    paths = _staged.get()
    if paths is not None:
        paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    delete_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[None]:
    """Delete what was staged inside the block when it ends; results must be written by then."""
    paths: list[str] = []
    token = _staged.set(paths)
    try:
        yield
    finally:
        _staged.reset(token)
        for path in paths:
            delete(spark, path)
