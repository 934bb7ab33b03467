"""Small frames from rows the driver already has: run records, check declarations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def small_frame(spark: SparkSession, rows: Sequence[Mapping[str, Any]], schema: T.StructType) -> DataFrame:
    """A local relation, which unlike rows parallelized from Python starts no Python worker.

    Columns a row leaves out are null; a map is given as pairs.
    """
    return spark.createDataFrame(pa.Table.from_pylist(list(rows), schema=to_arrow_schema(schema)), schema)
