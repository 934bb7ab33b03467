"""Tables stored in buckets of a key, so that joins and folds by that key need no shuffle.

Rows are placed by the hash of the key when they are written.  Two tables with the same
number of buckets of their join keys are joined bucket by bucket, however large they are.

A bucket is read by one task, and adaptive execution cannot split it.  So the rows of each
bucket are counted when it is written; a table whose largest bucket is far above the mean (a hot
key) is opened as plain files, and its joins shuffle and split as those of any other table.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.columns import col
from starloom.sources.files import create_new, exists, read_text

_SPEC = "_buckets.json"

#: A largest bucket of more times the mean than this is too uneven for one task each.
MOST_SKEW = 4.0


def _table_name(path: str) -> str:
    return f"starloom_buckets_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` to a new folder in buckets of ``key`` and open it with `read_bucketed`.

    Each task writes its rows to a file per bucket: nothing is shuffled, so a hot key makes no
    hot task.  Rows without a key are kept, in one bucket.  A folder that exists raises.
    """
    spark = df.sparkSession
    if buckets < 1:
        raise ValueError("a table has at least one bucket")
    if key not in df.columns:
        raise ValueError(f"no column {key!r} to bucket by")
    if exists(spark, path):
        raise ValueError(f"{path} exists")
    name = _table_name(path)
    # A table of the same folder that was deleted since.
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("compression", "zstd").option("path", path).saveAsTable(name)
    place = F.pmod(F.hash(col(key)), F.lit(buckets))
    largest, rows = spark.read.schema(df.schema).parquet(path).groupBy(place).count().agg(F.max("count"), F.sum("count")).first()
    spec = {"key": key, "buckets": buckets, "rows": rows or 0, "largest": largest or 0, "schema": df.schema.jsonValue()}
    create_new(spark, f"{path}/{_SPEC}", json.dumps(spec))
    return read_bucketed(spark, path)


def bucket_spec(spark: SparkSession, path: str) -> dict[str, object]:
    """Key, buckets, rows, rows of the largest bucket and schema of a written table."""
    return json.loads(read_text(spark, f"{path}/{_SPEC}"))


def read_bucketed(spark: SparkSession, path: str, most_skew: float = MOST_SKEW) -> DataFrame:
    """Open a table of `write_bucketed`, from any session; as plain files where its buckets are too uneven."""
    spec = bucket_spec(spark, path)
    schema = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(json.dumps(spec["schema"]))
    if spec["largest"] * spec["buckets"] > most_skew * spec["rows"]:
        return spark.read.schema(schema.toDDL()).parquet(path)
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        key = "`" + spec["key"].replace("`", "``") + "`"
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) "
            f"INTO {spec['buckets']} BUCKETS LOCATION '{place}'"
        )
    return spark.table(name)
