"""Batches of a layer table that are replaced, and writes that do not end."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from starloom.sources import layers

DAY1, DAY2, DAY3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)


def values(df):
    return sorted(r["v"] for r in df.collect())


def broken(spark):
    return spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).cast("bigint").alias("v"))


@pytest.mark.parametrize("fmt", layers.FORMATS)
def test_a_write_that_dies_leaves_the_earlier_partition(spark, tmp_path, fmt):
    root, df = str(tmp_path), spark.range(3).withColumnRenamed("id", "v")
    layers.write_layer(df, root, "t", DAY1, fmt)
    with pytest.raises(Exception, match="lost"):
        layers.write_layer(broken(spark), root, "t", DAY1, fmt)
    # A driver that died after some files were there, in a batch that was there and in a new one.
    for day in ("20240101_000000_000000", "20240102_000000_000000"):
        layers.writer(df, fmt).save(f"{root}/t/{layers.BATCH}={day}/{layers.ATTEMPT}=dead")
    assert values(layers.read_layer(spark, root, "t", df.schema, fmt, DAY1)) == [0, 1, 2]
    assert values(layers.read_layer(spark, root, "t", df.schema, fmt)) == [0, 1, 2]
    assert layers.newest_batch(spark, root, "t") == "20240101_000000_000000"
    layers.write_layer(df.filter("v > 0"), root, "t", DAY1, fmt)
    layers.write_layer(df.filter("v > 1"), root, "t", DAY2, fmt)
    assert values(layers.read_layer(spark, root, "t", df.schema, fmt)) == [1, 2, 2]
    assert values(layers.read_newest(spark, root, "t", df.schema, fmt)) == [2]
    assert len(layers.remove_replaced(spark, root, "t")) >= 3
    assert layers.remove_replaced(spark, root, "t") == []
    assert values(layers.read_layer(spark, root, "t", df.schema, fmt)) == [1, 2, 2]


def test_partitions_of_other_writers_are_read_too(spark, tmp_path):
    root, df = str(tmp_path), spark.range(4).withColumnRenamed("id", "v")
    df.withColumn(layers.BATCH, F.concat(F.lit("2023010"), (F.col("v") % 2 + 1).cast("string"))).write.partitionBy(layers.BATCH).parquet(f"{root}/t")
    assert layers.newest_batch(spark, root, "t") == "20230102"
    layers.write_layer(spark.range(9, 10).withColumnRenamed("id", "v"), root, "t", DAY3)
    found = layers.read_layer(spark, root, "t")
    assert sorted(map(tuple, found.select("v", layers.BATCH).collect())) == [(0, "20230101"), (1, "20230102"), (2, "20230101"), (3, "20230102"), (9, "20240103_000000_000000")]
    with pytest.raises(ValueError, match="no batch"):
        layers.read_layer(spark, root, "none")
