"""Bucketed tables: plans without a shuffle below the join, results as from plain tables."""

import random

import pytest

from starloom.operators import facts, quality
from starloom.plans.specs import DimensionSpec, FactSpec, StarSpec
from starloom.sources import buckets

STAR = StarSpec(
    dimensions=(DimensionSpec(name="d", source="s", key="dk", natural_keys=("a",), attributes=("colour",), scd=1),),
    fact=FactSpec(name="f", source="s", key="k", dimensions=("d",), measures=("x",)),
)
BY = {"d": ["colour"]}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Every dimension is too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def made(spark, hot=0):
    draw = random.Random(3)
    keys = [draw.choice([None, *range(1, 120)]) for _ in range(600)] + [7] * hot
    fact = spark.createDataFrame([(k, draw.choice([None, 1.0, 2.5])) for k in keys], "dk bigint, x double")
    return fact, spark.createDataFrame([(i, f"c{i % 5}") for i in range(100)], "dk bigint, colour string")


def test_joins_of_buckets_need_no_shuffle(spark, tmp_path, no_broadcast):
    fact, dim = made(spark)
    near, beside = (buckets.write_bucketed(t, f"{tmp_path}/{n}", "dk", 4) for t, n in ((fact, "f"), (dim, "d")))
    rollup = facts.star_rollup(near, {"d": beside}, STAR, BY, ["x"], ["x"], fold_first=["d"])
    lost = quality.orphans(near, beside, "dk", "dk")
    for found in (rollup, lost):
        below = plan(found).split("SortMergeJoin", 1)
        assert len(below) == 2 and "Exchange" not in below[1]
    plain = facts.star_rollup(fact, {"d": dim}, STAR, BY, ["x"], ["x"], fold_first=["d"])
    assert "Exchange" in plan(plain).split("SortMergeJoin", 1)[1]
    assert rows(rollup) == rows(plain)
    assert rows(lost) == rows(quality.orphans(fact, dim, "dk", "dk")) != []
    assert rows(near) == rows(fact)


def test_hot_buckets_are_opened_as_plain_files(spark, tmp_path, no_broadcast):
    fact, dim = made(spark, hot=2000)
    near, beside = (buckets.write_bucketed(t, f"{tmp_path}/{n}", "dk", 16) for t, n in ((fact, "f"), (dim, "d")))
    assert buckets.bucket_spec(spark, f"{tmp_path}/f")["largest"] >= 2000
    rollup = facts.star_rollup(near, {"d": beside}, STAR, BY, ["x"], ["x"])
    assert "Exchange" in plan(rollup).split("SortMergeJoin", 1)[1]
    assert rows(rollup) == rows(facts.star_rollup(fact, {"d": dim}, STAR, BY, ["x"], ["x"]))


def test_another_session_finds_the_buckets(spark, tmp_path, no_broadcast):
    fact, dim = made(spark)
    paths = [f"{tmp_path}/{n}" for n in ("f's", "d")]
    for table, path in zip((fact, dim), paths, strict=True):
        buckets.write_bucketed(table, path, "dk", 4)
        spark.sql(f"DROP TABLE {buckets._table_name(path)}")  # an external table: its files stay
    near, beside = (buckets.read_bucketed(spark, path) for path in paths)
    assert "Exchange" not in plan(quality.orphans(near, beside, "dk", "dk")).split("SortMergeJoin", 1)[1]
    assert near.schema == fact.schema and rows(near) == rows(fact)


def test_edges(spark, tmp_path):
    fact, _ = made(spark)
    empty = buckets.write_bucketed(fact.limit(0), f"{tmp_path}/empty", "dk", 4)
    assert empty.columns == ["dk", "x"] and rows(empty) == []
    nulls = spark.createDataFrame([(None, 1.0)] * 3, "dk bigint, x double")
    assert rows(buckets.write_bucketed(nulls, f"{tmp_path}/nulls", "dk", 4)) == [(None, 1.0)] * 3
    for wrong in (("dk", 0), ("nothing", 4)):
        with pytest.raises(ValueError):
            buckets.write_bucketed(fact, f"{tmp_path}/wrong", *wrong)
    with pytest.raises(ValueError):
        buckets.write_bucketed(fact, f"{tmp_path}/empty", "dk", 4)
