"""Dimensions kept as a base and deltas against dimensions that are written whole."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starloom.operators.dimensions import build_dimension, dimension_delta, merge_dimension, newest_rows
from starloom.operators.keys import max_key
from starloom.plans import sales
from starloom.plans.specs import DimensionSpec
from starloom.plans.star import load_star, read_star
from starloom.sources import warehouse
from starloom.sources.staging import stage

DAY = datetime(2024, 1, 1)
SPECS = {
    0: DimensionSpec(name="d", source="s", key="k", natural_keys=("a", "b"), scd=0),
    1: DimensionSpec(name="d", source="s", key="k", natural_keys=("a",), attributes=("b", "c"), scd=1, order_by=("n",)),
    2: DimensionSpec(name="d", source="s", key="k", natural_keys=("a",), attributes=("b", "c"), scd=2, order_by=("n",)),
}


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("scd", [0, 1, 2])
def test_deltas_read_like_the_rewritten_dimension(spark, scd):
    draw, spec = random.Random(scd), SPECS[scd]

    def batch(n, low, high):
        values = [(draw.choice([None, *range(low, high)]), draw.choice([None, "p", "q"]), draw.choice([None, 1.0, 2.0]), i) for i in range(n)]
        return spark.createDataFrame(values, "a bigint, b string, c double, n bigint")

    base = whole = stage(build_dimension(batch(60, 0, 30), spec, DAY))
    deltas, last = [], max_key(whole, "k")
    for i, (n, low, high) in enumerate([(20, 10, 40), (1, 3, 4), (0, 0, 1), (30, 0, 60)], 1):
        source, at = batch(n, low, high), DAY + timedelta(days=i)
        known = newest_rows(base, deltas, "k")
        delta = stage(dimension_delta(known, source, spec, at, last))
        changed = set(rows(whole))
        whole = stage(merge_dimension(whole, source, spec, at))
        changed = set(rows(whole)) - changed
        deltas.append(delta)
        last = max(last, max_key(delta, "k"))
        assert set(rows(delta)) >= changed
        # Rows that were there and did not change are not written, but for those a type 1 batch stamps.
        assert len(rows(delta)) == len(changed)
        assert rows(newest_rows(base, deltas, "k")) == rows(whole)
        assert last == max_key(whole, "k")


def test_a_small_batch_writes_little(spark, tmp_path):
    spec = SPECS[1]
    first = spark.range(20_000).select(F.col("id").alias("a"), F.lit("x").alias("b"), F.rand(1).alias("c"), F.col("id").alias("n"))
    base = warehouse.write_table(build_dimension(first, spec, DAY), str(tmp_path), "d", DAY, "one")
    changed = first.filter("a % 100 = 0").withColumn("b", F.lit("y"))
    delta = dimension_delta(base, changed, spec, DAY + timedelta(days=1), 20_000)
    written = warehouse.write_table(delta, str(tmp_path), "d", DAY + timedelta(days=1), "two")
    assert written.count() == 200

    def size(attempt):
        return sum(f.stat().st_size for f in tmp_path.glob(f"d/*/_attempt={attempt}/*.parquet"))

    assert size("two") < 0.1 * size("one")


def test_loads_and_compaction(spark, tmp_path):
    tables = {n: spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("customer", "supplier", "part", "orders", "lineitem")}
    later = {**tables, "customer": tables["customer"].filter("c_custkey % 10 = 0").withColumn("c_acctbal", F.lit(1.0)), "supplier": tables["supplier"].filter("s_suppkey % 3 = 0").withColumn("s_name", F.lit("new"))}
    later["customer"] = later["customer"].unionByName(tables["customer"].limit(3).withColumn("c_custkey", F.col("c_custkey") + 1_000_000))
    found = {}
    for deltas in (False, True):
        root = f"{tmp_path}/{deltas}"
        for i, given in enumerate((tables, later, later)):
            sources = sales.sources(given)
            sources[sales.LINES] = sales.sources(tables)[sales.LINES].filter(f"l_orderkey % 4 <= {i}")
            load_star(sources, sales.STAR, root, DAY + timedelta(days=i), deltas=deltas)
        found[deltas] = {name: rows(t.drop("result_key")) for name, t in read_star(spark, sales.STAR, root).items()}
        at = warehouse.last_promoted(spark, root)
        assert {len(warehouse.chain_of(at, d.name)) for d in sales.STAR.dimensions} == {3 if deltas else 1}
    assert found[True] == found[False]
    names = [d.name for d in sales.STAR.dimensions]
    tables_of = {**dict.fromkeys(names, False), sales.STAR.fact.name: True}
    assert warehouse.remove_superseded(spark, root, tables_of) == []
    keys = warehouse.last_promoted(spark, root).last_keys
    assert warehouse.compact_dimensions(spark, root, names) == names
    assert warehouse.compact_dimensions(spark, root, names) == []
    assert len(warehouse.remove_superseded(spark, root, tables_of)) == 3 * len(names)
    after = {name: rows(t.drop("result_key")) for name, t in read_star(spark, sales.STAR, root).items()}
    assert after == found[False]
    assert warehouse.last_promoted(spark, root).last_keys == keys
    assert warehouse.manifest(spark, root).count() == 3
