"""The suite from states against the suite from the tables, over loads that grow, repeat and fail."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starloom.operators import check_states, quality
from starloom.operators.check_states import TableState
from starloom.plans import sales
from starloom.plans.star import QualityGateError, check_star, load_star, read_star
from starloom.sources import warehouse

DAY = datetime(2024, 1, 1)
FACT = sales.STAR.fact.name
CHECKS = [
    quality.RowCount(FACT, 100), quality.RowCount(FACT, 10_000_000), quality.NullFraction(FACT, 0.2), quality.NullFraction(FACT, by_column={"returned": 0.9}),
    quality.DuplicateKeys(FACT, ("result_key",)), quality.DuplicateKeys(FACT, sales.STAR.fact.grain), quality.DuplicateKeys(FACT, ("l_orderkey",), where="l_linenumber = 1"),
    quality.References(FACT, "dim_customer", "customer_key", "customer_key"), quality.References(FACT, "dim_part_type", "part_type_key", "part_type_key"),
    quality.DataType(FACT, "l_quantity", "float"), quality.RowCount("dim_customer", 1), quality.DuplicateKeys("dim_customer", ("c_custkey",)),
]


def report(suite):
    return [tuple(r) for r in suite.orderBy("position").collect()]


def test_states_answer_like_the_tables(spark, tmp_path):
    tables = {n: spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("customer", "supplier", "part", "orders", "lineitem")}
    sources = sales.sources(tables)
    root = str(tmp_path)
    for day, part in enumerate(("l_orderkey % 3 = 0", "l_orderkey % 3 < 2", "l_orderkey % 3 < 2", "l_orderkey % 3 = 1", "l_orderkey > 10")):
        at = DAY + timedelta(days=min(day, 3) if day != 2 else 1)  # the third load replays the second
        load_star({**sources, sales.LINES: sources[sales.LINES].filter(part)}, sales.STAR, root, at, checks=CHECKS, min_pass_rate=0.5, keep_states=True)
        from_tables = report(quality.run_suite(read_star(spark, sales.STAR, root), CHECKS))
        assert report(check_star(spark, sales.STAR, root, CHECKS)) == from_tables
    assert warehouse.last_promoted(spark, root).watched
    with pytest.raises(QualityGateError):
        load_star(sources, sales.STAR, root, DAY + timedelta(days=9), checks=CHECKS, min_pass_rate=1.0, keep_states=True)
    assert report(check_star(spark, sales.STAR, root, CHECKS)) == from_tables
    # A part without a state, or other keys: the tables answer.
    load_star(sources, sales.STAR, root, DAY + timedelta(days=10))
    assert warehouse.read_states(spark, root, FACT, warehouse.last_promoted(spark, root)) is None
    assert report(check_star(spark, sales.STAR, root, CHECKS)) == report(quality.run_suite(read_star(spark, sales.STAR, root), CHECKS))


def test_keys_doubled_across_parts(spark):
    """Copies of a key in several parts, nulls included, and keys of other tables that turn up later."""
    parts = [[(1, "a", 5), (1, "a", None), (2, None, 6)], [(2, None, 7), (3, "c", 5)], [], [(1, "a", 8), (4, "d", 9), (4, "d", 9)]]
    frames = [spark.createDataFrame(p, "k bigint, t string, f bigint") for p in parts]
    whole, state = frames[0].limit(0), None
    checks = [quality.RowCount("x", 3), quality.NullFraction("x", 0.1), quality.DuplicateKeys("x", ("k", "t")), quality.DuplicateKeys("x", ("k",)), quality.References("x", "y", "f", "id")]
    foreign, unique = check_states.watched(checks, "x")
    for i, part in enumerate(frames):
        name = f"{i:03d}"
        own = {"counts": check_states.counts(part, name), "used": check_states.used(part, name, foreign)}
        own["doubled"] = check_states.doubled(part, whole, name, unique[0]).unionByName(check_states.doubled(part, whole, name, unique[1]))
        state = own if state is None else {kind: state[kind].unionByName(own[kind]) for kind in own}
        whole = whole.unionByName(part)
        others = {"x": whole, "y": spark.range(5, 5 + 2 * i + 1).withColumn("id", F.col("id"))}
        found = report(quality.run_suite(others, checks, {"x": TableState.of(state, foreign, unique)}))
        assert found == report(quality.run_suite(others, checks))
    assert [r[0] for r in state["doubled"].select("copies").collect()]


def test_copies_in_the_part_and_before_it(spark):
    schema = "a int, b string, v int"
    rows = spark.createDataFrame([(1, "x", 0), (1, "x", 1), (2, None, 0), (None, None, 0), (3, "y", 0)], schema)
    earlier = spark.createDataFrame([(2, None, 5), (2, None, 6), (4, "z", 0), (4, "z", 1), (None, None, 7)], schema)
    found = check_states.doubled(rows, earlier, "p", ("a", "b"))
    assert sorted((r["key"], r["copies"]) for r in found.collect()) == [("{\"a\":1,\"b\":\"x\"}", 2), ("{\"a\":2}", 3), ("{}", 2)]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # The rows and the earlier ones to their join, and once to the fold.
        plan = check_states.doubled(rows, earlier, "p", ("a", "b"))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
