"""Order lines that are stored once for several loads."""

from pyspark.sql import functions as F

from starloom import queries
from starloom.operators import facts
from starloom.plans import sales
from starloom.plans.star import build_dimensions
from starloom.sources.staging import stage

FOLDER = "/root/testdata/sf0.001"


def test_stored_lines_are_the_joined_lines(spark):
    lines, stored = (sources(spark, FOLDER)[sales.LINES] for sources in (queries.sales_sources, queries.stored_sales_sources))
    columns = [*facts.source_columns(sales.STAR), "o_orderdate"]
    assert stored.columns == columns
    assert lines.select(columns).exceptAll(stored).isEmpty() and stored.exceptAll(lines.select(columns)).isEmpty()


def test_lines_stand_in_the_order_of_columns_of_their_tables(spark):
    tables = {n: spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("customer", "supplier", "part", "orders", "lineitem")}
    columns = sales.sources(tables)[sales.LINES].columns
    orders = sales.with_period(tables["orders"]).columns
    assert columns == [*tables["lineitem"].columns, "returned", *orders, "p_partkey", "p_brand", "p_type"]


def test_loads_of_stored_lines_shuffle_no_lines_to_their_customers(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    sources = queries.stored_sales_sources(spark, FOLDER)
    dims = {n: stage(d) for n, d in build_dimensions(sources, sales.STAR, queries.EARLIER).items()}
    # Only the customers are too many for a broadcast.
    others = {n: F.broadcast(d) for n, d in dims.items() if n != "dim_customer"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bound = facts.bind_fact(sources[sales.LINES].filter(queries.FIRST_LOAD), {**dims, **others}, sales.STAR, queries.EARLIER)
        plan = bound._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 1 and plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
