"""A sales star over order lines: the same builders, another set of specs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.plans.specs import DimensionSpec, FactSpec, StarSpec

LINES = "lines"

DIM_CUSTOMER = DimensionSpec(
    name="dim_customer",
    source="customer",
    key="customer_key",
    natural_keys=("c_custkey",),
    attributes=("c_name", "c_mktsegment", "c_nationkey", "c_acctbal"),
    scd=1,
    order_by=("c_custkey",),
)
DIM_SUPPLIER = DimensionSpec(
    name="dim_supplier",
    source="supplier",
    key="supplier_key",
    natural_keys=("s_suppkey",),
    attributes=("s_name", "s_nationkey"),
    scd=2,
    order_by=("s_suppkey",),
)
DIM_PART_TYPE = DimensionSpec(
    name="dim_part_type",
    source="part",
    key="part_type_key",
    natural_keys=("p_brand", "p_type"),
    scd=0,
)
DIM_PERIOD = DimensionSpec(
    name="dim_period",
    source="orders",
    key="period_key",
    natural_keys=("order_year", "order_quarter", "o_orderpriority", "o_orderstatus"),
    scd=0,
)
STAR = StarSpec(
    dimensions=(DIM_CUSTOMER, DIM_SUPPLIER, DIM_PART_TYPE, DIM_PERIOD),
    fact=FactSpec(
        name="fact_sale",
        source=LINES,
        key="result_key",
        dimensions=("dim_customer", "dim_supplier", "dim_part_type", "dim_period"),
        measures=("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "returned"),
        flags={"returned_flag": "returned"},
        grain=("customer_key", "l_orderkey", "l_linenumber"),
        order_by=("l_orderkey", "l_linenumber"),
        on={"c_custkey": "o_custkey", "s_suppkey": "l_suppkey"},
    ),
)


def with_period(orders: DataFrame) -> DataFrame:
    return orders.withColumns(
        {
            "order_year": F.year("o_orderdate").cast("bigint"),
            "order_quarter": F.quarter("o_orderdate").cast("bigint"),
        }
    )


def sources(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The frames the star is built from; one line per order line with its natural keys."""
    orders = with_period(tables["orders"])
    # 'N' marks a line that was not returned; as a missing value it feeds the flag.
    lines = tables["lineitem"].withColumn(
        "returned", F.nullif(F.col("l_returnflag"), F.lit("N"))
    )
    # Parts first: their two columns are less to carry through the other shuffle than those of orders.
    part = tables["part"].select("p_partkey", "p_brand", "p_type")
    columns = [df[c] for df in (lines, orders, part) for c in df.columns]
    lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "inner").join(
        orders, F.col("l_orderkey") == F.col("o_orderkey"), "inner"
    ).select(*columns)
    return {
        "customer": tables["customer"],
        "supplier": tables["supplier"],
        "part": tables["part"],
        "orders": orders,
        LINES: lines,
    }
