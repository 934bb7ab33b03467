"""One query per operator over the provided tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.columns import OPEN_END, timestamp
from starloom.operators import cleaning, dimensions, facts, profile, quality, runlog, sampling, scd
from starloom.operators.keys import dense_keys, max_key, next_key
from starloom.plans import sales, silver
from starloom.plans.specs import CleaningConfig, DimensionSpec
from starloom.plans.star import QualityGateError, build_dimensions, build_star, check_star, create_star, load_star, read_star
from starloom.sources.ingest import stamp
from starloom.sources import buckets, ingest, layers, warehouse
from starloom.sources.files import delete_at_exit
from starloom.sources.staging import shared_folder, stage
from starloom.sources.warehouse import manifest

Query = Callable[[SparkSession, str], DataFrame]

BATCH_TS = datetime(2024, 6, 1)
EARLIER = datetime(2022, 1, 1)
EARLIEST = datetime(2020, 1, 1)
NEXT_TS = datetime(2024, 6, 2)

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sales_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    names = ("customer", "supplier", "part", "orders", "lineitem")
    return sales.sources({n: read(spark, folder, n) for n in names})


def scratch_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/starloom-query-{uuid.uuid4().hex}"


def with_end_as_text(dim: DataFrame) -> DataFrame:
    """The open end lies beyond the nanosecond timestamps many result readers use."""
    return dim.withColumn("end_date", F.col("end_date").cast("string"))


# Ingest and cleaning ---------------------------------------------------------------


@query
def q01_ingest_stamp(spark: SparkSession, folder: str) -> DataFrame:
    return stamp(read(spark, folder, "supplier"), BATCH_TS)


@query
def q02_standard_names(spark: SparkSession, folder: str) -> DataFrame:
    raw = read(spark, folder, "customer").toDF(
        " C CustKey", "C Name ", "C NationKey", "C AcctBal", "C MktSegment"
    )
    return cleaning.standardize_column_names(raw)


@query
def q03_type_coercion(spark: SparkSession, folder: str) -> DataFrame:
    raw = read(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("priority_text"),
        F.substring("o_orderpriority", 1, 1).alias("priority_rank"),
        F.col("o_totalprice").cast("string").alias("total_price"),
    )
    mapping = {"priority_text": "int", "priority_rank": "int", "total_price": "float", "absent": "int"}
    return cleaning.coerce_types(raw, mapping)[0]


def customers_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with missing segments and balances, a NaN among the latter."""
    return read(spark, folder, "customer").withColumns(
        {
            "c_mktsegment": F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")),
            "c_acctbal": F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).when(
                F.col("c_acctbal") < -500, F.lit(float("nan"))
            ),
        }
    )


@query
def q04_drop_missing(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.handle_missing_values(customers_with_gaps(spark, folder), "drop")


@query
def q05_fill_mean(spark: SparkSession, folder: str) -> DataFrame:
    customers = customers_with_gaps(spark, folder).withColumn(
        "c_nationkey", F.nullif(F.col("c_nationkey"), F.lit(7))
    )
    filled = cleaning.handle_missing_values(customers, "fillna_mean")
    return filled.withColumns({c: F.round(c, 4) for c in ("c_nationkey", "c_acctbal")})


@query
def q06_forward_fill(spark: SparkSession, folder: str) -> DataFrame:
    gaps = read(spark, folder, "events").withColumn(
        "value", F.when(~F.col("event_type").isin("view", "error"), F.col("value"))
    )
    return cleaning.handle_missing_values(
        gaps, "fillna_forward", order_by=("ts",), partition_by=("user_id",), subset=("value",)
    )


@query
def q07_fill_value(spark: SparkSession, folder: str) -> DataFrame:
    values = {"c_mktsegment": "UNKNOWN", "c_acctbal": -1.0}
    return cleaning.handle_missing_values(
        customers_with_gaps(spark, folder), "fillna_value", value=values
    )


@query
def q08_outliers_sequential(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"
    )
    return cleaning.remove_outliers(lines, ["l_extendedprice", "l_quantity"], 1.5)


@query
def q09_dedup_whole_row(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders")
    return cleaning.remove_duplicates(orders.unionByName(orders))


@query
def q54_dedup_user_flag(spark: SparkSession, folder: str) -> DataFrame:
    """Stamped rows that differ in a user's column with a leading underscore alone are no copies."""
    orders = read(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    flagged = orders.withColumn("_flag", F.lit(1)).unionByName(orders.withColumn("_flag", F.col("o_orderkey").cast("int") % 2))
    return cleaning.remove_duplicates(stamp(flagged, BATCH_TS).unionByName(stamp(flagged, EARLIER)))


@query
def q55_outliers_default_columns(spark: SparkSession, folder: str) -> DataFrame:
    """All numeric columns by default, a user's column with a leading underscore included."""
    prices = read(spark, folder, "part").select("p_partkey", "p_size", F.col("p_retailprice").alias("_price"))
    return cleaning.remove_outliers(prices, z_score_threshold=1.2)


@query
def q10_dedup_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.remove_duplicates(
        read(spark, folder, "lineitem"), ("l_orderkey", "l_linenumber"), ("l_shipdate",)
    )


# Dimensions ------------------------------------------------------------------------

USER_DIM = DimensionSpec(
    name="dim_user",
    source="events",
    key="user_key",
    natural_keys=("user_id",),
    attributes=("event_type", "value"),
    scd=1,
    order_by=("ts",),
)


@query
def q11_dim_keep_last(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.build_dimension(read(spark, folder, "events"), USER_DIM, BATCH_TS)


def parts_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Parts where one type is unknown, so that keys with a missing part occur."""
    return read(spark, folder, "part").withColumn("p_type", F.nullif(F.col("p_type"), F.lit("PROMO")))


@query
def q12_dim_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return dimensions.build_dimension(parts_with_gaps(spark, folder), sales.DIM_PART_TYPE, BATCH_TS)


@query
def q13_dim_period(spark: SparkSession, folder: str) -> DataFrame:
    orders = sales.with_period(read(spark, folder, "orders"))
    return dimensions.build_dimension(orders, sales.DIM_PERIOD, BATCH_TS)


@query
def q14_dim_scd2_initial(spark: SparkSession, folder: str) -> DataFrame:
    return with_end_as_text(
        dimensions.build_dimension(read(spark, folder, "supplier"), sales.DIM_SUPPLIER, BATCH_TS)
    )


@query
def q15_fact_build(spark: SparkSession, folder: str) -> DataFrame:
    # Customers in debt are not in the dimension, so their lines drop out.
    sources = sales_sources(spark, folder)
    sources["customer"] = sources["customer"].filter("c_acctbal >= 0")
    return build_star(sources, sales.STAR, BATCH_TS)[1]


# Slowly changing dimensions --------------------------------------------------------


def customer_update(spark: SparkSession, folder: str) -> DataFrame:
    """A batch of customers with a new segment name and some unknown balances."""
    return (
        read(spark, folder, "customer")
        .filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
        .withColumns(
            {
                "c_mktsegment": F.lower("c_mktsegment"),
                "c_acctbal": F.when(F.col("c_acctbal") < 5000, F.col("c_acctbal")),
            }
        )
    )


def known_customers(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "customer").filter("c_acctbal >= 0")


@query
def q16_scd1_upsert(spark: SparkSession, folder: str) -> DataFrame:
    update = customer_update(spark, folder).drop("c_nationkey")
    return scd.scd1_upsert(known_customers(spark, folder), update, "c_custkey")


@query
def q17_dim_scd1_merge(spark: SparkSession, folder: str) -> DataFrame:
    existing = dimensions.build_dimension(known_customers(spark, folder), sales.DIM_CUSTOMER, EARLIER)
    return dimensions.merge_dimension(
        existing, customer_update(spark, folder), sales.DIM_CUSTOMER, BATCH_TS
    )


def versions(rows: DataFrame, start: datetime, end: datetime, is_current: bool) -> DataFrame:
    return rows.withColumns(
        {"effective_date": timestamp(start), "end_date": timestamp(end), "is_current": F.lit(is_current)}
    )


def customer_history(spark: SparkSession, folder: str) -> DataFrame:
    """Open versions of customers not in debt, closed ones before them for some."""
    known = known_customers(spark, folder).select("c_custkey", "c_name", "c_mktsegment")
    rich = read(spark, folder, "customer").filter("c_acctbal > 5000")
    old = rich.select("c_custkey", "c_name", F.lit("NONE").alias("c_mktsegment"))
    return versions(known, EARLIER, OPEN_END, True).unionByName(versions(old, EARLIEST, EARLIER, False))


def customer_changes(spark: SparkSession, folder: str) -> DataFrame:
    """All customers; some with another segment, all with another name, a few without key."""
    return read(spark, folder, "customer").select(
        F.when(F.col("c_acctbal") >= -900, F.col("c_custkey")).alias("c_custkey"),
        F.upper("c_name").alias("c_name"),
        F.when(F.col("c_acctbal").between(1000, 4000), F.lit("MOVED"))
        .when(F.col("c_acctbal") < 9000, F.col("c_mktsegment"))
        .alias("c_mktsegment"),
    )


def upserted_history(spark: SparkSession, folder: str) -> DataFrame:
    return scd.scd2_upsert(
        customer_history(spark, folder),
        customer_changes(spark, folder),
        "c_custkey",
        ["c_mktsegment"],
        BATCH_TS,
    )


@query
def q18_scd2_upsert(spark: SparkSession, folder: str) -> DataFrame:
    return with_end_as_text(upserted_history(spark, folder))


def chained_users(spark: SparkSession, folder: str) -> DataFrame:
    """First events of users as their dimension, and all events as one batch for it."""
    events = read(spark, folder, "events")
    first = cleaning.remove_duplicates(events, ("user_id",), ("ts",)).filter("value < 100")
    existing = versions(first.select("user_id", "event_type", "value"), EARLIER, OPEN_END, True)
    unknown = (F.col("event_type") == "error") & (F.col("value") > 400)
    batch = events.select(
        F.when(~unknown, F.col("user_id")).alias("user_id"), "event_type", "value", "ts"
    )
    return scd.scd2_upsert(existing, batch, "user_id", ["event_type"], BATCH_TS, order_by=("ts",))


@query
def q19_scd2_repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    return with_end_as_text(chained_users(spark, folder))


@query
def q51_scd2_second_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The dimension of the batch with repeated keys takes the next batch."""
    third = read(spark, folder, "events").where("user_id % 3 = 0").select("user_id").distinct()
    batch = third.select("user_id", F.lit("again").alias("event_type"), F.lit(0.0).alias("value"))
    return with_end_as_text(
        scd.scd2_upsert(chained_users(spark, folder), batch, "user_id", ["event_type"], NEXT_TS)
    )


CUSTOMER_HISTORY_DIM = DimensionSpec(
    name="dim_customer_history",
    source="customer",
    key="customer_key",
    natural_keys=("c_custkey",),
    attributes=("c_name", "c_mktsegment"),
    scd=2,
    order_by=("c_custkey",),
)


def moved_customers(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "customer").withColumn(
        "c_mktsegment",
        F.when(F.col("c_acctbal").between(1000, 4000), F.lit("MOVED")).otherwise(F.col("c_mktsegment")),
    )


@query
def q20_dim_scd2_merge(spark: SparkSession, folder: str) -> DataFrame:
    existing = dimensions.build_dimension(known_customers(spark, folder), CUSTOMER_HISTORY_DIM, EARLIER)
    return with_end_as_text(
        dimensions.merge_dimension(existing, moved_customers(spark, folder), CUSTOMER_HISTORY_DIM, BATCH_TS)
    )


@query
def q21_type0_merge(spark: SparkSession, folder: str) -> DataFrame:
    parts = parts_with_gaps(spark, folder)
    existing = dimensions.build_dimension(parts.filter("p_retailprice < 950"), sales.DIM_PART_TYPE, EARLIER)
    return dimensions.merge_dimension(existing, parts, sales.DIM_PART_TYPE, BATCH_TS)


@query
def q22_scd2_current(spark: SparkSession, folder: str) -> DataFrame:
    return with_end_as_text(scd.current_records(upserted_history(spark, folder)))


@query
def q23_scd2_history(spark: SparkSession, folder: str) -> DataFrame:
    """Versions of the customer that has most of them, in order, the last key among equals."""
    dim = stage(upserted_history(spark, folder))
    counts = dim.where("c_custkey IS NOT NULL").groupBy("c_custkey").count()
    key = counts.agg(F.max_by("c_custkey", F.struct("count", "c_custkey"))).first()[0]
    found = scd.ranked_history(dim, "c_custkey", key)
    return with_end_as_text(
        found.select("version", "c_custkey", "c_name", "c_mktsegment", "effective_date", "end_date", "is_current")
    )


@query
def q24_scd2_validate(spark: SparkSession, folder: str) -> DataFrame:
    history = customer_history(spark, folder)
    broken = history.withColumn(
        "end_date",
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None))
        .when(F.col("c_mktsegment") == "MACHINERY", timestamp(BATCH_TS))
        .otherwise(F.col("end_date")),
    )
    counted = []
    for name, dim in (("sound", history), ("broken", broken)):
        wrong = scd.structure_violations(dim, "c_custkey")
        counted.append(
            wrong.agg(F.count(F.lit(1)).alias("violations")).select(
                F.lit(name).alias("dimension"), "violations", (F.col("violations") == 0).alias("valid")
            )
        )
    return reduce(DataFrame.unionByName, counted)


@query
def q25_fact_fanout_all_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Facts per supplier nation, bound to the open version or to every version."""
    sources = sales_sources(spark, folder)
    dims = build_dimensions(sources, sales.STAR, EARLIER)
    suppliers, dim = sources["supplier"], dims[sales.DIM_SUPPLIER.name]
    moved = suppliers.withColumn(
        "s_nationkey",
        F.when(F.col("s_acctbal") > 5000, F.col("s_nationkey") + 100).otherwise(F.col("s_nationkey")),
    )
    dim = stage(dimensions.merge_dimension(dim, moved, sales.DIM_SUPPLIER, BATCH_TS))
    dims[sales.DIM_SUPPLIER.name] = dim
    counted = []
    for version in ("current", "all"):
        bound = facts.bind_fact(sources[sales.LINES], dims, sales.STAR, BATCH_TS, version)
        rolled = facts.star_rollup(bound, dims, sales.STAR, by={sales.DIM_SUPPLIER.name: ["s_nationkey"]})
        counted.append(rolled.withColumn("version", F.lit(version)))
    return reduce(DataFrame.unionByName, counted)


# Incremental facts and rollup ------------------------------------------------------

FIRST_LOAD = "o_orderdate < TIMESTAMP_NTZ '1999-01-01'"
SECOND_LOAD = "o_orderdate >= TIMESTAMP_NTZ '1998-01-01'"


def stored_sales_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """`sales_sources` for several loads: the lines are joined once, and lie in buckets of their largest dimension's key."""
    sources = sales_sources(spark, folder)
    path = f"{scratch_root(spark)}/lines"
    delete_at_exit(spark, path)
    lines = sources[sales.LINES].select(*facts.source_columns(sales.STAR), "o_orderdate")
    # As many buckets as a shuffle has partitions, or Spark would shuffle them all the same.
    lines = buckets.write_bucketed(lines, path, "o_custkey", int(spark.conf.get("spark.sql.shuffle.partitions")))
    return {**sources, sales.LINES: lines}


def sale_loads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Keyed facts of the first load and bound facts of an overlapping second one."""
    sources = stored_sales_sources(spark, folder)
    dims = build_dimensions(sources, sales.STAR, EARLIER)
    lines = sources[sales.LINES]
    existing = facts.build_fact(lines.filter(FIRST_LOAD), dims, sales.STAR, EARLIER)
    return existing, stage(facts.bind_fact(lines.filter(SECOND_LOAD), dims, sales.STAR, BATCH_TS))


@query
def q26_fact_append(spark: SparkSession, folder: str) -> DataFrame:
    existing, bound = sale_loads(spark, folder)
    fact = sales.STAR.fact
    fresh = facts.unseen_facts(existing, bound, fact.grain)
    offset = next_key(existing, fact.key) - 1
    return existing.unionByName(facts.number_facts(fresh, fact, offset))


@query
def q27_append_replay(spark: SparkSession, folder: str) -> DataFrame:
    """The second load again after it was appended, with and without one row per grain."""
    existing, bound = sale_loads(spark, folder)
    grain = sales.STAR.fact.grain
    loaded = existing.drop("result_key").unionByName(facts.unseen_facts(existing, bound, grain))
    parts = {
        "first": existing.select(*grain),
        "appended": facts.unseen_facts(existing, bound, grain).select(*grain),
        "appended_one_per_grain": facts.unseen_facts(existing, bound, grain, dedup_batch=True).select(*grain),
        "replayed": facts.unseen_facts(loaded, bound, grain).select(*grain),
    }
    counts = [
        part.agg(F.count(F.lit(1)).alias("fact_rows")).select(F.lit(name).alias("load"), "fact_rows")
        for name, part in parts.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def q28_append_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Three loads into a new warehouse: first, overlapping, the overlapping one again."""
    sources = stored_sales_sources(spark, folder)
    root = scratch_root(spark)
    lines = sources[sales.LINES]
    loads = ((EARLIEST, FIRST_LOAD), (EARLIER, SECOND_LOAD), (BATCH_TS, SECOND_LOAD))
    for batch_ts, part in loads:
        load_star({**sources, sales.LINES: lines.filter(part)}, sales.STAR, root, batch_ts)
    return manifest(spark, root)


@query
def q56_append_by_grain_index(spark: SparkSession, folder: str) -> DataFrame:
    """New facts of the second load, where only files that may hold its grains are opened."""
    existing, bound = sale_loads(spark, folder)
    fact, root = sales.STAR.fact, scratch_root(spark)
    written = warehouse.write_table(existing.repartitionByRange(8, "l_orderkey"), root, fact.name, EARLIER, "first")
    warehouse.write_grain_index(written, root, fact.name, EARLIER, "first", fact.grain)
    counts = facts.append_stats("full", 0, 0)
    warehouse.promote(spark, root, 1, EARLIER, "first", {fact.name: written.schema}, counts, 0, indexed=fact.grain)
    at = warehouse.last_promoted(spark, root)
    near = partial(warehouse.read_fact_near, spark, root, fact.name, at, grain=fact.grain)
    return facts.unseen_facts(near, bound, fact.grain).drop("dw_insert_date", "dw_update_date")


def from_delta(existing: DataFrame, source: DataFrame, spec: DimensionSpec) -> DataFrame:
    """The dimension read from a written base and the written rows that a batch adds or changes."""
    base = stage(existing)
    delta = stage(dimensions.dimension_delta(base, source, spec, BATCH_TS, max_key(base, spec.key)))
    return dimensions.newest_rows(base, [delta], spec.key)


@query
def q57_dim_scd1_delta(spark: SparkSession, folder: str) -> DataFrame:
    existing = dimensions.build_dimension(known_customers(spark, folder), sales.DIM_CUSTOMER, EARLIER)
    return from_delta(existing, customer_update(spark, folder), sales.DIM_CUSTOMER)


@query
def q58_dim_scd2_delta(spark: SparkSession, folder: str) -> DataFrame:
    existing = dimensions.build_dimension(known_customers(spark, folder), CUSTOMER_HISTORY_DIM, EARLIER)
    return with_end_as_text(from_delta(existing, moved_customers(spark, folder), CUSTOMER_HISTORY_DIM))


@query
def q59_type0_delta(spark: SparkSession, folder: str) -> DataFrame:
    parts = parts_with_gaps(spark, folder)
    existing = dimensions.build_dimension(parts.filter("p_retailprice < 950"), sales.DIM_PART_TYPE, EARLIER)
    return from_delta(existing, parts, sales.DIM_PART_TYPE)


@query
def q60_seeded_sample(spark: SparkSession, folder: str) -> DataFrame:
    """A thousand order lines, always the same ones."""
    lines = read(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return sampling.sample_rows(lines, 1000, seed=7, by=["l_orderkey", "l_linenumber", "l_partkey"])


SALE_CHECKS = (
    quality.RowCount("fact_sale", 10),
    quality.NullFraction("fact_sale", by_column={"returned": 0.6}),
    quality.NullFraction("fact_sale", by_column={"returned": 0.1, "l_quantity": 0.0}),
    quality.DuplicateKeys("fact_sale", ("result_key",)),
    quality.DuplicateKeys("fact_sale", sales.STAR.fact.grain),
    quality.References("fact_sale", "dim_customer", "customer_key", "customer_key"),
)


@query
def q61_suite_from_states(spark: SparkSession, folder: str) -> DataFrame:
    """The suite over a fact of three loads, the last a replay, from the states of its parts."""
    sources = stored_sales_sources(spark, folder)
    root = scratch_root(spark)
    lines = sources[sales.LINES]
    for batch_ts, part in ((EARLIER, FIRST_LOAD), (BATCH_TS, SECOND_LOAD), (BATCH_TS, SECOND_LOAD)):
        load_star({**sources, sales.LINES: lines.filter(part)}, sales.STAR, root, batch_ts, checks=SALE_CHECKS, min_pass_rate=0.5, keep_states=True)
    suite = check_star(spark, sales.STAR, root, SALE_CHECKS)
    return suite.select("position", "check", "actual", "passed", "duplicate_count", "missing_keys")


@query
def q62_star_saved(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per table of a star that was built and saved."""
    return create_star(sales_sources(spark, folder), sales.STAR, scratch_root(spark), BATCH_TS)[2]


@query
def q63_run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Runs that were logged as they went, one that failed among them, read before and after the log is folded."""
    path = scratch_root(spark)
    clock = iter(datetime(2024, 1, 1, 0, minute) for minute in range(60)).__next__
    for name in ("nation", "region", "absent"):
        try:
            with runlog.logged_run(spark, path, "bronze", name, "files", clock) as run:
                run.row_count_in = run.row_count_out = read(spark, folder, name).count()
        except AnalysisException:
            pass
    before = runlog.run_report(runlog.read_runs(spark, path)).withColumn("folded", F.lit(False))
    before = stage(before)
    runlog.compact_runs(spark, path)
    after = runlog.run_report(runlog.read_runs(spark, path)).withColumn("folded", F.lit(True))
    return before.unionByName(after).select("folded", "table", "status", "start_time", "end_time", "rows_in", "rows_out", "errors")


@query
def q64_rollup_from_states(spark: SparkSession, folder: str) -> DataFrame:
    """The star rollup from the states of three batches of facts."""
    sources = sales_sources(spark, folder)
    dims = build_dimensions(sources, sales.STAR, BATCH_TS)
    by = {"dim_customer": ["c_mktsegment"], "dim_period": ["order_year"]}
    states = []
    for i in range(3):
        part = facts.bind_fact(sources[sales.LINES].filter(F.col("l_orderkey") % 3 == i), dims, sales.STAR, BATCH_TS)
        states.append(stage(facts.rollup_state(part, sales.STAR, list(by), ["l_extendedprice", "l_quantity"], ["returned_flag"])))
    return facts.rollup_from_states(
        reduce(DataFrame.unionByName, states), dims, sales.STAR, by, ["l_extendedprice", "l_quantity"], ["returned_flag"], digits=4
    )


@query
def q49_replay_after_failed_gate(spark: SparkSession, folder: str) -> DataFrame:
    """A load, then a replay of it with other lines that fails its checks: the first one stays."""
    sources = sales_sources(spark, folder)
    root = scratch_root(spark)
    lines = sources[sales.LINES]
    load_star({**sources, sales.LINES: lines.filter(FIRST_LOAD)}, sales.STAR, root, BATCH_TS)
    try:
        load_star(
            {**sources, sales.LINES: lines.filter(SECOND_LOAD)}, sales.STAR, root, BATCH_TS,
            checks=[quality.RowCount(sales.STAR.fact.name, 1_000_000_000_000)],
        )
    except QualityGateError:
        pass
    tables = read_star(spark, sales.STAR, root)
    return tables[sales.STAR.fact.name].join(tables["dim_customer"].select("customer_key", "c_mktsegment"), "customer_key").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("fact_rows"), F.max("result_key").alias("last_key")
    )


@query
def q37_star_rollup(spark: SparkSession, folder: str) -> DataFrame:
    sources = sales_sources(spark, folder)
    dims = build_dimensions(sources, sales.STAR, BATCH_TS)
    # A rollup needs no result keys, so the bound facts are neither numbered nor written.
    return facts.star_rollup(
        facts.bind_fact(sources[sales.LINES], dims, sales.STAR, BATCH_TS),
        dims,
        sales.STAR,
        by={"dim_customer": ["c_mktsegment"], "dim_period": ["order_year"]},
        averages=["l_quantity", "l_extendedprice"],
        sums=["returned_flag"],
        digits=4,
    )


# Quality ---------------------------------------------------------------------------


def _flat_checks(checks: DataFrame) -> DataFrame:
    """Check rows without nested values."""
    return checks.select(
        "position",
        "check",
        F.coalesce("table", F.concat_ws(" to ", "fact_table", "dim_table")).alias("checked"),
        "passed",
        "threshold",
        "actual",
        "duplicate_count",
        "missing_keys",
        F.size("messages").cast("bigint").alias("message_count"),
    )


@query
def q29_check_row_count(spark: SparkSession, folder: str) -> DataFrame:
    tables = {n: read(spark, folder, n) for n in ("nation", "orders", "lineitem")}
    checks = [
        quality.RowCount("nation", 24),
        quality.RowCount("nation", 25, label="nation at its size"),
        quality.RowCount("orders"),
        quality.RowCount("lineitem", 1_000_000_000_000),
    ]
    return quality.run_suite(tables, checks).select("table", "threshold", "actual", "passed")


@query
def q30_check_null_pct(spark: SparkSession, folder: str) -> DataFrame:
    customers = customers_with_gaps(spark, folder)
    limits = {"c_custkey": 0.0, "c_name": 0.0, "c_mktsegment": 0.05, "c_acctbal": 0.25}
    some = quality.null_fractions(customers, limits).withColumn("subject", F.lit("customers"))
    none = quality.null_fractions(customers.filter("c_custkey < 0"), limits)
    both = some.unionByName(none.withColumn("subject", F.lit("no customers")))
    return both.withColumn("null_fraction", F.round("null_fraction", 8))


@query
def q31_check_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    tables = {
        "lineitem": read(spark, folder, "lineitem"),
        "customer": customers_with_gaps(spark, folder),
        "history": customer_history(spark, folder),
    }
    checks = [
        quality.DuplicateKeys("lineitem", ("l_orderkey", "l_linenumber")),
        quality.DuplicateKeys("customer", ("c_custkey",)),
        quality.DuplicateKeys("customer", ("c_mktsegment", "c_acctbal"), label="customer missing"),
        quality.DuplicateKeys("history", ("c_custkey",)),
        quality.DuplicateKeys("history", ("c_custkey",), label="history open", where="is_current"),
    ]
    return quality.run_suite(tables, checks).select("table", "duplicate_count", "passed")


@query
def q32_check_referential(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders")
    tables = {
        "documents": read(spark, folder, "documents"),
        "labels": read(spark, folder, "labels"),
        "orders": orders.withColumn(
            "o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
        ),
        "customer": read(spark, folder, "customer"),
        "known": known_customers(spark, folder),
    }
    checks = [
        quality.References("documents", "labels", "doc_id", "doc_id"),
        quality.References("orders", "customer", "o_custkey", "c_custkey"),
        quality.References("orders", "known", "o_custkey", "c_custkey"),
    ]
    return quality.run_suite(tables, checks).select("fact_table", "dim_table", "missing_keys", "passed")


@query
def q33_check_types(spark: SparkSession, folder: str) -> DataFrame:
    contract = quality.Contract(
        columns=(
            quality.ColumnRule("c_custkey", "int64", nullable=False),
            quality.ColumnRule("c_name", "object", nullable=False),
            quality.ColumnRule("c_nationkey", "int64"),
            quality.ColumnRule("c_acctbal", "float64"),
            quality.ColumnRule("c_mktsegment", "string", nullable=False),
            quality.ColumnRule("c_phone", "string"),
        )
    )
    return quality.column_contract(customers_with_gaps(spark, folder), contract)


def table_suite(spark: SparkSession, folder: str) -> DataFrame:
    """A suite with passing and failing checks of every kind."""
    tables = {n: read(spark, folder, n) for n in ("orders", "lineitem", "documents", "labels")}
    tables["customer"] = customers_with_gaps(spark, folder)
    contract = quality.Contract(
        columns=(
            quality.ColumnRule("c_custkey", "int64", nullable=False),
            quality.ColumnRule("c_acctbal", "float"),
            quality.ColumnRule("c_mktsegment", "string", nullable=False),
        ),
        min_rows=10,
        unique_keys=(("c_custkey",),),
    )
    checks = [
        *quality.contract_checks("customer", contract),
        quality.RowCount("orders", 100),
        quality.NullFraction("orders", 0.0),
        quality.DuplicateKeys("orders", ("o_orderkey",)),
        quality.DataType("orders", "o_orderkey", "int64"),
        quality.DataType("orders", "o_comment", "string"),
        quality.DuplicateKeys("lineitem", ("l_orderkey", "l_linenumber")),
        quality.References("lineitem", "orders", "l_orderkey", "o_orderkey"),
        quality.References("orders", "customer", "o_custkey", "c_custkey"),
        quality.References("documents", "labels", "doc_id", "doc_id"),
    ]
    return quality.run_suite(tables, checks)


@query
def q34_quality_report(spark: SparkSession, folder: str) -> DataFrame:
    report = quality.quality_report(table_suite(spark, folder))
    return report.select(
        "total_checks",
        "passed",
        "failed",
        F.round("pass_rate", 8).alias("pass_rate"),
        (F.col("pass_rate") >= 0.6).alias("meets_low_gate"),
        (F.col("pass_rate") >= quality.Standards().min_pass_rate).alias("meets_standard"),
    )


@query
def q42_quality_checks(spark: SparkSession, folder: str) -> DataFrame:
    return _flat_checks(table_suite(spark, folder))


# Run log, profile, layers ----------------------------------------------------------


def runs_from_events(spark: SparkSession, folder: str) -> DataFrame:
    """Run records: the events of a user on a day make one run."""
    step = F.struct(
        F.col("event_type").alias("name"),
        F.col("ts").alias("timestamp"),
        F.create_map(F.lit("value"), F.col("value").cast("string")).alias("details"),
    )
    is_error = F.col("event_type") == "error"
    events = read(spark, folder, "events").withColumn("day", F.to_date("ts"))
    return events.groupBy("user_id", "day").agg(
        F.when(F.count(F.lit(1)) > 2, F.lit("silver")).otherwise(F.lit("bronze")).alias("layer"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("table_name"),
        F.lit("events").alias("source"),
        F.min("ts").alias("start_time"),
        F.when(F.count_if(is_error) > 0, F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        F.count(F.lit(1)).alias("row_count_in"),
        F.count_if(~is_error).alias("row_count_out"),
        F.collect_list(step).alias("transformations"),
        F.max("ts").alias("end_time"),
        F.collect_list(F.when(is_error, F.col("props"))).alias("errors"),
    ).drop("user_id", "day")


@query
def q35_run_report(spark: SparkSession, folder: str) -> DataFrame:
    return runlog.run_report(runs_from_events(spark, folder))


@query
def q43_run_history(spark: SparkSession, folder: str) -> DataFrame:
    runs = runs_from_events(spark, folder)
    found = runlog.run_history(runs, layer="silver").unionByName(
        runlog.run_history(runs, layer="bronze", table_name="user_7")
    )
    return found.select("layer", "table_name", "status", "start_time", "row_count_in", "row_count_out")


@query
def q36_latest_checkpoint(spark: SparkSession, folder: str) -> DataFrame:
    daily = read(spark, folder, "events").groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("fact_table_size"),
        F.count_if(F.col("event_type") == "signup").alias("new_rows_processed"),
    )
    # Every other day repeats the time of the day before, as replays may: the last one stored counts.
    n = F.datediff("day", F.lit("1970-01-01").cast("date")).cast("bigint")
    stored = daily.withColumns({"position": n, "checkpoint_timestamp": F.to_date(F.from_unixtime((n - n % 2) * 86400)).cast("timestamp_ntz")})
    return runlog.latest_checkpoint(stored.drop("day"))


@query
def q38_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.profile(customers_with_gaps(spark, folder))


@query
def q44_profile_lines(spark: SparkSession, folder: str) -> DataFrame:
    return profile.profile(read(spark, folder, "lineitem"))


@query
def q39_latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The last day of a layer table that has a partition per day; only that partition is opened."""
    events = read(spark, folder, "events")
    root = scratch_root(spark)
    days = events.withColumn(layers.BATCH, F.date_format("ts", "yyyyMMdd"))
    days.write.partitionBy(layers.BATCH).parquet(f"{root}/events")
    return layers.read_newest(spark, root, "events", events.schema)


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as they might arrive: odd names, text numbers, gaps, copies."""
    lines = read(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias(" L OrderKey"),
        F.col("l_linenumber").alias("L LineNumber "),
        F.col("l_quantity").cast("string").alias("L Quantity"),
        F.col("l_extendedprice").alias("L ExtendedPrice"),
        F.col("l_discount").alias("L Discount"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("L ReturnFlag"),
    )
    return stamp(lines.unionByName(lines.filter(F.col("L Discount") > 0.05)), EARLIER)


LINE_CLEANING = CleaningConfig(
    type_mapping={"l_quantity": "float", "l_returnflag": "int"},
    remove_outliers=True,
    outlier_columns=("l_extendedprice",),
    z_score_threshold=1.5,
    transformations=(lambda df: df.filter("l_quantity > 5"),),
)


@query
def q40_silver_clean(spark: SparkSession, folder: str) -> DataFrame:
    return silver.clean(raw_lines(spark, folder), LINE_CLEANING, BATCH_TS)


@query
def q41_cleaning_issues(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = silver.process(
        raw_lines(spark, folder), scratch_root(spark), "lines", LINE_CLEANING, BATCH_TS
    )
    return cleaned.issues


@query
def q45_missing_cells(spark: SparkSession, folder: str) -> DataFrame:
    customers = customers_with_gaps(spark, folder)
    return customers.agg(cleaning.count_missing(customers).alias("missing_cells"))


@query
def q46_duplicate_groups(spark: SparkSession, folder: str) -> DataFrame:
    groups = quality.rows_in_duplicate_groups(read(spark, folder, "lineitem"), ("l_orderkey", "l_linenumber"))
    return groups.withColumnRenamed("__copies", "copies")


@query
def q47_orphan_keys(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.orphans(
        read(spark, folder, "documents"), read(spark, folder, "labels"), "doc_id", "doc_id"
    )
    return found.withColumnRenamed("__key", "doc_id")


@query
def q48_dense_keys(spark: SparkSession, folder: str) -> DataFrame:
    events = read(spark, folder, "events").select("event_id", "ts", "user_id")
    return dense_keys(events, "event_key", ["user_id", "ts"], offset=1000)


# Files -----------------------------------------------------------------------------


@query
def q50_csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with line breaks, quotes and commas, written as CSV by another writer and scanned."""
    docs = read(spark, folder, "documents").select(
        "doc_id", F.concat(F.lit('"quoted", '), "text", F.lit("\n,end")).alias("text"), "lang", "n_chars"
    )
    path = f"{scratch_root(spark)}/documents.csv"
    docs.write.options(header=True, escape='"').csv(path)
    return ingest.as_frame(spark, path, docs.schema, options={"multiLine": True})


@query
def q53_layer_formats(spark: SparkSession, folder: str) -> DataFrame:
    """Nulls, empty texts, line breaks and backslashes come back from every format."""
    orders = read(spark, folder, "orders").select(
        "o_orderkey",
        "o_orderdate",
        "o_totalprice",
        F.when(F.col("o_orderkey") % 5 == 0, F.lit(""))
        .when(F.col("o_orderkey") % 5 == 1, F.lit("\\N"))
        .when(F.col("o_orderkey") % 5 == 2, F.concat(F.lit(' "a\n\\'), "o_orderpriority", F.lit('", ')))
        .when(F.col("o_orderkey") % 5 == 3, F.col("o_orderstatus")).alias("note"),
    )
    root = scratch_root(spark)
    found = []
    for fmt in layers.FORMATS:
        layers.write_layer(orders, root, fmt, BATCH_TS, fmt)
        found.append(layers.read_layer(spark, root, fmt, orders.schema, fmt, BATCH_TS).withColumn("fmt", F.lit(fmt)))
    return reduce(DataFrame.unionByName, found)


@query
def q52_layer_types(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches of a clean table: one has gaps and odd texts, the other does not; both are read as one table."""
    root = scratch_root(spark)
    customers = read(spark, folder, "customer").select("c_custkey", "c_nationkey", F.col("c_acctbal").cast("string").alias("c_acctbal"))
    odd = customers.withColumns(
        {"c_nationkey": F.nullif("c_nationkey", F.lit(7)), "c_acctbal": F.when(F.col("c_custkey") % 10 == 0, "none").otherwise(F.col("c_acctbal"))}
    )
    config = CleaningConfig(
        missing_strategy="fillna_mean", missing_subset=("c_nationkey",), type_mapping={"c_acctbal": "float"}, on_misfit="sibling"
    )
    for batch_ts, batch in ((EARLIER, customers), (BATCH_TS, odd)):
        silver.process(batch, root, "customer", config, batch_ts)
    layer = layers.read_layer(spark, root, "customer_cleaned")
    return layer.select("c_custkey", F.round("c_nationkey", 4).alias("c_nationkey"), "c_acctbal", "c_acctbal_text", "_processing_timestamp")


@query
def q65_bucketed_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """The star rollup from facts and customers that are stored in buckets of the customer key."""
    sources = sales_sources(spark, folder)
    dims = build_dimensions(sources, sales.STAR, BATCH_TS)
    root, key = scratch_root(spark), sales.STAR.dimension("dim_customer").key
    bound = facts.bind_fact(sources[sales.LINES], dims, sales.STAR, BATCH_TS)
    fact = buckets.write_bucketed(bound, f"{root}/fact", key, 8)
    dims["dim_customer"] = buckets.write_bucketed(dims["dim_customer"], f"{root}/dim_customer", key, 8)
    return facts.star_rollup(
        fact,
        dims,
        sales.STAR,
        by={"dim_customer": ["c_mktsegment"], "dim_period": ["order_year"]},
        averages=["l_quantity", "l_extendedprice"],
        sums=["returned_flag"],
        digits=4,
        fold_first=["dim_customer"],
    )
