"""Wall times of the headline queries and of the raw-to-warehouse load; one JSON line on stdout."""

from __future__ import annotations

import contextlib
import json
import os
import sys
import tempfile
import time
from datetime import datetime
from functools import partial
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from starloom.operators.quality import quality_report, run_suite  # noqa: E402
from starloom.plans import athlete_results as results  # noqa: E402
from starloom.operators.concurrent import side_by_side  # noqa: E402
from starloom.plans.silver import process  # noqa: E402
from starloom.plans.specs import CleaningConfig  # noqa: E402
from starloom.plans.star import load_star, read_star  # noqa: E402
from starloom.queries import QUERIES  # noqa: E402
from starloom.session import local_session  # noqa: E402
from starloom.sources.ingest import ingest  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "q05_fill_mean",
    "q06_forward_fill",
    "q08_outliers_sequential",
    "q09_dedup_whole_row",
    "q10_dedup_keep_first",
    "q11_dim_keep_last",
    "q12_dim_distinct",
    "q15_fact_build",
    "q16_scd1_upsert",
    "q17_dim_scd1_merge",
    "q18_scd2_upsert",
    "q19_scd2_repeated_keys",
    "q20_dim_scd2_merge",
    "q21_type0_merge",
    "q26_fact_append",
    "q34_quality_report",
    "q37_star_rollup",
    "q40_silver_clean",
    "q44_profile_lines",
    "q48_dense_keys",
)
# Rows of the logged run's region table.
REGION_ROWS = 230


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def raw_files(spark: SparkSession, folder: str) -> tuple[str, str]:
    """CSV files shaped like the sports tables, made from the order lines (not timed)."""
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet")
    # A rule on the key, so that the rows are the same in every run: 9 of 20 orders are about
    joined = lines.where("l_orderkey % 20 < 9").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    year = F.year("o_orderdate")
    raw = joined.select(
        F.col("o_custkey").alias("ID"),
        F.concat(F.lit("Name, "), "o_custkey").alias("Name"),
        F.when(F.col("l_linestatus") == "O", "M").otherwise("F").alias("Sex"),
        (F.col("l_quantity") + 15).alias("Age"),
        F.when(F.col("l_tax") > 0.01, F.round(150 + F.col("l_discount") * 400)).alias("Height"),
        F.when(F.col("l_tax") > 0.02, F.round(50 + F.col("l_discount") * 500)).alias("Weight"),
        F.concat(F.lit("Team "), F.col("o_custkey") % 200).alias("Team"),
        F.concat(F.lit("N"), F.col("o_custkey") % REGION_ROWS).alias("NOC"),
        F.concat(year, F.lit(" "), F.when(F.col("o_orderstatus") == "O", "Summer").otherwise("Winter")).alias("Games"),
        year.alias("Year"),
        F.when(F.col("o_orderstatus") == "O", "Summer").otherwise("Winter").alias("Season"),
        F.concat(F.lit("City "), year).alias("City"),
        F.concat(F.lit("Sport "), F.col("l_partkey") % 40).alias("Sport"),
        F.concat(F.lit("Event "), F.col("l_partkey") % 600).alias("Event"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 20), F.lit("Gold")).alias("Medal"),
    )
    regions = spark.range(REGION_ROWS).select(
        F.concat(F.lit("N"), "id").alias("NOC"),
        F.concat(F.lit("Region "), "id").alias("region"),
        F.when(F.col("id") < 120, F.concat(F.lit("note "), "id")).alias("notes"),
    )
    paths = []
    for name, df in (("athletes", raw), ("regions", regions)):
        df.coalesce(1).write.option("header", True).option("nullValue", "NA").csv(f"{folder}/{name}")
        paths.append(f"{folder}/{name}")
    return paths[0], paths[1]


def load_times(spark: SparkSession) -> dict[str, float]:
    folder = tempfile.mkdtemp(prefix="starloom-bench-")
    athletes, regions = raw_files(spark, folder)
    times: dict[str, float] = {}

    @contextlib.contextmanager
    def timed(name: str):
        start = time.perf_counter()
        yield
        times[name] = round(time.perf_counter() - start, 3)

    first, second = datetime(2024, 1, 1), datetime(2024, 1, 2)
    with timed("load_bronze"):
        given = {
            results.ATHLETES: (athletes, results.ATHLETES_CONTRACT),
            results.REGIONS: (regions, results.REGIONS_CONTRACT),
        }
        steps = {
            table: partial(
                ingest, spark, path, f"{folder}/bronze", table, first,
                schema=contract.schema(), record_order=True,
            )
            for table, (path, contract) in given.items()
        }
        raw = side_by_side(spark, steps)
    with timed("load_silver"):
        configs = {results.ATHLETES: results.CLEANING, results.REGIONS: CleaningConfig()}
        steps = {
            table: partial(process, raw[table], f"{folder}/silver", table, config, first)
            for table, config in configs.items()
        }
        clean = {table: done.table for table, done in side_by_side(spark, steps).items()}
    with timed("load_gold_full"):
        load_star(clean, results.STAR, f"{folder}/gold", first)
    with timed("load_gold_incremental"):
        load_star(clean, results.STAR, f"{folder}/gold", second)
    with timed("load_quality_suite"):
        tables = read_star(spark, results.STAR, f"{folder}/gold")
        quality_report(run_suite(tables, results.warehouse_checks())).collect()
    return times


def main() -> None:
    cores = CPUS if CPUS == "*" else int(CPUS)
    spark = local_session(cores, app="starloom-bench")
    drain(spark.read.parquet(f"{FOLDER}/lineitem.parquet").groupBy("l_returnflag").count())
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        drain(QUERIES[name](spark, FOLDER))
        times[name] = round(time.perf_counter() - start, 3)
    times |= load_times(spark)
    spark.stop()
    result = {
        "metric": "total wall time of the headline queries and the load",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(FOLDER).name.removeprefix("sf"),
    }
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
