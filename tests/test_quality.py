from datetime import datetime

from pyspark.sql import functions as F

from starloom.operators import quality, runlog
from starloom.operators.quality import (
    ColumnRule,
    Contract,
    DataType,
    DuplicateKeys,
    NullFraction,
    References,
    RowCount,
)


def by_position(checks):
    return {r.position: r for r in checks.collect()}


def test_row_count_is_strict(spark):
    tables = {"t": spark.range(5)}
    found = by_position(quality.run_suite(tables, [RowCount("t", 5), RowCount("t", 4), RowCount("t")]))
    assert [found[i].passed for i in (1, 2, 3)] == [False, True, True]
    assert found[1].messages == ["t: 5 rows, more than 5 needed"]


def test_null_fraction_edges(spark):
    df = spark.createDataFrame([(None, 1.0), (1, float("nan")), (2, None), (3, 1.0), (4, 1.0)], "a int, b double")
    tables = {"t": df, "none": df.filter("a > 99")}
    checks = [
        NullFraction("t", 0.4),
        NullFraction("t", 0.39),
        NullFraction("none", 0.0),
        NullFraction("t", by_column={"a": 0.1, "b": 0.5}),
    ]
    found = by_position(quality.run_suite(tables, checks))
    assert [found[i].passed for i in (1, 2, 3, 4)] == [True, False, True, False]
    assert found[2].violating_columns == {"b": 0.4}
    assert found[4].messages == ["t.a: 20.0% missing, at most 10.0%"]


def test_duplicate_keys_counts_all_members_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, None), (2, "a"), (2, "b")], "k int, v string")
    found = by_position(quality.run_suite({"t": df}, [DuplicateKeys("t", ("k", "v")), DuplicateKeys("t", ("k",), where="k = 3")]))
    assert (found[1].duplicate_count, found[1].passed) == (3, False)
    assert (found[2].duplicate_count, found[2].passed) == (0, True)


def test_references_ignore_null_and_count_distinct(spark):
    fact = spark.createDataFrame([(1,), (2,), (None,), (9,), (9,)], "fk int")
    dim = spark.createDataFrame([(1,), (2,)], "pk bigint")
    found = quality.run_suite({"f": fact, "d": dim}, [References("f", "d", "fk", "pk")]).first()
    assert (found.missing_keys, found.passed) == (1, False)


def test_types_and_report_counts(spark):
    df = spark.createDataFrame([(1, "x", 1.0, True, datetime(2024, 1, 1))], "a bigint, b string, c double, d boolean, e timestamp_ntz")
    expected = {"a": "int64", "b": "object", "c": "float64", "d": "bool", "e": "datetime64[ns]"}
    checks = [DataType("t", c, t) for c, t in expected.items()] + [DataType("t", "a", "string"), DataType("t", "gone", "int64")]
    suite = quality.run_suite({"t": df}, checks)
    report = quality.quality_report(suite).first()
    assert (report.total_checks, report.passed, report.failed) == (6, 5, 2)
    assert report.failures == ["t.a: bigint, expected string", "t: no column gone"]
    assert quality.meets_gate(suite, 5 / 6) and not quality.meets_gate(suite, 0.84)


def test_empty_report_has_rate_zero(spark):
    none = spark.createDataFrame([], quality.REPORT_SCHEMA)
    assert quality.quality_report(none).first().pass_rate == 0


def test_report_file(spark, tmp_path):
    df = spark.createDataFrame([(None,), (1,)], "a int")
    suite = quality.run_suite({"t": df}, [NullFraction("t"), DuplicateKeys("t", ("a",)), DataType("t", "b", "int")])
    quality.write_quality_report(suite, str(tmp_path / "report"))
    written = spark.read.option("header", True).csv(str(tmp_path / "report")).collect()
    assert [r.check for r in written] == ["null_percentage", "duplicate_keys"]
    assert written[0].violating_columns == '{"a":0.5}' and written[1].key_columns == "a"


def test_contract(spark):
    contract = Contract(
        columns=(ColumnRule("a", "int64", nullable=False), ColumnRule("b", "float"), ColumnRule("c", "string")),
        min_rows=1,
        max_null_by_column={"b": 0.5},
        unique_keys=(("a",),),
        references=(("a", "d", "a"),),
    )
    assert [f.dataType.simpleString() for f in contract.schema()] == ["bigint", "double", "string"]
    df = spark.createDataFrame([(1, None, "x"), (2, 1.0, None)], "a bigint, b double, c string")
    found = by_position(quality.run_suite({"t": df, "d": df}, quality.contract_checks("t", contract)))
    assert [found[i].passed for i in sorted(found)] == [True, False, True, True, True, True, True]
    assert list(found[2].violating_columns) == ["c"]


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert runlog.read_runs(spark, path).isEmpty()
    ticks = iter(datetime(2024, 1, 1, 0, 0, s) for s in range(60))
    with runlog.logged_run(spark, path, "bronze", "a", "file", lambda: next(ticks)) as run:
        run.transformation("read", {"tables": 2})
        run.row_count_out = 7
    try:
        with runlog.logged_run(spark, path, "silver", "a", None, lambda: next(ticks)):
            raise KeyError("gone")
    except KeyError:
        pass
    open_run = runlog.Run("gold", "b", None, lambda: next(ticks))
    runlog.append_run(spark, path, open_run, next(ticks), None, "running")
    runs = runlog.read_runs(spark, path)
    report = {r.layer: r for r in runlog.run_report(runs).collect()}
    assert (report["bronze"].rows_out, report["bronze"].transformations, report["bronze"].errors) == (7, 1, 0)
    assert (report["silver"].status, report["silver"].errors) == ("failed", 1)
    assert (report["gold"].status, report["gold"].end_time) == ("running", None)
    assert runlog.run_history(runs, table_name="a").count() == 2
    assert runlog.run_history(runs, "silver", "a").first().errors == ["'gone'"]
    runlog.write_run_report(runs, str(tmp_path / "report"))
    assert spark.read.option("header", True).csv(str(tmp_path / "report")).count() == 3


def test_checkpoints(spark, tmp_path):
    path = str(tmp_path / "checkpoints")
    assert runlog.latest_checkpoint(runlog.read_checkpoints(spark, path)).isEmpty()
    runlog.store_checkpoint(spark, path, 430, 430, datetime(2024, 1, 1))
    runlog.store_checkpoint(spark, path, 435, 5, datetime(2024, 1, 2))
    latest = runlog.latest_checkpoint(runlog.read_checkpoints(spark, path)).first()
    assert tuple(latest)[:3] == (435, 5, datetime(2024, 1, 2))


def test_suite_reads_each_table_once_for_its_scalar_checks(spark, tmp_path):
    spark.range(10).withColumn("v", F.lit(1)).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    measures = quality._scalar_measures(df, [(1, RowCount("t")), (2, NullFraction("t"))])
    assert measures._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    suite = quality.run_suite({"t": df}, [RowCount("t"), NullFraction("t"), DataType("t", "id", "int64")])
    assert "FileScan" not in suite._jdf.queryExecution().executedPlan().toString()
    assert quality.meets_gate(suite, 1.0)
