import math
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import cleaning
from starloom.operators.keys import dense_keys, max_key, next_key


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def test_names_are_lowered_trimmed_and_joined(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" Name Of", "A\tB ", "x"])
    assert cleaning.standardize_column_names(df).columns == ["name_of", "a\tb", "x"]


def test_clashing_names_are_refused(spark):
    with pytest.raises(ValueError, match="clash"):
        cleaning.standardize_column_names(spark.createDataFrame([(1, 2)], ["A b", "a_b"]))


def test_duplicates_keep_first_and_last(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "b", 2), (2, None, 3)], ["id", "v", "seq"])
    assert rows(cleaning.remove_duplicates(df)) == [(1, "a", 1), (1, "b", 2), (2, None, 3)]
    assert rows(cleaning.remove_duplicates(df, ["id"], ["seq"])) == [(1, "a", 1), (2, None, 3)]
    assert rows(cleaning.keep_last(df, ["id"], ["seq"])) == [(1, "b", 2), (2, None, 3)]


def test_batch_metadata_does_not_hide_copies(spark):
    df = spark.createDataFrame([(1, "a", 20), (1, "a", 10), (2, "a", 10)], ["id", "v", "_batch_id"])
    assert rows(cleaning.remove_duplicates(df)) == [(1, "a", 10), (2, "a", 10)]


def test_keep_one_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id", "id % 3 AS k")
    plan = cleaning.keep_last(df, ["k"], ["id"])._jdf.queryExecution().toString()
    assert "Partial" in plan.split("WindowGroupLimit", 1)[1]


def missing_mix(spark):
    data = [(float("nan"), "x", None, None), (1.0, None, 2, None), (3.0, "y", 3, None)]
    return spark.createDataFrame(data, "a double, b string, c bigint, d double")


def test_missing_counts_null_and_nan(spark):
    df = missing_mix(spark)
    assert df.agg(cleaning.count_missing(df)).first()[0] == 6


def test_drop_any_and_subset(spark):
    df = missing_mix(spark)
    assert cleaning.handle_missing_values(df).count() == 0
    assert rows(cleaning.handle_missing_values(df, subset=["a", "b"]), "a") == [(3.0,)]


def test_dropping_is_pushed_to_the_scan_of_a_wide_table(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(5).selectExpr("id", *[f"id AS `C {i}`" for i in range(40)], "1 AS _b").write.parquet(path)
    wide = cleaning.standardize_column_names(spark.read.parquet(path))
    for cleaned in (
        cleaning.remove_duplicates(cleaning.drop_missing(wide)),
        cleaning.drop_missing(cleaning.remove_duplicates(wide.drop("_b"))),
    ):
        assert "IsNotNull(id)" in cleaned._jdf.queryExecution().executedPlan().toString()


def test_fill_mean_skips_missing_and_all_missing_columns(spark):
    df = missing_mix(spark).withColumns({"e": F.lit(1), "_m": F.lit(None).cast("int")})
    done = cleaning.handle_missing_values(df, "fillna_mean")
    assert dict(done.dtypes)["e"] == "int" and dict(done.dtypes)["_m"] == "int"
    filled = rows(done, "a", "c", "d")
    assert filled == [(1.0, 2.0, None), (2.0, 2.5, None), (3.0, 3.0, None)]


def test_fill_value_and_unknown_strategy(spark):
    df = missing_mix(spark)
    assert rows(cleaning.handle_missing_values(df, "fillna_value", value={"c": 9}), "c") == [(2,), (3,), (9,)]
    with pytest.raises(ValueError, match="unknown strategy"):
        cleaning.handle_missing_values(df, "fillna_backward")
    with pytest.raises(ValueError, match="order_by"):
        cleaning.handle_missing_values(df, "fillna_forward")


@pytest.mark.parametrize("groups", [(), ("g",)])
def test_forward_fill_with_a_hot_group(spark, groups):
    draw = random.Random(3)
    data = []
    for i in range(3000):
        group = 0 if draw.random() < 0.6 else draw.choice([None, *range(1, 40)])
        value = draw.choice([None, None, None, float("nan"), float(i)])
        data.append((i, group, value, draw.choice([None, str(i)])))
    draw.shuffle(data)
    df = spark.createDataFrame(data, "i int, g int, v double, s string").repartition(6)
    got = {r.i: (r.v, r.s) for r in cleaning.fill_forward(df, ["i"], groups, ["v", "s"]).collect()}
    last, expected = {}, {}
    for i, g, v, s in sorted(data, key=lambda r: r[0]):
        old_v, old_s = last.get(g if groups else 0, (None, None))
        v = old_v if v is None or math.isnan(v) else v
        last[g if groups else 0] = expected[i] = (v, old_s if s is None else s)
    assert got == expected


def test_types_are_coerced_all_or_nothing(spark):
    df = spark.createDataFrame(
        [("1", "1", 3.7, "2.5"), ("2", "x", 1.0, None), (None, "3", None, "7")],
        "good string, bad string, frac double, num string",
    )
    mapping = {"good": "int", "bad": "int", "frac": "int", "num": "float", "absent": "int"}
    coerced, failed = cleaning.coerce_types(df, mapping)
    assert failed == ["bad"]
    assert [t for _, t in coerced.dtypes] == ["bigint", "string", "bigint", "double"]
    assert rows(coerced) == [(1, "1", 3, 2.5), (2, "x", 1, None), (None, "3", None, 7.0)]


def test_outliers_constant_single_and_missing(spark):
    constant = spark.createDataFrame([(1, 5.0), (2, 5.0)], "k bigint, v double")
    assert cleaning.remove_outliers(constant, ["v"]).count() == 0
    assert cleaning.remove_outliers(constant.limit(1), ["v"]).count() == 0
    stamped = spark.createDataFrame([(1.0, 1), (2.0, 1), (3.0, 1)], "v double, _source_row int")
    assert cleaning.remove_outliers(stamped).count() == 3
    # A user's own column counts, whatever its name starts with: this one is constant.
    assert cleaning.remove_outliers(stamped.withColumnRenamed("_source_row", "_m")).count() == 0
    some = spark.createDataFrame([(float(i),) for i in range(20)] + [(None,), (1e6,), (float("nan"),)], "v double")
    assert rows(cleaning.remove_outliers(some)) == sorted(((float(i),) for i in range(20)), key=repr)


def test_outliers_use_what_earlier_columns_left(spark):
    data = [(float(i % 5), float(i % 7)) for i in range(60)] + [(500.0, 900.0), (2.0, 90.0)]
    df = spark.createDataFrame(data, "a double, b double")

    def kept(values, place):
        xs = [v[place] for v in values]
        mean = sum(xs) / len(xs)
        sd = math.sqrt(sum((x - mean) ** 2 for x in xs) / (len(xs) - 1))
        return [v for v in values if abs((v[place] - mean) / sd) < 3]

    assert rows(cleaning.remove_outliers(df)) == sorted(kept(kept(data, 0), 1), key=repr)


def test_dense_keys_follow_the_order(spark):
    df = spark.createDataFrame([(i * 7919 % 1000, None if i == 5 else "x") for i in range(1000)], "n int, s string")
    keyed = dense_keys(df.repartition(8), "key", ["s", "n"], offset=10).collect()
    by_key = sorted(keyed, key=lambda r: r.key)
    assert [r.key for r in by_key] == list(range(11, 1011))
    assert [r.n for r in by_key][1:] == sorted(r.n for r in keyed if r.s)
    assert by_key[0].s is None


def test_dense_keys_without_order_and_for_no_rows(spark):
    df = spark.range(0, 777, 1, 5).withColumnRenamed("id", "n")
    assert sorted(r.key for r in dense_keys(df, "key").collect()) == list(range(1, 778))
    empty = dense_keys(df.filter("n < 0"), "key", ["n"])
    assert empty.columns == ["key", "n"] and empty.count() == 0
    assert (max_key(empty, "key"), next_key(empty, "key")) == (0, 1)
