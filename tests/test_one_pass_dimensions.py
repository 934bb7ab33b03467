"""Dimensions folded in one pass over their source against each dimension by itself."""

import random
from datetime import datetime

from starloom.operators import dimensions
from starloom.plans.specs import DimensionSpec, FactSpec, StarSpec
from starloom.plans.star import build_dimensions, rows_of_dimensions

NOW = datetime(2024, 1, 1)
SPECS = (
    DimensionSpec(name="d0", source="s", key="k0", natural_keys=("a", "b"), scd=0),
    DimensionSpec(name="d1", source="s", key="k1", natural_keys=("a",), attributes=("c", "odd name"), scd=1, order_by=("n",)),
    DimensionSpec(name="d2", source="s", key="k2", natural_keys=("b", "c"), attributes=("a",), scd=2, order_by=("n", "odd name")),
    DimensionSpec(name="d3", source="s", key="k3", natural_keys=("odd name",), scd=0),
)
SCHEMA = "a bigint, b string, c double, `odd name` string, n bigint, unused string"


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def made(spark, n, seed=1):
    draw = random.Random(seed)
    nan = float("nan")
    values = [(draw.choice([None, 1, 2, 3]), draw.choice([None, "", "x", "y"]), draw.choice([None, nan, 0.5, 1.5]), draw.choice([None, "p", "q"]), draw.choice([None, 1, 2]), "u") for _ in range(n)]
    return spark.createDataFrame(values, SCHEMA).repartition(3)


def test_fold_gives_the_rows_of_each_dimension(spark):
    for n in (0, 1, 40, 400):
        source = made(spark, n, n)
        found = dimensions.rows_from_fold(dimensions.folded_rows(source, SPECS), SPECS)
        for spec in SPECS:
            plain = dimensions.dimension_rows(source, spec)
            assert found[spec.name].columns == plain.columns
            assert found[spec.name].dtypes == plain.dtypes
            assert rows(found[spec.name]) == rows(plain)


def test_one_scan_and_one_shuffle(spark, tmp_path):
    made(spark, 50).write.parquet(str(tmp_path / "s"))
    source = spark.read.parquet(str(tmp_path / "s"))
    plan = dimensions.folded_rows(source, SPECS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange") == 1
    assert "unused" not in plan


def test_dimensions_of_a_star(spark):
    fact = FactSpec(name="f", source="s", key="id", dimensions=("d0",), measures=("n",))
    source = made(spark, 300)
    star = StarSpec(dimensions=SPECS, fact=fact)
    assert set(rows_of_dimensions({"s": source}, star)) == {"d0", "d1", "d2", "d3"}
    built = build_dimensions({"s": source}, star, NOW)
    for spec in SPECS:
        assert rows(built[spec.name]) == rows(dimensions.build_dimension(source, spec, NOW))
    single = StarSpec(dimensions=SPECS[:1], fact=fact)
    assert rows_of_dimensions({"s": source}, single) == {}
