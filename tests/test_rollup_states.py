"""Rollups from the states of batches against rollups from scratch, while a dimension changes."""

import random

from pyspark.sql import functions as F

from starloom.operators import facts
from starloom.plans.specs import DimensionSpec, FactSpec, StarSpec

STAR = StarSpec(
    dimensions=(
        DimensionSpec(name="d", source="s", key="dk", natural_keys=("a",), attributes=("colour",), scd=1),
        DimensionSpec(name="e", source="s", key="ek", natural_keys=("b",), scd=0),
    ),
    fact=FactSpec(name="f", source="s", key="k", dimensions=("d", "e"), measures=("x", "y")),
)
BY = {"d": ["colour"], "e": ["b"]}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_states_add_up(spark):
    draw = random.Random(1)
    dim_d = spark.createDataFrame([(i, draw.choice([None, "red", "blue"])) for i in range(12)], "dk bigint, colour string")
    dims = {"d": dim_d, "e": spark.createDataFrame([(i, f"b{i % 2}") for i in range(4)], "ek bigint, b string")}
    whole, states = None, None
    for n in (50, 0, 7, 300):
        values = [(draw.randrange(14), draw.randrange(5), draw.choice([None, 1.0, 2.5, float("nan")]), draw.choice([None, 1, 2])) for _ in range(n)]
        part = spark.createDataFrame(values, "dk bigint, ek bigint, x double, y bigint")
        state = facts.rollup_state(part, STAR, list(BY), ["x", "y"], ["y"])
        whole, states = (part, state) if whole is None else (whole.unionByName(part), states.unionByName(state))
        # A change of type 1 moves what was there already.
        dims["d"] = dims["d"].withColumn("colour", F.when(F.col("dk") % 3 == n % 3, F.lit("green")).otherwise(F.col("colour")))
        found = facts.rollup_from_states(states, dims, STAR, BY, ["x", "y"], ["y"], digits=6)
        assert rows(found) == rows(facts.star_rollup(whole, dims, STAR, BY, ["x", "y"], ["y"], digits=6))
    assert rows(facts.rollup_from_states(states, dims, STAR, {"d": ["colour"], "e": []}, ["x", "y"], ["y"], digits=6))
