import random
from datetime import datetime

import pytest

from starloom.functions.columns import OPEN_END
from starloom.operators import dimensions, scd
from starloom.plans.specs import DimensionSpec

OLD, NOW = datetime(2020, 1, 1), datetime(2024, 1, 1)
VERSIONED = "k string, v string, effective_date timestamp_ntz, end_date timestamp_ntz, is_current boolean"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def test_scd1_replaces_and_keeps(spark):
    existing = spark.createDataFrame([(1, "Alice", "USA"), (2, "Bob", "UK")], ["athlete_id", "name", "team"])
    new = spark.createDataFrame([(1, "Alice Updated", "USA Updated")], ["athlete_id", "name", "team"])
    assert rows(scd.scd1_upsert(existing, new, "athlete_id")) == [
        (1, "Alice Updated", "USA Updated"),
        (2, "Bob", "UK"),
    ]


def test_scd1_missing_keys_match_and_missing_columns_are_null(spark):
    existing = spark.createDataFrame([(None, "a", 1), (2, "b", 2)], "k int, v string, w int")
    new = spark.createDataFrame([(None, "x"), (3, "y"), (3, "z")], "k int, v string")
    assert rows(scd.scd1_upsert(existing, new, "k")) == [(2, "b", 2), (3, "y", None), (3, "z", None), (None, "x", None)]


def test_scd2_closes_and_opens(spark):
    existing = spark.createDataFrame(
        [("USA", "United States", OLD, OPEN_END, True), ("CHN", "China", OLD, OPEN_END, True)], VERSIONED
    )
    new = spark.createDataFrame([("CHN", "People's Republic of China")], "k string, v string")
    assert rows(scd.scd2_upsert(existing, new, "k", ["v"], NOW)) == sorted([
        ("CHN", "China", OLD, NOW, False),
        ("CHN", "People's Republic of China", NOW, OPEN_END, True),
        ("USA", "United States", OLD, OPEN_END, True),
    ], key=repr)


def test_scd2_untracked_and_absent_columns(spark):
    existing = spark.createDataFrame([("a", "1", OLD, OPEN_END, True)], VERSIONED)
    new = spark.createDataFrame([("a", 1, "note")], "k string, v int, extra string")
    merged = scd.scd2_upsert(existing, new, "k", ["v", "nowhere"], NOW)
    assert rows(merged, "k", "v", "is_current") == [("a", "1", True)]
    assert "extra" in merged.columns


def test_scd2_guards(spark):
    lacking = spark.createDataFrame([("a", "1")], "k string, v string")
    with pytest.raises(ValueError, match="lacks"):
        scd.scd2_upsert(lacking, lacking, "k", ["v"], NOW)
    twice = spark.createDataFrame([("a", "1", OLD, OPEN_END, True)] * 2, VERSIONED)
    with pytest.raises(ValueError, match="more than one open version"):
        scd.scd2_upsert(twice, lacking, "k", ["v"], NOW)


def loop(existing, batch):
    """The row-by-row rule: later rows see the open version until it is closed."""
    result = [list(r) for r in existing]
    added = []
    for key, value, _ in batch:
        current = [r for r in result if key is not None and r[0] == key and r[4]]
        if not current:
            added.append((key, value, NOW, OPEN_END, True))
        elif current[0][1] != value:
            current[0][3:5] = [NOW, False]
            added.append((key, value, NOW, OPEN_END, True))
    return sorted([tuple(r) for r in result] + added, key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_scd2_repeated_keys_as_the_loop(spark, seed):
    draw = random.Random(seed)
    existing = [(f"k{i}", draw.choice(["x", "y", None]), OLD, OPEN_END, True) for i in range(6)]
    existing += [("k0", "old", OLD, NOW, False), ("k8", "gone", OLD, NOW, False)]
    batch = [
        (draw.choice(["k0", "k0", "k0", "k1", "k2", "k7", "k8", None]), draw.choice(["x", "y", None]), i)
        for i in range(40)
    ]
    merged = scd.scd2_upsert(
        spark.createDataFrame(existing, VERSIONED),
        spark.createDataFrame(batch, "k string, v string, seq int").repartition(5),
        "k",
        ["v"],
        NOW,
        order_by=["seq"],
        chain=False,
    )
    assert rows(merged) == loop(existing, batch)
    # Chained, the same versions are there, one of a key is open, and the next batch is taken.
    chained = scd.scd2_upsert(
        spark.createDataFrame(existing, VERSIONED), spark.createDataFrame(batch, "k string, v string, seq int"), "k", ["v"], NOW, order_by=["seq"]
    )
    assert rows(chained.select("k", "v")) == rows(merged.select("k", "v"))
    again = scd.scd2_upsert(chained, spark.createDataFrame([("k0", "z")], "k string, v string"), "k", ["v"], NOW)
    assert again.where("k = 'k0' AND is_current").select("v").collect() == [("z",)]


def test_current_history_and_structure(spark):
    dim = spark.createDataFrame(
        [("a", "2", NOW, OPEN_END, True), ("a", "1", OLD, NOW, False), ("a", "0", None, OLD, False), ("b", "1", OLD, OPEN_END, True)],
        VERSIONED,
    )
    assert rows(scd.current_records(dim), "k", "v") == [("a", "2"), ("b", "1")]
    assert [r.v for r in scd.history(dim, "k", "a").collect()] == ["1", "2", "0"]
    assert scd.has_valid_structure(dim, "k")
    assert not scd.has_valid_structure(dim, "absent")
    no_end = spark.createDataFrame([("a", "1", OLD, None, True)], VERSIONED)
    assert not scd.has_valid_structure(no_end, "k")


PERSON = DimensionSpec("dim_person", "s", "person_key", ("id",), 1, ("name",), ("seq",))
PLACE = DimensionSpec("dim_place", "s", "place_key", ("code",), 2, ("region",), ("seq",))
KIND = DimensionSpec("dim_kind", "s", "kind_key", ("a", "b"), 0)


def test_dimension_build_keeps_last_and_drops_missing_keys(spark):
    source = spark.createDataFrame([(2, "b", 1), (1, "x", 1), (1, "y", 2), (None, "n", 3)], "id int, name string, seq int")
    dim = dimensions.build_dimension(source, PERSON, OLD)
    assert dim.columns == ["person_key", "id", "name", "dw_insert_date", "dw_update_date"]
    assert rows(dim) == [(1, 1, "y", OLD, OLD), (2, 2, "b", OLD, OLD)]


@pytest.mark.parametrize("touch", [True, False])
def test_scd1_merge_keeps_keys_and_overwrites_with_null(spark, touch):
    source = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 1)], "id int, name string, seq int")
    existing = dimensions.build_dimension(source, PERSON, OLD)
    batch = spark.createDataFrame([(5, "e", 1), (2, None, 1), (4, "d", 1), (3, "c", 1)], "id int, name string, seq int")
    merged = dimensions.merge_dimension(existing, batch, PERSON, NOW, touch_unchanged=touch)
    assert rows(merged) == sorted([
        (1, 1, "a", OLD, OLD),
        (2, 2, None, OLD, NOW),
        (3, 3, "c", OLD, NOW if touch else OLD),
        (4, 4, "d", NOW, NOW),
        (5, 5, "e", NOW, NOW),
    ], key=repr)


def test_scd2_merge_numbers_new_versions(spark):
    schema = "code string, region string, seq int"
    existing = dimensions.build_dimension(
        spark.createDataFrame([("A", "a", 1), ("B", "b", 1), ("C", None, 1)], schema), PLACE, OLD
    )
    batch = spark.createDataFrame([("A", "a", 1), ("B", "b2", 1), ("C", None, 1), ("D", "d", 1)], schema)
    merged = dimensions.merge_dimension(existing, batch, PLACE, NOW)
    assert rows(merged, "place_key", "code", "region", "effective_date", "end_date", "is_current") == sorted([
        (1, "A", "a", OLD, OPEN_END, True),
        (2, "B", "b", OLD, NOW, False),
        (3, "C", None, OLD, OPEN_END, True),
        (4, "B", "b2", NOW, OPEN_END, True),
        (5, "D", "d", NOW, OPEN_END, True),
    ], key=repr)
    scd.require_single_current(merged, ["code"])
    again = dimensions.merge_dimension(merged, batch, PLACE, datetime(2025, 1, 1))
    assert rows(again) == rows(merged)


def test_type0_merge_gives_each_new_row_its_key(spark):
    schema = "a string, b string"
    existing = dimensions.build_dimension(spark.createDataFrame([("x", None), ("x", "1")], schema), KIND, OLD)
    batch = spark.createDataFrame([("x", None), ("y", "1"), ("y", None), ("z", "1"), ("z", "1")], schema)
    merged = dimensions.merge_dimension(existing, batch, KIND, NOW)
    assert rows(merged, "kind_key", "a", "b") == sorted([
        (1, "x", None), (2, "x", "1"), (3, "y", None), (4, "y", "1"), (5, "z", "1")
    ], key=repr)


@pytest.mark.parametrize("spec", [PERSON, PLACE, KIND])
def test_merging_into_an_empty_dimension_is_a_build(spark, spec):
    source = spark.createDataFrame(
        [(1, "n", "c", "r", "a", "b", 1), (2, "m", "d", "s", "a", None, 1)],
        "id int, name string, code string, region string, a string, b string, seq int",
    )
    built = dimensions.build_dimension(source, spec, NOW)
    empty = spark.createDataFrame([], dimensions.dimension_schema(source, spec))
    assert rows(dimensions.merge_dimension(empty, source, spec, NOW)) == rows(built)
