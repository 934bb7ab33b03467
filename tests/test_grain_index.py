"""Files that a batch opens, and what it appends, against the full anti join."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starloom.operators import facts, grain_index
from starloom.sources import warehouse

START = datetime(2024, 1, 1)
GRAIN = ("a", "b")
SCHEMA = "a bigint, b string, v double"


def parts_of(spark, root, tables, index=True):
    """The tables as promoted fact parts, one batch after another."""
    for i, table in enumerate(tables):
        at, attempt = START + timedelta(days=i), f"try{i}"
        written = warehouse.write_table(table, root, "fact", at, attempt)
        if index:
            warehouse.write_grain_index(written, root, "fact", at, attempt, GRAIN)
        stats = {"mode": "full" if i == 0 else "incremental", "new_rows": 0, "appended_rows": 0, "duplicate_keys_skipped": 0}
        warehouse.promote(spark, root, i + 1, at, attempt, {"fact": written.schema}, stats, 0, "parquet", GRAIN if index else ())
    return warehouse.last_promoted(spark, root)


def opened(spark, root, at, batch):
    return warehouse.read_fact_near(spark, root, "fact", at, batch.select(*GRAIN).distinct(), GRAIN).inputFiles()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_only_files_that_may_hold_the_batch_are_opened(spark, tmp_path):
    root = str(tmp_path)
    tables = [spark.range(i * 1000, (i + 1) * 1000).select(F.col("id").alias("a"), F.lit("x").alias("b"), F.lit(1.0).alias("v")).repartition(4, "a") for i in range(3)]
    at = parts_of(spark, root, tables)
    every = warehouse.read_fact(spark, root, "fact", at).inputFiles()
    assert len(every) == 12
    # Outside all ranges; inside the ranges of one part, but in one of its files only; another value beside.
    assert opened(spark, root, at, spark.createDataFrame([(5000, "x", 0.0)], SCHEMA)) == []
    found = opened(spark, root, at, spark.createDataFrame([(1500, "x", 0.0)], SCHEMA))
    assert len(found) == 1 and "20240102" in found[0]
    assert opened(spark, root, at, spark.createDataFrame([(1500, "y", 0.0)], SCHEMA)) == []
    assert opened(spark, root, at, spark.createDataFrame([], SCHEMA)) == []
    assert len(opened(spark, root, at, spark.range(900, 2100).select(F.col("id").alias("a"), F.lit("x").alias("b")))) == 12
    # A batch that is as wide as the parts, but has none of their values, is stopped by the filters.
    wide = spark.range(0, 3000, 50).select(F.col("id").alias("a"), F.lit("w").alias("b"))
    assert len(opened(spark, root, at, wide.union(spark.createDataFrame([(1, "z")], "a bigint, b string")))) <= 2
    assert warehouse.remove_superseded(spark, root, {"fact": True}) == []


def test_types_of_the_batch_do_not_matter(spark, tmp_path):
    root = str(tmp_path)
    at = parts_of(spark, root, [spark.createDataFrame([(7, "x", 1.0)], SCHEMA)])
    assert len(opened(spark, root, at, spark.createDataFrame([(7, "x")], "a int, b string"))) == 1


def test_parts_without_an_index_are_read(spark, tmp_path):
    root = str(tmp_path)
    at = parts_of(spark, root, [spark.createDataFrame([(7, "x", 1.0)], SCHEMA)], index=False)
    assert len(opened(spark, root, at, spark.createDataFrame([(9, "x", 0.0)], SCHEMA))) == len(warehouse.read_fact(spark, root, "fact", at).inputFiles())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_the_full_anti_join(spark, tmp_path, seed):
    draw = random.Random(seed)
    root = str(tmp_path)

    def made(n, low, high):
        values = [(draw.choice([None, *range(low, high)]), draw.choice([None, "p", "q", "r"]), draw.random()) for _ in range(n)]
        return spark.createDataFrame(values, SCHEMA).repartition(3, "a")

    at = parts_of(spark, root, [made(200, 0, 300), made(60, 200, 500), made(1, 0, 2), made(0, 0, 1).coalesce(1)])
    existing = warehouse.read_fact(spark, root, "fact", at)
    for batch in (made(50, 0, 600), made(3, 450, 520), made(0, 0, 1), made(40, 550, 600)):
        near = facts.unseen_facts(lambda grains: warehouse.read_fact_near(spark, root, "fact", at, grains, GRAIN), batch, GRAIN)
        assert rows(near) == rows(facts.unseen_facts(existing, batch, GRAIN))


def test_filters_never_miss_a_grain(spark, tmp_path, monkeypatch):
    """Even crowded filters, with far too few words, leave out no file that holds a grain."""
    monkeypatch.setattr(grain_index, "MOST_WORDS", 64)
    root = str(tmp_path)
    table = spark.range(5000).select((F.col("id") * 7).alias("a"), F.col("id").cast("string").alias("b"), F.lit(1.0).alias("v")).repartition(5)
    at = parts_of(spark, root, [table])
    found = warehouse.read_fact_near(spark, root, "fact", at, table.filter("a % 5 = 0").select(*GRAIN), GRAIN)
    assert found.filter("a % 5 = 0").count() == 1000


def test_a_large_batch_reads_few_words_of_the_filters(spark, tmp_path, monkeypatch):
    root, steps, held = str(tmp_path), [], grain_index._held

    def counted(filters, in_batch, grain, files, few):
        found = held(filters, in_batch, grain, files, few)
        steps.append((few, len(files)))
        return found

    monkeypatch.setattr(grain_index, "_held", counted)
    table = spark.range(4000).select(F.col("id").alias("a"), F.lit("x").alias("b"), F.lit(1.0).alias("v"))
    at = parts_of(spark, root, [table.repartition(4, "a")])
    assert len(opened(spark, root, at, table)) == 4
    assert steps == [(True, 4)]
    # One grain is found in all words of the files that the first step left over.
    assert len(opened(spark, root, at, spark.createDataFrame([(1500, "x", 0.0)], SCHEMA))) == 1
    assert len(steps) in (2, 3)
