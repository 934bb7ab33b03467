"""The seeded sample against a sort of all rows by their hash."""

import hashlib

import pytest

from starloom.operators import sampling

ROWS = [(i % 50, None if i % 7 == 0 else f"v{i % 11}", i) for i in range(400)] + [(1, "same", 0)] * 30


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plain(n, seed, columns):
    def key(row):
        parts = [str(seed), *["-" if row[c] is None else f"={row[c]}" for c in columns]]
        return hashlib.md5("\x1f".join(parts).encode()).hexdigest(), tuple((v is not None, v or 0) if not isinstance(v, str) else (True, v) for v in row)

    return sorted(sorted(ROWS, key=key)[:n], key=repr)


@pytest.mark.parametrize("n", [0, 1, 37, 429, 430, 1000])
def test_sample_is_exact_and_independent_of_partitioning(spark, n):
    df = spark.createDataFrame(ROWS, "a int, b string, c bigint")
    found = [rows(sampling.sample_rows(x, n, 5)) for x in (df.coalesce(1), df.repartition(7), df.orderBy("c", ascending=False))]
    assert found[0] == found[1] == found[2] == plain(n, 5, (0, 1, 2))


@pytest.mark.parametrize("by", [(0,), (2,), (1, 0)])
def test_ties_and_rounds(spark, monkeypatch, by):
    """With next to no rows to sort, beginnings are refined up to the whole hash."""
    monkeypatch.setattr(sampling, "SORTED_ROWS", 1)
    monkeypatch.setattr(sampling, "DIGITS", 8)
    df = spark.createDataFrame(ROWS, "a int, b string, c bigint").repartition(3)
    names = [df.columns[i] for i in by]
    assert rows(sampling.sample_rows(df, 100, 3, names)) == plain(100, 3, by)


def test_samples_nest_and_differ_by_seed(spark):
    df = spark.range(2000)
    small, large, other = (set(rows(sampling.sample_rows(df, n, s))) for n, s in ((100, 1), (300, 1), (300, 2)))
    assert small < large
    assert len(large) == len(other) == 300
    assert large != other
    assert sampling.sample_rows(df.limit(0), 5, 1).count() == 0
    with pytest.raises(ValueError, match="cannot take"):
        sampling.sample_rows(df, -1, 1)
