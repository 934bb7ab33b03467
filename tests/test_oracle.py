"""Every query against its SQL on the provided tables."""

import os
from pathlib import Path

import duckdb
import pytest

from starloom.oracle import ORACLE
from starloom.queries import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def table(arrow):
    """Sorted rows and the types, both by column name."""
    names = sorted(arrow.column_names)
    arrow = arrow.select(names)
    rows = sorted(zip(*[c.to_pylist() for c in arrow.columns], strict=True), key=repr)
    kinds = [str(t).replace("large_", "").replace("[us, tz=UTC]", "[us]") for t in arrow.schema.types]
    return names, kinds, rows


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, duck, name):
    ours = table(QUERIES[name](spark, FOLDER).toArrow())
    theirs = table(duck.execute(ORACLE[name]).to_arrow_table())
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1]
    assert len(ours[2]) == len(theirs[2])
    assert ours[2] == theirs[2]
    assert ours[2]
