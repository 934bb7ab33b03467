"""The profile against each column looked at by itself."""

import random
from decimal import Decimal

from starloom.operators.profile import profile

SCHEMA = "a bigint, b string, c double, `odd name` string, d decimal(10,2), e boolean, f array<int>, g bigint, h float"


def made(spark, n):
    draw = random.Random(n)
    nan = float("nan")
    values = [
        (draw.choice([None, 1, 2]), draw.choice([None, "", "x"]), draw.choice([None, nan, 0.0, -0.0, 1.5]), None, draw.choice([Decimal("1.10"), Decimal("1.1"), None]),
         draw.choice([True, False]), draw.choice([None, [], [1, None], [1]]), draw.randrange(5), draw.choice([nan, 0.1]))
        for _ in range(n)
    ]
    return spark.createDataFrame(values, SCHEMA).repartition(3)


def plain(df, name):
    found = df.select(f"`{name}`").collect()
    present = [r[0] for r in found if r[0] is not None and r[0] == r[0]]
    distinct = {repr(v) if isinstance(v, list) else v for v in present}
    return name, len(found), len(found) - len(present), len(distinct)


def test_profile(spark):
    for n in (0, 1, 300):
        df = made(spark, n)
        found = profile(df).collect()
        assert [tuple(r)[:1] + tuple(r)[2:] for r in sorted(found, key=lambda r: df.columns.index(r.column_name))] == [plain(df, c) for c in df.columns]


def test_one_scan_and_one_shuffle_of_values(spark, tmp_path):
    made(spark, 30).write.parquet(str(tmp_path / "t"))
    plan = profile(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 2  # the values, then one row per column and task
