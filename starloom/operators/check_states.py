"""Checks of a growing table from states that add up (Q1-Q4, Q9).

Each part of a fact leaves a state when it is loaded: how many rows it has and how many
values of each column are missing, which keys of other tables it uses, and which of its
own keys are there more than once, copies in earlier parts included.  Counts are summed,
used keys are united, and of a doubled key the newest count holds.  So a suite over all
parts reads the states and the new part, never the earlier parts: of those only files
that may hold a key of the new part are opened, to count its copies.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.columns import col, equal_on, q
from starloom.functions.typenames import struct
from starloom.operators.quality import Check, DuplicateKeys, References, table_counts

#: Tables of a state: kind to schema.  A null column stands for the rows themselves.
SCHEMAS = {
    "counts": struct(part="string", column="string", n="bigint"),
    "used": struct(part="string", fact_key="string", value="string"),
    "doubled": struct(part="string", keys="string", key="string", copies="bigint"),
}


def key_name(keys: Sequence[str]) -> str:
    return ",".join(keys)


def watched(checks: Iterable[Check], table: str) -> tuple[list[str], list[tuple[str, ...]]]:
    """Foreign keys and unique keys of the table that the checks are about."""
    checks = list(checks)
    foreign = [c.fact_key for c in checks if isinstance(c, References) and c.fact == table]
    unique = [tuple(c.keys) for c in checks if isinstance(c, DuplicateKeys) and c.table == table and not c.where]
    return list(dict.fromkeys(foreign)), list(dict.fromkeys(unique))


def counts(rows: DataFrame, part: str) -> DataFrame:
    """Rows, and missing values per column, in one pass."""
    found = table_counts(rows, rows.columns)
    entries = [(F.lit(None).cast("string"), F.col("__rows"))]
    entries += [(F.lit(c), col(f"__missing_{c}")) for c in rows.columns]
    return found.select(F.inline(F.array(*[F.struct(F.lit(part).alias("part"), c.alias("column"), n.alias("n")) for c, n in entries])))


def used(rows: DataFrame, part: str, foreign: Sequence[str]) -> DataFrame:
    """The distinct keys of other tables, all foreign keys in one pass."""
    entries = [F.struct(F.lit(c).alias("fact_key"), col(c).cast("string").alias("value")) for c in foreign]
    values = rows.select(F.inline(F.array(*entries))).filter("value IS NOT NULL").distinct()
    return values.select(F.lit(part).alias("part"), "fact_key", "value")


def doubled(rows: DataFrame, earlier: DataFrame, part: str, keys: Sequence[str]) -> DataFrame:
    """Keys of the part that are there more than once, in it or together with ``earlier`` rows; null equals null."""
    names, same = list(map(q, keys)), equal_on("e", "o", keys, null_safe=True)
    own = rows.select(*names)
    # One fold of both: a join of them would shuffle the part's keys anew, as null-safe keys are dealt by other expressions.
    met = earlier.select(*names).alias("e").join(own.alias("o"), same, "left_semi").select(*[col(c).cast(own.schema[c].dataType).alias(c) for c in keys])
    every = own.withColumn("__own", F.lit(1)).unionByName(met.withColumn("__own", F.lit(0)))
    both = every.groupBy(*names).agg(F.count(F.lit(1)).alias("copies"), F.max("__own").alias("__own")).filter("__own = 1").drop("__own")
    return both.filter("copies > 1").select(
        F.lit(part).alias("part"), F.lit(key_name(keys)).alias("keys"), F.to_json(F.struct(*names)).alias("key"), "copies"
    )


@dataclass(frozen=True)
class TableState:
    """The states of all parts of a table; answers its checks as the table itself would."""

    counts: DataFrame
    used: DataFrame
    doubled: DataFrame
    foreign: frozenset[str]
    unique: frozenset[str]

    @classmethod
    def of(cls, tables: Mapping[str, DataFrame], foreign: Iterable[str], unique: Iterable[Sequence[str]]) -> TableState:
        return cls(**tables, foreign=frozenset(foreign), unique=frozenset(map(key_name, unique)))

    def table_counts(self, columns: Iterable[str]) -> DataFrame:
        def total(condition: Column) -> Column:
            return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

        return self.counts.agg(
            total(F.col("column").isNull()).alias("__rows"), *[total(F.col("column") == c).alias(f"__missing_{c}") for c in columns]
        )

    def copies(self, keys: Sequence[str]) -> DataFrame | None:
        """Doubled keys and their copies, None if these keys are not watched."""
        if key_name(keys) not in self.unique:
            return None
        mine = self.doubled.filter(F.col("keys") == key_name(keys))
        return mine.groupBy("key").agg(F.max_by("copies", "part").alias("__copies"))

    def keys_used(self, fact_key: str) -> DataFrame | None:
        """Distinct values of a foreign key as text, None if it is not watched."""
        if fact_key not in self.foreign:
            return None
        return self.used.filter(F.col("fact_key") == fact_key).select(F.col("value").alias("__key")).distinct()
