"""Data-quality checks as data.

A suite is a list of check specs.  All scalar checks of one table are answered by one
aggregate over it; a key check and a reference check are one grouped pass each.  The
result is a small frame with a row per check, whose columns are those of a quality
report, plus the failure messages.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.functions.columns import col, is_missing, q
from starloom.functions.typenames import name_of, spark_name, struct, type_of
from starloom.operators.concurrent import side_by_side
from starloom.sources.rows import small_frame

if TYPE_CHECKING:
    from starloom.operators.check_states import TableState


@dataclass(frozen=True)
class RowCount:
    """Passes if the table has more than ``min_rows`` rows."""

    table: str
    min_rows: int = 0
    label: str | None = None


@dataclass(frozen=True)
class NullFraction:
    """Passes if no column has a larger share of missing values than allowed.

    ``by_column`` checks only its columns, each against its own maximum.
    """

    table: str
    max_fraction: float = 0.2
    by_column: Mapping[str, float] | None = None
    label: str | None = None


@dataclass(frozen=True)
class DuplicateKeys:
    """Passes if no key occurs twice; ``where`` narrows the rows looked at."""

    table: str
    keys: tuple[str, ...]
    label: str | None = None
    where: str | None = None


@dataclass(frozen=True)
class References:
    """Passes if every non-null fact key has a dimension row."""

    fact: str
    dim: str
    fact_key: str
    dim_key: str
    fact_label: str | None = None
    dim_label: str | None = None


@dataclass(frozen=True)
class DataType:
    """Passes if the column has the expected type."""

    table: str
    column: str
    expected: str
    label: str | None = None


Check = RowCount | NullFraction | DuplicateKeys | References | DataType

REPORT_SCHEMA = struct(
    check="string",
    table="string",
    threshold="bigint",
    actual="string",
    passed="boolean",
    max_threshold="double",
    violating_columns=T.MapType(T.StringType(), T.DoubleType()),
    key_columns=T.ArrayType(T.StringType()),
    duplicate_count="bigint",
    column="string",
    expected="string",
    fact_table="string",
    dim_table="string",
    fact_key="string",
    dim_key="string",
    missing_keys="bigint",
    # One entry per reason the check failed.
    messages=T.ArrayType(T.StringType()),
    # False where only a message is reported and the check does not count.
    recorded="boolean",
    position="int32",
)

# What is known of a check before any data is read.
_DECLARED = struct(
    position="int32",
    check="string",
    table="string",
    threshold="bigint",
    max_threshold="double",
    key_columns=T.ArrayType(T.StringType()),
    column="string",
    expected="string",
    actual_type="string",
    fact_table="string",
    dim_table="string",
    fact_key="string",
    dim_key="string",
)

_VIOLATIONS = T.ArrayType(struct(c="string", f="double", m="double"))
_MEASURED = T.StructType([*_DECLARED.fields, *struct(__amount="bigint", __violations=_VIOLATIONS).fields])


def _declare(position: int, check: Check, tables: Mapping[str, DataFrame]) -> dict[str, object]:
    values: dict[str, object] = {"position": position}
    if isinstance(check, References):
        values |= {
            "check": "referential_integrity",
            "fact_table": check.fact_label or check.fact,
            "dim_table": check.dim_label or check.dim,
            "fact_key": check.fact_key,
            "dim_key": check.dim_key,
        }
    else:
        values["table"] = check.label or check.table
    if isinstance(check, RowCount):
        values |= {"check": "row_count", "threshold": check.min_rows}
    elif isinstance(check, NullFraction):
        general = None if check.by_column is not None else float(check.max_fraction)
        values |= {"check": "null_percentage", "max_threshold": general}
    elif isinstance(check, DuplicateKeys):
        values |= {"check": "duplicate_keys", "key_columns": list(check.keys)}
    elif isinstance(check, DataType):
        schema = tables[check.table].schema
        actual = name_of(schema[check.column].dataType) if check.column in schema.names else None
        values |= {
            "check": "data_type",
            "column": check.column,
            "expected": spark_name(check.expected),
            "actual_type": actual,
        }
    return values


def _percent(fraction: Column) -> Column:
    return F.format_string("%.1f%%", fraction * 100)


def null_fraction(column: str) -> Column:
    """Share of missing values, from the counts of ``table_counts``; null for no rows."""
    return F.try_divide(col(f"__missing_{column}"), F.col("__rows"))


def _violations(limits: Mapping[str, float]) -> Column:
    """Columns above their limit, with their share and the limit."""
    entries = [
        F.struct(F.lit(c).alias("c"), null_fraction(c).alias("f"), F.lit(float(m)).alias("m"))
        for c, m in limits.items()
    ]
    return F.filter(F.array(*entries), lambda e: F.coalesce(e["f"] > e["m"], F.lit(False)))


def _measure(position: int, amount: Column | None = None, violations: Column | None = None) -> Column:
    amount = F.lit(None) if amount is None else amount
    violations = F.lit(None) if violations is None else violations
    return F.struct(
        F.lit(position).alias("position"),
        amount.cast("bigint").alias("__amount"),
        violations.cast(_VIOLATIONS).alias("__violations"),
    )


def table_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row: number of rows, and of missing values per column."""
    return df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(is_missing(df, c)).alias(f"__missing_{c}") for c in columns],
    )


def null_fractions(df: DataFrame, limits: Mapping[str, float]) -> DataFrame:
    """Per column: share of missing values, its maximum, and whether it is above (Q2)."""
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            null_fraction(c).alias("null_fraction"),
            F.lit(float(m)).alias("max_fraction"),
            F.coalesce(null_fraction(c) > F.lit(float(m)), F.lit(False)).alias("violates"),
        )
        for c, m in limits.items()
    ]
    return table_counts(df, limits).select(F.inline(F.array(*rows)))


def column_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Per declared column: expected and actual type, missing values, and both verdicts."""
    rows = []
    present = [c.name for c in contract.columns if c.name in df.columns]
    for rule in contract.columns:
        found = rule.name in present
        actual = name_of(df.schema[rule.name].dataType) if found else None
        missing = col(f"__missing_{rule.name}") if found else F.lit(None).cast("bigint")
        rows.append(
            F.struct(
                F.lit(rule.name).alias("column_name"),
                F.lit(spark_name(rule.type)).alias("expected_type"),
                F.lit(actual).cast("string").alias("actual_type"),
                missing.alias("missing_count"),
                F.lit(actual == spark_name(rule.type)).alias("type_ok"),
                F.coalesce(F.lit(rule.nullable) | (missing == 0), F.lit(False)).alias("nulls_ok"),
            )
        )
    return table_counts(df, present).select(F.inline(F.array(*rows)))


def _scalar_measures(df: DataFrame, checks: Sequence[tuple[int, RowCount | NullFraction]], state: TableState | None = None) -> DataFrame:
    columns: dict[str, None] = {}
    rows = []
    for position, check in checks:
        if isinstance(check, RowCount):
            rows.append(_measure(position, amount=F.col("__rows")))
        else:
            by_column = check.by_column
            limits = dict.fromkeys(df.columns, check.max_fraction) if by_column is None else by_column
            columns |= dict.fromkeys(limits)
            rows.append(_measure(position, violations=_violations(limits)))
    counted = table_counts(df, columns) if state is None else state.table_counts(columns)
    return counted.select(F.inline(F.array(*rows)))


def rows_in_duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once and how often; null equals null (U4)."""
    return df.groupBy(*map(q, keys)).agg(F.count(F.lit(1)).alias("__copies")).filter("__copies > 1")


def _duplicate_measure(df: DataFrame, check: DuplicateKeys, position: int, state: TableState | None = None) -> DataFrame:
    groups = state.copies(check.keys) if state is not None and not check.where else None
    if groups is None:
        groups = rows_in_duplicate_groups(df.filter(check.where) if check.where else df, check.keys)
    found = groups.agg(F.coalesce(F.sum("__copies"), F.lit(0)).alias("n"))
    return found.select(F.inline(F.array(_measure(position, amount=F.col("n")))))


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Distinct non-null fact keys without a dimension row.

    The fact is reduced to its distinct keys before it is joined.
    """
    used = fact.select(col(fact_key).alias("__key")).filter("__key IS NOT NULL").distinct()
    known = dim.select(col(dim_key).alias("__known"))
    return used.join(known, F.col("__key") == F.col("__known"), "left_anti")


def _reference_measure(
    fact: DataFrame, dim: DataFrame, check: References, position: int, state: TableState | None = None
) -> DataFrame:
    used = state.keys_used(check.fact_key) if state is not None else None
    if used is None:
        missing = orphans(fact, dim, check.fact_key, check.dim_key)
    else:
        known = dim.select(col(check.dim_key).cast("string").alias("__known"))
        missing = used.join(known, F.col("__key") == F.col("__known"), "left_anti")
    found = missing.agg(F.count(F.lit(1)).alias("n"))
    return found.select(F.inline(F.array(_measure(position, amount=F.col("n")))))


def run_suite(
    tables: Mapping[str, DataFrame], checks: Sequence[Check], states: Mapping[str, TableState] | None = None
) -> DataFrame:
    """Run all checks; one row each, ``position`` gives the order of the suite.

    The scalar checks of a table are one job, a key or reference check is another, and
    the jobs run side by side.  The driver gathers one small row per check; report, gate
    and report file then work on those rows and do not read the tables again.  A table that
    has a state in ``states`` is not read for what the state knows.
    """
    states = states or {}
    if not checks:
        raise ValueError("a suite needs at least one check")
    spark = next(iter(tables.values())).sparkSession
    numbered = list(enumerate(checks, start=1))
    parts: dict[str, DataFrame] = {}
    scalar: dict[str, list[tuple[int, RowCount | NullFraction]]] = {}
    for position, check in numbered:
        if isinstance(check, DuplicateKeys):
            parts[f"check {position}"] = _duplicate_measure(tables[check.table], check, position, states.get(check.table))
        elif isinstance(check, References):
            fact, dim = tables[check.fact], tables[check.dim]
            parts[f"check {position}"] = _reference_measure(fact, dim, check, position, states.get(check.fact))
        elif not isinstance(check, DataType):
            scalar.setdefault(check.table, []).append((position, check))
    parts |= {f"table {t}": _scalar_measures(tables[t], group, states.get(t)) for t, group in scalar.items()}
    measured = side_by_side(spark, {name: part.collect for name, part in parts.items()})
    amounts = {r["position"]: r.asDict(recursive=True) for found in measured.values() for r in found}
    rows = [_declare(n, c, tables) | amounts.get(n, {}) for n, c in numbered]
    return _judge(small_frame(spark, rows, _MEASURED))


def _judge(checks: DataFrame) -> DataFrame:
    """Verdict, report columns and messages of measured checks."""
    kind, amount, violations = F.col("check"), F.col("__amount"), F.col("__violations")
    counted = kind.isin("duplicate_keys", "referential_integrity")
    absent = (kind == "data_type") & F.col("actual_type").isNull()
    passed = (
        F.when(kind == "row_count", amount > F.col("threshold"))
        .when(kind == "null_percentage", F.size(violations) == 0)
        .when(counted, amount == 0)
        .otherwise(F.coalesce(F.col("actual_type") == F.col("expected"), F.lit(False)))
    )
    number = amount.cast("string")
    reason = (
        F.when(kind == "row_count", F.concat("table", F.lit(": "), number, F.lit(" rows, more than "), "threshold", F.lit(" needed")))
        .when(kind == "duplicate_keys", F.concat("table", F.lit(": "), number, F.lit(" rows share their key ("), F.concat_ws(", ", "key_columns"), F.lit(")")))
        .when(counted, F.concat("fact_table", F.lit("."), "fact_key", F.lit(": "), number, F.lit(" keys not in "), "dim_table", F.lit("."), "dim_key"))
        .when(absent, F.concat("table", F.lit(": no column "), "column"))
        .otherwise(F.concat("table", F.lit("."), "column", F.lit(": "), "actual_type", F.lit(", expected "), "expected"))
    )
    reasons = F.transform(
        violations,
        lambda e: F.concat(
            F.col("table"), F.lit("."), e["c"], F.lit(": "), _percent(e["f"]), F.lit(" missing, at most "), _percent(e["m"])
        ),
    )
    pairs = F.transform(violations, lambda e: F.struct(e["c"], e["f"]))
    report = {
        "actual": F.when(kind == "row_count", number).otherwise(F.col("actual_type")),
        "passed": passed,
        "violating_columns": F.map_from_entries(pairs),
        "duplicate_count": F.when(kind == "duplicate_keys", amount),
        "missing_keys": F.when(kind == "referential_integrity", amount),
        "messages": F.when(passed, F.array().cast("array<string>"))
        .when(kind == "null_percentage", reasons)
        .otherwise(F.array(reason)),
        "recorded": ~absent,
    }
    return checks.select(*[report.get(f.name, col(f.name)).alias(f.name) for f in REPORT_SCHEMA.fields])


def quality_report(checks: DataFrame) -> DataFrame:
    """Totals of a suite (Q6).  ``failed`` counts messages and may exceed failed checks."""
    total = F.count_if("recorded")
    passed = F.count_if(F.col("recorded") & F.col("passed"))
    return checks.agg(
        total.alias("total_checks"),
        passed.alias("passed"),
        F.coalesce(F.sum(F.size("messages")), F.lit(0)).cast("bigint").alias("failed"),
        F.coalesce(F.try_divide(passed, total), F.lit(0.0)).alias("pass_rate"),
        F.flatten(
            F.transform(
                F.array_sort(F.collect_list(F.struct("position", "messages"))), lambda e: e["messages"]
            )
        ).alias("failures"),
    )


def meets_gate(checks: DataFrame, min_pass_rate: float = 0.8) -> bool:
    """True if the pass rate reaches ``min_pass_rate`` (Q8)."""
    return not quality_report(checks).filter(F.col("pass_rate") >= min_pass_rate).isEmpty()


def write_quality_report(checks: DataFrame, path: str) -> None:
    """One CSV row per recorded check; nested values become text."""
    flat = checks.filter("recorded").orderBy("position").drop("messages", "recorded", "position")
    flat.withColumns(
        {
            "violating_columns": F.to_json("violating_columns"),
            "key_columns": F.concat_ws(",", "key_columns"),
        }
    ).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


@dataclass(frozen=True)
class Standards:
    """Thresholds that hold where a contract says nothing."""

    min_pass_rate: float = 0.95
    max_null_fraction: float = 0.25


@dataclass(frozen=True)
class ColumnRule:
    name: str
    type: str
    nullable: bool = True


@dataclass(frozen=True)
class Contract:
    """What a table promises: columns, rows, missing values, keys, references."""

    columns: tuple[ColumnRule, ...] = ()
    min_rows: int | None = None
    max_null_by_column: Mapping[str, float] = field(default_factory=dict)
    unique_keys: tuple[tuple[str, ...], ...] = ()
    references: tuple[tuple[str, str, str], ...] = ()

    def schema(self) -> T.StructType:
        """The declared columns as a reader schema."""
        return T.StructType(
            [
                T.StructField(c.name, type_of(c.type), c.nullable)
                for c in self.columns
            ]
        )


def contract_checks(table: str, contract: Contract, standards: Standards = Standards()) -> list[Check]:
    """The checks a contract stands for.

    A column's own maximum of missing values comes first, then "not nullable", then the
    general standard.
    """
    checks: list[Check] = []
    if contract.min_rows is not None:
        checks.append(RowCount(table, contract.min_rows))
    limits = {
        c.name: contract.max_null_by_column.get(c.name, standards.max_null_fraction if c.nullable else 0.0)
        for c in contract.columns
    } | dict(contract.max_null_by_column)
    if limits:
        checks.append(NullFraction(table, by_column=limits))
    checks += [DataType(table, c.name, c.type) for c in contract.columns]
    checks += [DuplicateKeys(table, keys) for keys in contract.unique_keys]
    checks += [References(table, dim, key, dim_key) for key, dim, dim_key in contract.references]
    return checks
