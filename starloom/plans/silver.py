"""Raw rows to clean rows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starloom.functions.typenames import struct
from starloom.operators.cleaning import (
    add_processing_metadata,
    apply_transformations,
    coerce_types,
    count_missing,
    handle_missing_values,
    remove_duplicates,
    remove_outliers,
    standardize_column_names,
)
from starloom.plans.specs import CleaningConfig
from starloom.sources.layers import read_layer, write_layer
from starloom.sources.rows import small_frame
from starloom.sources.staging import stage, temporary_stages

ISSUES_SCHEMA = struct(issue="string", amount="bigint", detail="string")


@dataclass(frozen=True)
class Cleaned:
    """The written table and what cleaning did to it."""

    table: DataFrame
    issues: DataFrame
    rows_in: int
    rows_out: int


def clean(df: DataFrame, config: CleaningConfig, batch_ts: datetime) -> DataFrame:
    """Names, duplicates, missing values, types, outliers, own steps, metadata, in this order."""
    return _clean(df, config, batch_ts, None)[0]


def _clean(
    df: DataFrame, config: CleaningConfig, batch_ts: datetime, after_dedup: Observation | None
) -> tuple[DataFrame, int]:
    df = remove_duplicates(standardize_column_names(df))
    if after_dedup is not None:
        # Downstream of the last shuffle and in the stage that writes, where Spark counts
        # every partition once even if tasks or executors are lost.
        df = df.observe(
            after_dedup,
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(count_missing(df), F.lit(0)).alias("missing"),
        )
    # Steps that look at the data first would run all before them again each time.
    if config.missing_strategy in ("fillna_mean", "fillna_forward"):
        df = stage(df)
    df = handle_missing_values(
        df,
        config.missing_strategy,
        subset=config.missing_subset,
        value=config.fill_value,
        order_by=config.order_by,
        partition_by=config.partition_by,
    )
    if config.type_mapping or config.remove_outliers:
        df = stage(df)
    failed: list[str] = []
    if config.type_mapping:
        df, failed = coerce_types(df, config.type_mapping, config.on_misfit)
    outliers = 0
    if config.remove_outliers:
        kept = remove_outliers(df, config.outlier_columns, config.z_score_threshold)
        if after_dedup is not None:
            outliers = df.count() - kept.count()
        df = kept
    df = apply_transformations(df, config.transformations)
    return add_processing_metadata(df, batch_ts), outliers


def process(
    df: DataFrame, root: str, table: str, config: CleaningConfig, batch_ts: datetime, fmt: str = "parquet"
) -> Cleaned:
    """Clean a raw table, write the batch to the clean layer, count what was removed."""
    spark = df.sparkSession
    seen = Observation("after_dedup")
    name = f"{table}_cleaned"
    with temporary_stages(spark):
        cleaned, outliers = _clean(df, config, batch_ts, seen)
        write_layer(cleaned, root, name, batch_ts, fmt)
    written = read_layer(spark, root, name, cleaned.schema, fmt, batch_ts)
    rows_in = df.count()
    issues = issue_rows(rows_in, seen.get["rows"], seen.get["missing"], outliers, config.missing_strategy)
    return Cleaned(written, small_frame(spark, issues, ISSUES_SCHEMA), rows_in, written.count())


def issue_rows(rows_in: int, rows_unique: int, missing: int, outliers: int, strategy: str) -> list[dict]:
    """One row per kind of issue that occurred (Q7)."""
    found = [
        ("duplicates", rows_in - rows_unique, "rows removed"),
        ("missing_values", missing, strategy),
        ("outliers", outliers, "rows removed"),
    ]
    return [dict(zip(ISSUES_SCHEMA.names, issue, strict=True)) for issue in found if issue[1] > 0]
