"""The sports-results warehouse: two raw tables, four dimensions, one fact."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime
from functools import partial
from typing import Any

from pyspark.sql import SparkSession

from starloom.functions.columns import batch_id
from starloom.operators.quality import (
    Check,
    ColumnRule,
    Contract,
    DataType,
    DuplicateKeys,
    NullFraction,
    References,
    RowCount,
    contract_checks,
    run_suite,
)
from starloom.operators.runlog import logged_run, store_checkpoint
from starloom.operators.concurrent import side_by_side
from starloom.plans.silver import process
from starloom.plans.specs import CleaningConfig, DimensionSpec, FactSpec, StarSpec
from starloom.plans.star import Loaded, QualityGateError, load_star
from starloom.sources.ingest import FILE_ORDER, describe, ingest

ATHLETES, REGIONS = "athlete_events", "noc_regions"
FACT = "fact_athlete_event_result"

DIM_ATHLETE = DimensionSpec(
    name="dim_athlete",
    source=ATHLETES,
    key="athlete_key",
    natural_keys=("id",),
    attributes=("name", "sex", "team", "height", "weight"),
    scd=1,
    order_by=FILE_ORDER,
)
DIM_COUNTRY = DimensionSpec(
    name="dim_country",
    source=REGIONS,
    key="country_key",
    natural_keys=("noc",),
    attributes=("region", "notes"),
    scd=2,
    order_by=FILE_ORDER,
)
DIM_EVENT = DimensionSpec(
    name="dim_event", source=ATHLETES, key="event_key", natural_keys=("event", "sport"), scd=0
)
DIM_GAMES = DimensionSpec(
    name="dim_games",
    source=ATHLETES,
    key="games_key",
    natural_keys=("games", "year", "season", "city"),
    scd=0,
)
STAR = StarSpec(
    dimensions=(DIM_ATHLETE, DIM_COUNTRY, DIM_EVENT, DIM_GAMES),
    fact=FactSpec(
        name=FACT,
        source=ATHLETES,
        key="result_key",
        dimensions=("dim_athlete", "dim_country", "dim_event", "dim_games"),
        measures=("age", "height", "weight", "medal"),
        flags={"medal_flag": "medal"},
        grain=("athlete_key", "event_key", "games_key"),
    ),
)

# Declared columns, row minimums and null limits of the raw tables.
ATHLETES_CONTRACT = Contract(
    columns=(
        ColumnRule("ID", "int64", nullable=False),
        ColumnRule("Name", "string", nullable=False),
        ColumnRule("Sex", "string", nullable=False),
        ColumnRule("Age", "float"),
        ColumnRule("Height", "float"),
        ColumnRule("Weight", "float"),
        ColumnRule("Team", "string", nullable=False),
        ColumnRule("NOC", "string", nullable=False),
        ColumnRule("Games", "string", nullable=False),
        ColumnRule("Year", "int64", nullable=False),
        ColumnRule("Season", "string", nullable=False),
        ColumnRule("City", "string", nullable=False),
        ColumnRule("Sport", "string", nullable=False),
        ColumnRule("Event", "string", nullable=False),
        ColumnRule("Medal", "string"),
    ),
    min_rows=100000,
    max_null_by_column={"Age": 0.05, "Height": 0.25, "Weight": 0.25},
)
REGIONS_CONTRACT = Contract(
    columns=(
        ColumnRule("NOC", "string", nullable=False),
        ColumnRule("region", "string", nullable=False),
        ColumnRule("notes", "string"),
    ),
    min_rows=200,
    max_null_by_column={"NOC": 0.0, "region": 0.02},
)
FACT_CONTRACT = Contract(
    min_rows=100000,
    unique_keys=(("result_key",),),
    references=(
        ("athlete_key", "dim_athlete", "athlete_key"),
        ("country_key", "dim_country", "country_key"),
        ("event_key", "dim_event", "event_key"),
        ("games_key", "dim_games", "games_key"),
    ),
)

CLEANING = CleaningConfig(
    type_mapping={"age": "float", "height": "float", "weight": "float", "year": "int"}
)


def warehouse_checks(history_aware: bool = True) -> list[Check]:
    """The 27 checks of the dimensional tables (Q9).

    ``history_aware`` looks for duplicate country codes among the open versions only; a
    correct history fails the check over all versions.
    """
    # Per dimension the row minimum and the largest share of missing values.
    limits = {
        "dim_athlete": (100, 0.3),
        "dim_country": (1, 0.5),
        "dim_event": (1, 0.0),
        "dim_games": (1, 0.0),
    }
    checks: list[Check] = []
    for spec in STAR.dimensions:
        min_rows, max_missing = limits[spec.name]
        checks += [
            RowCount(spec.name, min_rows),
            NullFraction(spec.name, max_missing),
            DuplicateKeys(spec.name, (spec.key,)),
        ]
        if spec.scd:
            where = "is_current" if spec.scd == 2 and history_aware else None
            label = f"{spec.name} (business key)"
            checks.append(DuplicateKeys(spec.name, spec.natural_keys, label, where))
        checks.append(DataType(spec.name, spec.key, "int64"))
    checks += [
        RowCount(FACT, 1),
        NullFraction(FACT, 0.5),
        DuplicateKeys(FACT, ("result_key",)),
        DataType(FACT, "result_key", "int64"),
        DataType(FACT, "medal_flag", "int64"),
    ]
    checks += [References(FACT, d.name, d.key, d.key, fact_label="fact") for d in STAR.dimensions]
    return checks


def run(
    spark: SparkSession,
    athletes: Any,
    regions: Any,
    root: str,
    batch_ts: datetime,
    *,
    incremental: bool = True,
    cleaning: CleaningConfig = CLEANING,
    region_cleaning: CleaningConfig = CleaningConfig(),
    checks: Sequence[Check] = (),
    min_pass_rate: float = 0.9,
    dedup_batch: bool = False,
    check_new_facts_only: bool = True,
    enforce_contracts: bool = False,
    csv_options: Mapping[str, Any] | None = None,
    clock: Callable[[], datetime] = datetime.now,
) -> Loaded:
    """One batch from raw files to the promoted warehouse, logged per layer.

    Not ``incremental``, the batch replaces the warehouse instead of adding to it.  A raw
    column with values that do not fit its declared type is landed as text.  With
    ``enforce_contracts`` the declared rules of the raw tables must hold before anything is
    cleaned, and those of the fact before the batch is promoted.  ``csv_options`` go to the
    CSV reader (``multiLine`` for line breaks inside quotes).
    The folders below ``root`` are ``bronze``, ``silver``, ``gold`` and ``logs``.
    """
    log = f"{root}/logs/runs"
    given_as = f"{describe(athletes)}, {describe(regions)}"
    with logged_run(spark, log, "bronze", "raw_ingest", given_as, clock) as current:
        given = {ATHLETES: (athletes, ATHLETES_CONTRACT), REGIONS: (regions, REGIONS_CONTRACT)}
        raw = side_by_side(
            spark,
            {
                table: partial(
                    ingest, spark, source, f"{root}/bronze", table, batch_ts,
                    schema=contract.schema(), record_order=True, options={"lenient": True, **(csv_options or {})},
                )
                for table, (source, contract) in given.items()
            },
        )
        rows_raw = sum(t.count() for t in raw.values())
        # Names of the layers' steps in the log.
        current.transformation("ingest_csv", {"tables": [ATHLETES, REGIONS]})
        if enforce_contracts:
            rules = [c for table, (_, contract) in given.items() for c in contract_checks(table, contract)]
            failed = [r.asDict() for r in run_suite(raw, rules).filter("NOT passed").collect()]
            if failed:
                raise QualityGateError(f"raw tables break their contracts: {[(r['check'], r['table']) for r in failed]}")
            checks, min_pass_rate = [*checks, *contract_checks(FACT, FACT_CONTRACT)], 1.0
            check_new_facts_only = False  # the declared row minimum is that of the whole fact
        current.row_count_out = rows_raw

    with logged_run(spark, log, "silver", "standardized", "bronze", clock) as current:
        configs = {ATHLETES: cleaning, REGIONS: region_cleaning}
        cleaned = side_by_side(
            spark,
            {
                table: partial(process, raw[table], f"{root}/silver", table, config, batch_ts)
                for table, config in configs.items()
            },
        )
        current.transformation("standardize_columns", {"tables": [ATHLETES, REGIONS]})
        current.row_count_in = rows_raw
        current.row_count_out = rows_clean = sum(c.rows_out for c in cleaned.values())

    with logged_run(spark, log, "gold", "star_schema", "silver", clock) as current:
        current.row_count_in = rows_clean
        loaded = load_star(
            {name: c.table for name, c in cleaned.items()},
            STAR,
            f"{root}/gold",
            batch_ts,
            checks=checks,
            min_pass_rate=min_pass_rate,
            dedup_batch=dedup_batch,
            check_new_facts_only=check_new_facts_only,
            rebuild=not incremental,
        )
        fact_rows = loaded.fact.count()
        current.transformation("build_star_schema", {"mode": loaded.stats["mode"], "fact_rows": fact_rows})
        current.row_count_out = fact_rows
        store_checkpoint(
            spark, f"{root}/logs/checkpoints", fact_rows, loaded.new_facts.count(), batch_ts, loaded.slot, batch_id(batch_ts)
        )
    return loaded
