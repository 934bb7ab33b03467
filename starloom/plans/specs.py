"""Specs: what a dimension, a fact and a contract look like."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class DimensionSpec:
    """One dimension.

    ``scd`` is 0 (insert only), 1 (overwrite) or 2 (history).  Types 1 and 2 keep the
    last source row per natural key in ``order_by`` order and drop missing keys; type 0
    takes the distinct key combinations, missing parts included.
    """

    name: str
    source: str
    key: str
    natural_keys: tuple[str, ...]
    scd: int
    attributes: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()

    @property
    def business_columns(self) -> tuple[str, ...]:
        return self.natural_keys + self.attributes

    @property
    def audit_columns(self) -> tuple[str, ...]:
        return {
            0: ("dw_insert_date",),
            1: ("dw_insert_date", "dw_update_date"),
            2: ("effective_date", "end_date", "is_current", "dw_insert_date"),
        }[self.scd]

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.key, *self.business_columns, *self.audit_columns)


@dataclass(frozen=True)
class FactSpec:
    """One fact: its dimensions by name, measures, presence flags and grain.

    ``on`` maps a dimension's natural key to the source column where names differ.
    ``order_by`` asks for result keys in that order; without it any dense numbering
    is used, which needs no sort.
    """

    name: str
    source: str
    key: str
    dimensions: tuple[str, ...]
    measures: tuple[str, ...]
    flags: Mapping[str, str] = field(default_factory=dict)
    grain: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    on: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class StarSpec:
    dimensions: tuple[DimensionSpec, ...]
    fact: FactSpec

    def dimension(self, name: str) -> DimensionSpec:
        return next(d for d in self.dimensions if d.name == name)


@dataclass(frozen=True)
class CleaningConfig:
    """How raw rows of one table become clean ones."""

    missing_strategy: str = "drop"
    missing_subset: tuple[str, ...] | None = None
    fill_value: Any = None
    order_by: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    type_mapping: Mapping[str, str] = field(default_factory=dict)
    on_misfit: str = "keep"
    remove_outliers: bool = False
    outlier_columns: tuple[str, ...] | None = None
    z_score_threshold: float = 3.0
    transformations: Sequence[Callable[[DataFrame], DataFrame]] = ()
