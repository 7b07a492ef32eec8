"""Metadata-driven builds: one generic job over a list of dataset specifications."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from strata.operators import cdc, quality


@dataclass(frozen=True)
class Spec:
    """One target: where its rows come from and what is done to them, in this order."""

    name: str
    source: str
    select: list[str] = field(default_factory=lambda: ["*"])
    where: str | None = None
    rules: list[quality.Rule] = field(default_factory=list)
    keys: list[str] = field(default_factory=list)
    sequence_by: str | None = None
    deletes: str | None = None
    except_columns: list[str] = field(default_factory=list)
    scd_type: int = 1


@dataclass(frozen=True)
class Built:
    data: DataFrame
    quarantine: DataFrame | None


def build(specs: list[Spec], resolve: Callable[[str], DataFrame]) -> dict[str, Built]:
    """Datasets by name. A spec may use an earlier spec's name as its source."""
    built: dict[str, Built] = {}
    for spec in specs:
        source = built[spec.source].data if spec.source in built else resolve(spec.source)
        rows = source.selectExpr(*spec.select)
        if spec.where:
            rows = rows.where(spec.where)
        rejected = quality.quarantine(rows, spec.rules) if spec.rules else None
        rows = quality.expect(rows, spec.rules)
        if spec.keys:
            rows = cdc.apply_changes(rows, spec.keys, spec.sequence_by, spec.deletes,
                                     spec.except_columns, spec.scd_type)
        built[spec.name] = Built(rows, rejected)
    return built


def per_table(template: Callable[[str, dict], DataFrame], tables: dict[str, dict]) -> dict[str, DataFrame]:
    """The same flow instantiated for every table of a configuration."""
    return {name: template(name, options) for name, options in tables.items()}
