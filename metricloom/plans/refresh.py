"""All reports of a table from one scan of it.

The groups of the reports become grouping sets of one aggregate: a row is read once, expanded to one row per set, and
pre-aggregated before the shuffle like any other report. The grouped rows are written once; a report is the slice of its set.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricloom.plans.dated import with_publish_period
from metricloom.plans.reports import REPORTS, Change, Listing, Report
from metricloom.session import materialize


def grouped_reports(entity: str, names: Collection[str] | None = None) -> dict[str, Report]:
    """The reports of an entity that are grouped measures: no listings, no changes from day to day."""
    return {
        name: spec
        for name, spec in REPORTS.items()
        if spec.entity == entity and not isinstance(spec, (Listing, Change)) and (names is None or name in names)
    }


def grouped_sets(df: DataFrame, specs: dict[str, Report]) -> DataFrame:
    """Every measure for every set of groups, and ``grouping``, which has a bit for each group left out."""
    groups = list(dict.fromkeys(g for spec in specs.values() for g in spec.groups))
    sets = list(dict.fromkeys(tuple(g for g in groups if g in spec.groups) for spec in specs.values()))
    measures = {name: make for spec in specs.values() for name, make in spec.measures.items()}
    grouped = df.groupingSets([[F.col(g) for g in s] for s in sets], *groups)
    return grouped.agg(F.grouping_id().alias("grouping"), *[make().alias(name) for name, make in measures.items()])


def refreshed(entity: str, df: DataFrame, names: Collection[str] | None = None) -> dict[str, DataFrame]:
    """The reports of an entity's table by name, all of them or those named."""
    specs = grouped_reports(entity, names)
    groups = list(dict.fromkeys(g for spec in specs.values() for g in spec.groups))
    if {"year", "month"} & set(groups) and not {"year", "month"} & set(df.columns):
        df = with_publish_period(df)
    rows = materialize(grouped_sets(df, specs), f"refresh-{entity}")
    out = {}
    for name, spec in specs.items():
        left_out = sum(1 << (len(groups) - 1 - i) for i, g in enumerate(groups) if g not in spec.groups)
        out[name] = spec.finish(rows.where(F.col("grouping") == left_out).select(*spec.groups, *spec.measures))
    return out
