"""Daily changes kept up to date: only the days that have new snapshots are read again.

Two tables per report lie beside each other, partitioned by ``snapshot_date``: the daily sums, and the sums with their percent
changes. An update replaces the sums of the touched days, from those days' snapshots alone, and then the changes of the touched
days and of the days that follow them in any group, because only their previous values can have moved.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metricloom.operators.snapshots import latest_per_day, percent_change
from metricloom.plans.reports import REPORTS, Change
from metricloom.session import materialize
from metricloom.sources import files
from metricloom.sources.tables import TableStore, read_table, write_snapshot

DAY = "snapshot_date"


def snapshots_of(spark: SparkSession, store: TableStore, table: str, days: Sequence[str]) -> DataFrame:
    """Snapshots of some days of a table partitioned by day; other partitions are not read."""
    return read_table(spark, store, table).where(F.col(DAY).isin([date.fromisoformat(d) for d in days])).drop(DAY)


def _rows(spark: SparkSession, store: TableStore, name: str, like: DataFrame) -> DataFrame:
    """A table of days, with the columns of ``like``; it may have no day yet."""
    if any(n.startswith(f"{DAY}=") for n in files.names(spark, store.path(name))):
        return spark.read.schema(like.schema).parquet(store.path(name))
    return like.limit(0)


def _replace_days(spark: SparkSession, rows: DataFrame, store: TableStore, name: str, days: Sequence[str]) -> None:
    """Replace days of a table by ``rows``; days without rows go."""
    written = {str(r[DAY]) for r in rows.select(DAY).distinct().collect()}
    write_snapshot(rows, store, name)
    for day in set(days) - written:
        files.delete(spark, f"{store.path(name)}/{DAY}={day}")


def update_changes(
    spark: SparkSession, snapshots: TableStore, store: TableStore, name: str, days: Sequence[str], table: str | None = None
) -> list[str]:
    """Bring ``<name>_sums`` and ``<name>_changes`` up to date after snapshots of ``days`` were added, replaced or removed.

    Returns the days whose changes were written. Running it again changes nothing, so a failed update is simply repeated: a repetition
    must name all days that were touched since the last update that ended well.
    """
    spec = REPORTS[name]
    if not isinstance(spec, Change):
        raise ValueError(f"{name} is not a report of daily changes")
    days = sorted({str(d) for d in days})
    if not days:
        return []
    sums, changes, value = f"{name}_sums", f"{name}_changes", f"{spec.measure}_sum"
    latest = latest_per_day(snapshots_of(spark, snapshots, table or spec.entity, days), spec.key, spec.groups, spec.measure)
    fresh = materialize(latest.groupBy(*spec.groups, DAY).agg(F.sum(spec.measure).alias(value)), "fresh-sums")
    touched = F.col(DAY).isin([date.fromisoformat(d) for d in days])
    keys = [*spec.groups, DAY]
    # Groups that had a sum on a touched day and have none now concern their next day too. They are noted in a table of their own,
    # so that an update that failed after the sums were replaced still knows of them.
    noted = f"{name}_touched"
    before, left = _rows(spark, store, sums, fresh).select(*keys), _rows(spark, store, noted, fresh.select(*keys))
    concerned = materialize(before.unionByName(left).where(touched).unionByName(fresh.select(*keys)).distinct(), "touched-sums")
    write_snapshot(concerned, store, noted)
    _replace_days(spark, fresh, store, sums, days)
    every = _rows(spark, store, sums, fresh)
    in_order = Window.partitionBy(*spec.groups).orderBy(DAY)
    places = every.select(*keys).unionByName(concerned).distinct()
    following = places.withColumn("next", F.lead(DAY).over(in_order)).where(touched & F.col("next").isNotNull()).select("next").distinct()
    affected = sorted({*days, *(str(r["next"]) for r in following.collect())})
    moved = every.where(F.col(DAY) <= F.lit(affected[-1]).cast("date"))
    changed = moved.withColumn("percent_change", percent_change(F.col(value), F.lag(value).over(in_order)))
    wanted = changed.where(F.col(DAY).isin([date.fromisoformat(d) for d in affected]))
    _replace_days(spark, materialize(wanted.select(*spec.groups, DAY, value, "percent_change"), "changes"), store, changes, affected)
    for day in days:
        files.delete(spark, f"{store.path(noted)}/{DAY}={day}")
    return affected
