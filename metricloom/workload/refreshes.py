"""All charts of a table at once, and daily changes kept up to date."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom.functions import utc_day
from metricloom.plans.changes import update_changes
from metricloom.plans.refresh import grouped_reports, refreshed
from metricloom.plans.reports import REPORTS
from metricloom.schemas import ENTITIES
from metricloom.session import scratch_path
from metricloom.sources.tables import TableStore, read_table, write_snapshot
from metricloom.workload.bindings import reported
from metricloom.workload.registry import Query
from metricloom.workload.reports import NAMES, snapshots
from metricloom.workload.reports import QUERIES as REPORT_QUERIES

SHARES = {"a15": ("video_count_percent", "like_count_sum_percent")}


def _measures(name: str) -> tuple[str, ...]:
    return (*REPORTS[name].measures, *SHARES.get(name, ()))


def _refresh(entity: str) -> Query:
    """One row per chart, group and measure."""
    names = list(grouped_reports(entity))

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        charts = refreshed(entity, reported(spark, sf_dir, entity, ("instagram", "twitter")))
        parts = []
        for name, rows in charts.items():
            key = F.concat_ws("|", *[F.coalesce(F.col(g).cast("string"), F.lit("-")) for g in REPORTS[name].groups])
            values = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in _measures(name)]))
            parts.append(rows.select(F.lit(name).alias("chart"), key.alias("groups"), values.alias("v")).select("chart", "groups", "v.*"))
        return reduce(DataFrame.unionByName, parts)

    sql = []
    for name in names:
        key = ", ".join(f"""coalesce(CAST("{g}" AS VARCHAR), '-')""" for g in REPORTS[name].groups)
        for m in _measures(name):
            sql.append(f"SELECT '{name}' AS chart, concat_ws('|', {key}) AS groups, '{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM ({REPORT_QUERIES[NAMES[name]].sql})")
    return Query(run, " UNION ALL ".join(sql))


def changes_of_late_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily change of views per country: first without the snapshots of every third day, which then come late."""
    store = TableStore(scratch_path(spark, "store"))
    rows = snapshots(spark, sf_dir).withColumnsRenamed({"id": "channel_id"}).withColumn("snapshot_date", utc_day("current_time"))
    late = F.dayofmonth("snapshot_date") % 3 == 0
    days = [(str(r["snapshot_date"]), r["late"]) for r in rows.select("snapshot_date", late.alias("late")).distinct().collect()]
    write_snapshot(rows.where(~late), store, "channels")
    update_changes(spark, store, store, "a26", [d for d, is_late in days if not is_late])
    write_snapshot(rows.where(late), store, "channels")
    update_changes(spark, store, store, "a26", [d for d, is_late in days if is_late])
    return read_table(spark, store, "a26_changes").withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


QUERIES: dict[str, Query] = {
    **{f"refresh_{entity}": _refresh(entity) for entity in ENTITIES},
    "pct_change_late_snapshots": Query(changes_of_late_snapshots, REPORT_QUERIES["pct_change_country"].sql),
}
