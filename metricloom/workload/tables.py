"""Tables: enrichment, snapshots by day, quality counts, samples and a write-read round trip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom.functions import instant_from_utc, utc_day
from metricloom.operators.quality import quality_counts, sample_rows
from metricloom.plans.enrich import ENRICH, run_enrich
from metricloom.schemas import TABLE_COLUMNS
from metricloom.session import scratch_path
from metricloom.sources.tables import TableStore, read_table, write_snapshot, write_table
from metricloom.workload.bindings import BOUND_SQL, LENGTHS_SQL, cleansed, columns_sql, show_times
from metricloom.workload.registry import Query, table


def _enrich(entity: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return show_times(ENRICH[entity](cleansed(spark, sf_dir, entity)))

    sql = f"SELECT {columns_sql(entity, TABLE_COLUMNS[entity])}, {LENGTHS_SQL[entity]} FROM ({BOUND_SQL[entity]}) AS bound"
    return Query(run, sql)


def _enrich_stored(entity: str) -> Query:
    """The enrichment from a stored table to a stored table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = TableStore(scratch_path(spark, "store"))
        write_table(cleansed(spark, sf_dir, entity), store, entity)
        run_enrich(spark, entity, store, store, entity, f"{entity}_enriched")
        return show_times(read_table(spark, store, f"{entity}_enriched"))

    return Query(run, _enrich(entity).sql)


def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = TableStore(scratch_path(spark, "store"))
    write_table(cleansed(spark, sf_dir, "channels"), store, "channels")
    return show_times(read_table(spark, store, "channels"))


def snapshot_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as daily snapshots; all days are written, then written again in part."""
    store = TableStore(scratch_path(spark, "store"))
    events = table(spark, sf_dir, "events").withColumn("ts", instant_from_utc("ts"))
    dated = events.select("event_id", "event_type", utc_day("ts").alias("snapshot_date"))
    write_snapshot(dated, store, "events")
    later = dated.where(F.dayofmonth("snapshot_date") > 15)
    write_snapshot(later, store, "events")
    counts = read_table(spark, store, "events").groupBy("snapshot_date", "event_type")
    daily = counts.agg(F.count(F.lit(1)).alias("event_count"))
    return daily.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


def quality_counts_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose key is missing for one in a hundred."""
    keyed = table(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 100 != 0, F.col("doc_id")).alias("doc_id"))
    return quality_counts(keyed, "doc_id")


def sample_rows_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_rows(table(spark, sf_dir, "documents"), "doc_id", 15)


QUERIES: dict[str, Query] = {
    **{f"enrich_{entity}": _enrich(entity) for entity in ENRICH},
    **{f"enrich_stored_{entity}": _enrich_stored(entity) for entity in ENRICH},
    "table_roundtrip": Query(
        table_roundtrip, f"SELECT {columns_sql('channels')} FROM ({BOUND_SQL['channels']}) AS bound"
    ),
    "snapshot_partitions": Query(
        snapshot_partitions,
        """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS snapshot_date, event_type, count(*) AS event_count
           FROM events GROUP BY 1, 2""",
    ),
    "quality_counts": Query(
        quality_counts_documents,
        """SELECT count(*) AS row_count, count(*) FILTER (WHERE doc_id % 100 = 0) AS null_key_count FROM documents""",
    ),
    "sample_rows": Query(sample_rows_documents, "SELECT * FROM documents ORDER BY doc_id LIMIT 15"),
}
