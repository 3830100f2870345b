"""Daily snapshots bucketed by their key: what is grouped, windowed or joined by key later needs no shuffle.

Rows are reduced to the last of each key and day by a hash aggregate before they are shuffled once, on writing. So a key with very
many snapshots is a row per day by then and cannot fill a bucket. The table is one of Spark's catalog, which knows the buckets; its
files lie in the folder of tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metricloom.operators.snapshots import latest_per_day, percent_change
from metricloom.sources.tables import TableStore

BUCKETS = 512


def write_bucketed(
    df: DataFrame, store: TableStore, name: str, key: str, attributes: Sequence[str], measure: str, buckets: int = BUCKETS, table: str | None = None
) -> str:
    """Write the last snapshot per key and day as a new table of ``buckets`` buckets and return its name in the catalog.
    Columns: ``key, snapshot_date``, the attributes, the measure."""
    if store.is_jdbc:
        raise ValueError("buckets are written to a folder")
    table = table or name
    rows = latest_per_day(df, key, attributes, measure).repartition(buckets, key)
    rows.write.format("parquet").bucketBy(buckets, key).sortBy(key, "snapshot_date").option("path", store.path(name)).saveAsTable(table)
    return table


def group_change(spark: SparkSession, table: str, groups: Sequence[str], measure: str) -> DataFrame:
    """Sum of ``measure`` per group and day with its percent change, from a bucketed table. Only the sums are shuffled."""
    value = f"{measure}_sum"
    daily = spark.table(table).groupBy(*groups, "snapshot_date").agg(F.sum(measure).alias(value))
    by_day = Window.partitionBy(*groups).orderBy("snapshot_date")
    return daily.select(*groups, "snapshot_date", value, percent_change(F.col(value), F.lag(value).over(by_day)).alias("percent_change"))


def key_change(spark: SparkSession, table: str, key: str, measure: str) -> DataFrame:
    """``measure`` of each key and day with the percent change from the key's previous snapshot day; nothing is shuffled."""
    by_day = Window.partitionBy(key).orderBy("snapshot_date")
    change = percent_change(F.col(measure), F.lag(measure).over(by_day))
    return spark.table(table).select(key, "snapshot_date", measure, change.alias("percent_change"))


def day_to_day(spark: SparkSession, table: str, key: str, measure: str, day: str, before: str) -> DataFrame:
    """``key`` with ``measure`` on two days, keys of either day; the two sides lie in the same buckets and are joined where they lie."""
    rows = spark.table(table)
    at = lambda d, name: rows.where(F.col("snapshot_date") == F.lit(d).cast("date")).select(key, F.col(measure).alias(name))
    return at(day, measure).join(at(before, f"{measure}_before"), key, "full")
