"""Keys for the next pull, each given out once over all pulls.

A stream over the tables that pulls fill. Spark's state store remembers every key that went by, spread over the shuffle
partitions by the key, and the checkpoint keeps it from one run to the next; a run reads new files only. With many millions of keys
use the RocksDB state store (``job_session`` does), which holds them on the executors' disks instead of in memory. The number of
shuffle partitions of the first run stays that of the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from metricloom.sources.landing import fanout_keys
from metricloom.sources.tables import TableStore, read_table
from metricloom.streaming.runner import stream_to_table


def stream_new_keys(
    spark: SparkSession,
    store: TableStore,
    table: str,
    key: str,
    target: str,
    checkpoint: str,
    parent: str | None = None,
    every: str | None = None,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Append to ``target`` the keys, per parent if one is named, that no earlier run has met in ``table``; null keys are left out.

    A run's keys are those of its ``batch_id``s in the target; a repeated batch replaces itself.
    """
    if store.is_jdbc:
        raise ValueError("new keys are read from a folder of tables")
    schema = read_table(spark, store, table).schema
    rows = spark.readStream.schema(schema).options(**(options or {})).parquet(store.path(table))
    return stream_to_table(fanout_keys(rows, key, parent), store, target, checkpoint, every)
