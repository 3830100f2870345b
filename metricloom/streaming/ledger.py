"""Appends that can be repeated, for tables whose store can add rows but not replace them.

Every message has an identity: the topic partition or file that it came in, and its place there. A ledger beside the table notes
when the write of a batch begins and when it is done. A batch that is done is passed over; of one that began, only messages that
the table does not hold yet are added. The usual batch, written for the first time, is a plain append without a join.

A batch is repeated after its driver was lost or its write failed. A database task that is repeated because only its answer got
lost commits twice, which no reader of the table can prevent: give the table a unique key over ``IDENTITY`` there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from metricloom.session import materialize
from metricloom.sources.tables import TableStore, read_table, write_table
from metricloom.sources.topics import IDENTITY
from metricloom.streaming.runner import marked, start

LEDGER = "query_id string, batch_id bigint, state string"
BEGUN, DONE = "begun", "done"

Append = Callable[[DataFrame, TableStore, str], None]


def append_rows(rows: DataFrame, store: TableStore, name: str) -> None:
    write_table(rows, store, name, mode="append")


def ledger_writer(store: TableStore, name: str, append: Append = append_rows) -> Callable[[DataFrame, int], None]:
    """Writer of batches that have the ``IDENTITY`` columns into the table ``name``, with the ledger ``<name>_ledger``."""
    ledger = f"{name}_ledger"

    def note(spark: SparkSession, query_id: str, batch_id: int, state: str) -> None:
        write_table(spark.createDataFrame([(query_id, batch_id, state)], LEDGER).coalesce(1), store, ledger, mode="append")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, rows = batch.sparkSession, marked(batch, batch_id)
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        own = (F.col("query_id") == query_id) & (F.col("batch_id") == batch_id)
        if batch_id == 0:
            write_table(spark.createDataFrame([], LEDGER), store, ledger, mode="ignore")
            write_table(rows.limit(0), store, name, mode="ignore")
        states = {r["state"] for r in read_table(spark, store, ledger).where(own).select("state").distinct().collect()}
        if DONE in states:
            return
        if BEGUN in states:
            # Written out first: the append must not change what it is compared with.
            held = materialize(read_table(spark, store, name).where(own).select(*IDENTITY), "held-messages")
            rows = rows.join(held, list(IDENTITY), "left_anti").select(*rows.columns)
        else:
            note(spark, query_id, batch_id, BEGUN)
        append(rows, store, name)
        note(spark, query_id, batch_id, DONE)

    return write


def stream_to_store(
    sdf: DataFrame, store: TableStore, name: str, checkpoint: str, every: str | None = None, append: Append = append_rows
) -> StreamingQuery:
    """Add each row of a stream to a table of any store once. The stream keeps the ``IDENTITY`` of ``read_identified``, one row
    per message."""
    missing = [c for c in IDENTITY if c not in sdf.columns]
    if missing:
        raise ValueError(f"the stream lacks {', '.join(missing)}")
    writer = sdf.writeStream.foreachBatch(ledger_writer(store, name, append)).outputMode("append")
    return start(writer.option("checkpointLocation", checkpoint), every)
