"""Streaming sinks and the runner that ties a source, a transform and a sink together.

All queries are stateless and append-only. Each has a checkpoint of its own, so it goes on
where it stopped. Without ``every`` a query takes what is there and ends, as a daily
snapshot does; with ``every`` it goes on, one batch per interval.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from metricloom.sources import files
from metricloom.sources.tables import TableStore, write_table
from metricloom.sources.topics import Topic, read_stream, topic_rows

Transform = Callable[[DataFrame], DataFrame]
Sink = Callable[[DataFrame], StreamingQuery]


def start(writer: DataStreamWriter, every: str | None) -> StreamingQuery:
    if every is not None:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def marked(batch: DataFrame, batch_id: int) -> DataFrame:
    """The batch with the query and batch it came from. The query id is kept in the
    checkpoint: it survives restarts, and a new checkpoint has another one."""
    query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return batch.select("*", F.lit(query_id).alias("query_id"), F.lit(batch_id).cast("bigint").alias("batch_id"))


def folder_writer(path: str, partition_by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """Add each batch to a folder as a partition of its own (below those of
    ``partition_by``). It is written whole, so a batch repeated after a failure replaces
    itself, and batches of other queries or checkpoints are never touched."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            marked(batch, batch_id)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by, "query_id", "batch_id")
            .parquet(path)
        )

    return write


def topic_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Add each batch to a folder topic exactly once: it is written aside, under a name that listings pass over, and moved to
    the folder of its query and batch unless that is there already. So a repeated batch brings no new files, and a stream
    that reads the topic, whatever it has read so far, meets each message once. The store must move folders in one step, as
    HDFS and local folders do."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        final = f"{path}/query_id={query_id}/batch_id={batch_id}"
        if files.exists(spark, final):
            return
        aside = f"{path}/_staged/{uuid.uuid4().hex}"
        batch.write.parquet(aside)
        if not files.move_new(spark, aside, final):
            files.delete(spark, aside)

    return write


def database_writer(store: TableStore, name: str) -> Callable[[DataFrame, int], None]:
    """Append each batch to a database table. A batch repeated after a failure is added
    again; its query and batch ids tell."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_table(marked(batch, batch_id), store, name, mode="append")

    return write


def stream_to_topic(
    sdf: DataFrame, topic: Topic, checkpoint: str, key: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Send each row as a JSON message, keyed by the text of ``key`` if one is named; to a folder exactly once."""
    writer = topic_rows(sdf, key).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if topic.is_folder:
        return start(writer.foreachBatch(topic_writer(topic.name)), every)
    kind, options = topic.writer()
    return start(writer.format(kind).options(**options), every)


def stream_to_table(
    sdf: DataFrame,
    store: TableStore,
    name: str,
    checkpoint: str,
    every: str | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append each micro-batch to a table, marked with ``query_id`` and ``batch_id``."""
    write = database_writer(store, name) if store.is_jdbc else folder_writer(store.path(name), partition_by)
    writer = sdf.writeStream.foreachBatch(write).outputMode("append")
    return start(writer.option("checkpointLocation", checkpoint), every)


def preview_stream(sdf: DataFrame, every: str | None = None, memory: str | None = None) -> StreamingQuery:
    """Print the rows of each batch, or keep them in the named in-memory view."""
    writer = sdf.writeStream.outputMode("append")
    if memory is None:
        return start(writer.format("console").option("truncate", "false"), every)
    return start(writer.format("memory").queryName(memory), every)


def run_stream(spark: SparkSession, source: Topic, transform: Transform, sink: Sink) -> StreamingQuery:
    return sink(transform(read_stream(spark, source)))
