"""Quality counts of every batch of a stream, observed while the batch is written.

The counts of a batch are a row of their own in a folder where batches replace themselves, so they add up to those of all messages
after repeated batches too, and no message is read a second time to be counted.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from metricloom.operators.envelope import with_reject_mark
from metricloom.operators.quality import quality_columns
from metricloom.schemas import CORRUPT
from metricloom.sources.tables import TableStore
from metricloom.streaming.runner import Transform, folder_writer, start

COUNTS = "row_count bigint, null_key_count bigint, reject_count bigint"


def counted_writer(
    message: Mapping[str, str] | T.StructType, key: str, store: TableStore, name: str, counts: str, transform: Transform | None = None
) -> Callable[[DataFrame, int], None]:
    """Writer of one batch of text messages (column ``value``): those that can be read to ``name``, and to ``counts`` how many there
    were, how many without ``key`` (a path of the message; of broken messages no key can be read), and how many that cannot be read in full."""
    write_rows, write_counts = folder_writer(store.path(name)), folder_writer(store.path(counts))

    def write(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        read = with_reject_mark(batch, message).observe(seen, *quality_columns(f"parsed.{key}"), F.count_if("rejected").alias("reject_count"))
        rows = read.where(~F.col("rejected")).select("parsed.*").drop(CORRUPT)
        write_rows(rows if transform is None else transform(rows), batch_id)
        found = seen.get
        row = tuple(found.get(c) or 0 for c in ("row_count", "null_key_count", "reject_count"))
        write_counts(batch.sparkSession.createDataFrame([row], COUNTS).coalesce(1), batch_id)

    return write


def stream_with_counts(
    sdf: DataFrame,
    message: Mapping[str, str] | T.StructType,
    key: str,
    store: TableStore,
    name: str,
    counts: str,
    checkpoint: str,
    every: str | None = None,
    transform: Transform | None = None,
) -> StreamingQuery:
    """Run text messages into the table ``name`` and the counts of each batch into ``counts``, both in a folder of tables."""
    if store.is_jdbc:
        raise ValueError("counted batches are written to folders")
    writer = sdf.writeStream.foreachBatch(counted_writer(message, key, store, name, counts, transform)).outputMode("append")
    return start(writer.option("checkpointLocation", checkpoint), every)
