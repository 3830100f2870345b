"""Messages to a table, and those that cannot be read to a table of dead letters.

Each batch is parsed once and kept while both tables are written. Both are folders in which a batch is a partition written whole,
so after a repeated batch every message still stands once, in one of the two.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from metricloom.operators.envelope import with_reject_mark
from metricloom.schemas import CORRUPT
from metricloom.sources.tables import TableStore
from metricloom.streaming.runner import Transform, folder_writer, start

EMPTY, BROKEN, MISFIT = "empty", "broken", "misfit"


def reject_reason(value: Column) -> Column:
    """Why a rejected message cannot be read: nothing in it, no JSON, or JSON that does not fit the declared columns."""
    blank = value.isNull() | (F.trim(value) == "")
    return F.when(blank, EMPTY).when(F.try_parse_json(value).isNull(), BROKEN).otherwise(MISFIT)


def both_writer(
    message: Mapping[str, str] | T.StructType, store: TableStore, good: str, rejected: str, transform: Transform | None = None
) -> Callable[[DataFrame, int], None]:
    """Writer of one batch of text messages (column ``value``): readable ones as the declared columns, through ``transform``,
    and the others as ``value, reason``."""
    write_good, write_rejected = folder_writer(store.path(good)), folder_writer(store.path(rejected))

    def write(batch: DataFrame, batch_id: int) -> None:
        read = with_reject_mark(batch, message).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = read.where(~F.col("rejected")).select("parsed.*").drop(CORRUPT)
            write_good(rows if transform is None else transform(rows), batch_id)
            write_rejected(read.where("rejected").select("value", reject_reason(F.col("value")).alias("reason")), batch_id)
        finally:
            read.unpersist()

    return write


def stream_with_rejects(
    sdf: DataFrame,
    message: Mapping[str, str] | T.StructType,
    store: TableStore,
    good: str,
    rejected: str,
    checkpoint: str,
    every: str | None = None,
    transform: Transform | None = None,
) -> StreamingQuery:
    """Run text messages into the tables ``good`` and ``rejected`` of a folder of tables."""
    if store.is_jdbc:
        raise ValueError("dead letters are written to folders")
    writer = sdf.writeStream.foreachBatch(both_writer(message, store, good, rejected, transform)).outputMode("append")
    return start(writer.option("checkpointLocation", checkpoint), every)
