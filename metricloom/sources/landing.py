"""Landed API documents: a folder per key, one JSON document per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom.operators.pages import PAGE_BYTES, ROWS_PER_TASK, to_envelopes
from metricloom.schemas import CORRUPT, envelope_schema


def land_by_key(
    df: DataFrame,
    path: str,
    key: str,
    item: Column,
    order_by: str,
    page_bytes: int = PAGE_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> None:
    """Write the items of each key under ``path/<key>=<value>/``, a page per file.

    Readers take a whole file as one document, hence one record per file. A key with more
    than ``page_bytes`` of items gets several files.
    """
    documents = to_envelopes(df, key, item, order_by, page_bytes, rows_per_task)
    documents.write.partitionBy(key).option("maxRecordsPerFile", 1).json(path)


def read_documents(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """Landed documents of an entity with the text of the broken ones.

    ``path`` is a folder, read with everything below it, or a glob.
    """
    reader = spark.read.schema(envelope_schema(entity)).option("columnNameOfCorruptRecord", CORRUPT)
    if not any(c in path for c in "*?[{"):
        reader = reader.option("recursiveFileLookup", "true")
    return reader.json(path, multiLine=True)


def read_envelopes(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """The item lists of landed documents."""
    return read_documents(spark, path, entity).select("items")


def broken_documents(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """File and text of documents that could not be read in full, with the number of items
    that were read all the same."""
    documents = read_documents(spark, path, entity).select("*", F.input_file_name().alias("file"))
    broken = documents.select("file", F.size("items").alias("item_count"), F.col(CORRUPT).alias("document"))
    return broken.where(F.col("document").isNotNull())


def fanout_keys(df: DataFrame, key: str, parent: str | None = None) -> DataFrame:
    """Distinct keys, per parent if one is given, that drive the next pull."""
    columns = [key] if parent is None else [parent, key]
    return df.where(F.col(key).isNotNull()).select(*columns).distinct()
