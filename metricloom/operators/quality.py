"""Row counts and samples of a cleansed table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricloom.operators.envelope import with_reject_mark


def quality_columns(key: str) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col(key).isNull()).alias("null_key_count"),
    ]


def quality_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows and rows without a key, in one pass."""
    return df.agg(*quality_columns(key))


def message_counts(df: DataFrame, message: Mapping[str, str], key: str) -> DataFrame:
    """Messages, messages without a key, and messages that cannot be read in full."""
    read = with_reject_mark(df, message).select(F.col(f"parsed.{key}").alias(key), "rejected")
    return read.agg(*quality_columns(key), F.count_if("rejected").alias("reject_count"))


def sample_rows(df: DataFrame, key: str, n: int = 15) -> DataFrame:
    """The first ``n`` rows by key, for a look at the data."""
    return df.orderBy(key).limit(n)
