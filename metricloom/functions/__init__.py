"""Column expressions. Every function is built from native Spark expressions, so the
same call works on batch and streaming DataFrames and stays on the JVM side."""

from metricloom.functions.casts import document_instant, to_instant, to_int, to_key, to_long, whole_number
from metricloom.functions.dates import (
    duration_seconds,
    instant_from_utc,
    publish_month,
    publish_month_number,
    publish_year,
    utc_day,
    with_snapshot_time,
)
from metricloom.functions.lookup import category_name, with_category
from metricloom.functions.text import (
    NETWORKS,
    keyword_count,
    keyword_counts,
    strip_punct,
    word_count,
)

__all__ = [
    "NETWORKS",
    "category_name",
    "document_instant",
    "duration_seconds",
    "instant_from_utc",
    "keyword_count",
    "keyword_counts",
    "publish_month",
    "publish_month_number",
    "publish_year",
    "strip_punct",
    "to_instant",
    "to_int",
    "to_key",
    "to_long",
    "utc_day",
    "whole_number",
    "with_category",
    "with_snapshot_time",
    "word_count",
]
