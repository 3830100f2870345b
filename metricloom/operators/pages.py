"""Grouping items into API response documents of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricloom.session import materialize

# Rows of one key that one task sorts; a key with more is split by ranges of its order.
ROWS_PER_TASK = 250_000
# JSON bytes after which a page ends: an aggregate may hold as many as 128 pages before it
# turns to sorting, so this bounds a task to some hundred MB of items.
PAGE_BYTES = 2 * 1024 * 1024

ORDER = ["item_order", "item_tie"]
UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``hot_key``: the keys with more than ``rows_per_task`` rows, at most one in as many rows.

    They are counted with partial counts and written to the shared folder, so joins see their
    true size and broadcast them only below Spark's threshold.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("key_rows"))
    return materialize(counts.where(F.col("key_rows") > rows_per_task).select(F.col(key).alias("hot_key")), "hot-keys")


def _numbered(rows: DataFrame, within: list[str], page_bytes: int) -> DataFrame:
    """``rows`` with ``page`` and ``position`` in their key. ``bytes_before`` and ``rows_before`` are what the key holds
    ahead of the rows of ``within``, ``key_rows`` what it holds in all."""
    before = Window.partitionBy(*within).orderBy(*ORDER).rowsBetween(*UP_TO_HERE)
    start = F.col("bytes_before") + F.sum("item_bytes").over(before) - F.col("item_bytes")
    position = F.col("rows_before") + F.count(F.lit(1)).over(before) - 1
    return rows.withColumns({"page": F.call_function("div", start, F.lit(page_bytes)), "position": position})


def _in_ranges(rows: DataFrame, page_bytes: int) -> DataFrame:
    """Pages of hot keys: rows are dealt by ranges of key and order, what each key holds in the
    ranges before is added up from one row per range, and pages come out as if never dealt."""
    dealt = rows.repartitionByRange("page_key", *ORDER).withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "hot-rows")
    sums = dealt.groupBy("page_key", "part").agg(F.sum("item_bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("page_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("page_key")
    ahead = materialize(
        sums.select(
            F.col("page_key").alias("ahead_key"),
            F.col("part").alias("ahead_part"),
            F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
            F.sum("rows").over(whole).alias("key_rows"),
        ),
        "hot-ranges",
    )
    same = F.col("page_key").eqNullSafe(F.col("ahead_key")) & (F.col("part") == F.col("ahead_part"))
    return _numbered(dealt.join(ahead, same), ["page_key", "part"], page_bytes)


def paged_items(
    df: DataFrame,
    key: str,
    item: Column,
    order_by: str,
    page_bytes: int = PAGE_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``page_key, page, position, key_rows, item``: every item with its page and its place among its key's.

    A page begins with the first item that starts at or beyond a multiple of ``page_bytes`` of the key's JSON.
    Items follow ``order_by``, equal ones a hash of their content, whatever the number of rows of the key.
    """
    text = F.to_json(item)
    items = df.select(
        F.col(key).alias("page_key"),
        F.col(order_by).alias("item_order"),
        F.xxhash64(text).alias("item_tie"),
        F.octet_length(text).cast("bigint").alias("item_bytes"),
        item.alias("item"),
    )
    hot = hot_keys(items, "page_key", rows_per_task)
    is_hot = F.col("page_key").eqNullSafe(F.col("hot_key"))
    rows = F.count(F.lit(1)).over(Window.partitionBy("page_key"))
    alone = {"bytes_before": F.lit(0).cast("bigint"), "rows_before": F.lit(0).cast("bigint"), "key_rows": rows}
    columns = ("page_key", "page", "position", "key_rows", "item")
    cold = _numbered(items.join(hot, is_hot, "left_anti").withColumns(alone), ["page_key"], page_bytes).select(*columns)
    if hot.isEmpty():
        return cold
    return cold.unionByName(_in_ranges(items.join(hot, is_hot, "left_semi"), page_bytes).select(*columns))


def to_envelopes(
    df: DataFrame,
    key: str,
    item: Column,
    order_by: str,
    page_bytes: int = PAGE_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """One document per key and page; the items of a page are in order.

    ``pageInfo`` has the page's number and the place of its first item; ``nextPageToken`` is the place at which the
    next page begins, and the last page of a key has none. A page may be larger than ``page_bytes`` by one item.
    The items of keys that are not hot are shuffled once: numbering and collecting keep that partitioning.
    """
    paged = paged_items(df, key, item, order_by, page_bytes, rows_per_task)
    pages = paged.groupBy("page_key", "page").agg(
        F.array_sort(F.collect_list(F.struct("position", "item"))).alias("placed"),
        F.min("position").alias("first"),
        F.max("position").alias("last"),
        F.max("key_rows").alias("key_rows"),
    )
    return pages.select(
        F.col("page_key").alias(key),
        F.struct(F.size("placed").alias("resultsPerPage"), F.col("page").alias("pageNumber"), F.col("first").alias("firstItem")).alias("pageInfo"),
        F.when(F.col("last") + 1 < F.col("key_rows"), (F.col("last") + 1).cast("string")).alias("nextPageToken"),
        F.transform("placed", lambda p: p["item"]).alias("items"),
    )
