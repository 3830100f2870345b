"""The landing tree: folders named by keys on several levels, and one API document per file below them.

    <landing>/channels/<channel_id>/statistics/page-000000.json
    <landing>/channels/<channel_id>/playlists/page-000000.json
    <landing>/channels/<channel_id>/videos/<video_id>/statistics/page-000000.json
    <landing>/channels/<channel_id>/videos/<video_id>/content/page-000000.json

Folder names are the keys alone, which a partitioned write cannot make, so each task writes the files of its own
documents: under a name of its own attempt first, then moved to the final one. A task that is run again writes the same
files. Pages that an earlier, larger landing of a key left behind are removed at the end, folder by folder in parallel.

Keys are percent-encoded where a path or a listing would misread them; a missing key is the folder ``%``, an empty one ``%%``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom.operators.pages import PAGE_BYTES, ROWS_PER_TASK, to_envelopes
from metricloom.session import materialize
from metricloom.sources.landing import read_documents

# Where the documents of each entity lie under the landing folder, keys in braces.
TREES = {
    "channels": "channels/{channel_id}/statistics",
    "playlists": "channels/{channel_id}/playlists",
    "videos": "channels/{channel_id}/videos/{video_id}/statistics",
    "comments": "channels/{channel_id}/videos/{video_id}/content",
}
MISSING, EMPTY = "%", "%%"
PAGE = "page-{:06d}.json"
PAGE_NAME = re.compile(r"page-([0-9]{6,})\.json")


def tree_keys(entity: str) -> list[str]:
    return re.findall(r"\{(\w+)\}", TREES[entity])


def folder_name(key: Column) -> Column:
    """The folder of a key. Listings pass over names that begin with a dot or an underscore."""
    text = key.cast("string")
    coded = F.replace(F.replace(F.url_encode(text), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A"))
    first = F.substring(coded, 1, 1)
    safe = F.when(first == ".", F.concat(F.lit("%2E"), F.substring(coded, 2, 1 << 20))).when(first == "_", F.concat(F.lit("%5F"), F.substring(coded, 2, 1 << 20)))
    return F.when(text.isNull(), MISSING).when(text == "", EMPTY).otherwise(F.coalesce(safe, coded))


def key_of_folder(name: Column) -> Column:
    """The inverse of ``folder_name``; a name that others gave and that is not encoded stands for itself."""
    return F.when(name == MISSING, F.lit(None).cast("string")).when(name == EMPTY, "").otherwise(F.coalesce(F.try_url_decode(name), name))


def tree_folder(entity: str, keys: Mapping[str, Column]) -> Column:
    """Path of the folder of a row's document, below the landing folder."""
    missing = set(tree_keys(entity)) - set(keys)
    if missing:
        raise ValueError(f"{entity} are landed by {', '.join(tree_keys(entity))}; missing: {', '.join(sorted(missing))}")
    levels = [folder_name(keys[level[1:-1]]) if level.startswith("{") else F.lit(level) for level in TREES[entity].split("/")]
    return F.concat_ws("/", *levels)


def _store_of(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/(?=[^/])", "file:///", path))
    return pafs.FileSystem.from_uri(f"file://{path}")


def land_tree(
    df: DataFrame,
    landing: str,
    entity: str,
    keys: Mapping[str, Column],
    item: Column,
    order_by: str,
    page_bytes: int = PAGE_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Write the items of each key's folder, a page per file; returns ``folder, pages, items`` of what was written.

    ``landing`` may be in any store that ``pyarrow.fs`` opens by its address. Rows of one folder become documents as
    ``to_envelopes`` says, so a folder with a third of all rows is dealt over many tasks.
    """
    rows = df.select(tree_folder(entity, keys).alias("folder"), F.col(order_by).alias("row_key"), item.alias("item"))
    envelopes = to_envelopes(rows, "folder", F.col("item"), "row_key", page_bytes, rows_per_task)
    body = [c for c in envelopes.columns if c != "folder"]
    documents = envelopes.select(
        "folder", F.col("pageInfo.pageNumber").cast("bigint").alias("page"), F.size("items").cast("bigint").alias("items"), F.to_json(F.struct(*body)).alias("document")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store_of(landing)
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for folder, page, document in zip(*(batch[c].to_pylist() for c in ("folder", "page", "document")), strict=True):
                place = f"{root}/{folder}"
                store.create_dir(place, recursive=True)
                part, final = f"{place}/.{attempt}-{PAGE.format(page)}", f"{place}/{PAGE.format(page)}"
                with store.open_output_stream(part, compression=None) as out:
                    out.write(document.encode("utf-8"))
                store.move(part, final)
            yield batch.select(["folder", "page", "items"])

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store_of(landing)
        for batch in batches:
            for folder, pages in zip(batch["folder"].to_pylist(), batch["pages"].to_pylist(), strict=True):
                for file in store.get_file_info(pafs.FileSelector(f"{root}/{folder}")):
                    number = PAGE_NAME.fullmatch(file.base_name)
                    if number is not None and int(number[1]) >= pages:
                        store.delete_file(file.path)
            yield batch

    written = materialize(documents.mapInArrow(write, "folder string, page bigint, items bigint"), f"landed-{entity}")
    folders = written.groupBy("folder").agg((F.max("page") + 1).alias("pages"), F.sum("items").alias("items"))
    return materialize(folders.mapInArrow(prune, "folder string, pages bigint, items bigint"), f"landed-folders-{entity}")


def read_tree(spark: SparkSession, landing: str, entity: str) -> DataFrame:
    """Documents of an entity as ``read_documents`` gives them, and the keys of their folders as ``folder_<key>``.

    Reads pages as well as single files in the place of the last folder, as a crawl may leave them.
    """
    levels = TREES[entity].split("/")
    glob = "/".join("*" if level.startswith("{") else level for level in levels)
    pattern = "/".join("([^/]+)" if level.startswith("{") else level for level in levels) + "(?:/[^/]+)?$"
    # The address of a file is encoded once more.
    path = F.col("_metadata.file_path")
    found = {f"folder_{key}": key_of_folder(F.url_decode(F.regexp_extract(path, f"/{pattern}", i))) for i, key in enumerate(tree_keys(entity), 1)}
    documents = read_documents(spark, f"{landing}/{glob}", entity)
    return documents.select("*", *[c.alias(n) for n, c in found.items()])
