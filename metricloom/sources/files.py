"""Files of any store that Spark's Hadoop configuration opens, for the few steps that are not reads or writes of tables."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _opened(spark, path)
    return store.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    store, place = _opened(spark, path)
    return sorted(f.getPath().getName() for f in store.listStatus(place)) if store.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all that is in it."""
    store, place = _opened(spark, path)
    store.delete(place, True)


def move_new(spark: SparkSession, path: str, to: str) -> bool:
    """Move a folder to a place where nothing is; False if something is there. A rename, so readers see all of it or nothing."""
    store, place = _opened(spark, path)
    _, target = _opened(spark, to)
    if store.exists(target):
        return False
    store.mkdirs(target.getParent())
    return store.rename(place, target)


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that must not exist yet."""
    store, place = _opened(spark, path)
    stream = store.create(place, False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())
