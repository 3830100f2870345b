"""What the classifiers share: which rows are held out, and the labelled rows to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out() -> Column:
    """Rows never learned from: those whose CRC-32 of the decimal ``doc_id`` divides by ``FOLDS``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def to_learn(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, label``, one row per labelled document that is not held out. Rows without id or label are passed
    over; of several labels of a document the largest counts."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)")
    return known.where(~held_out()).groupBy("doc_id").agg(F.max("label").alias("label"))
