"""The corpus pipeline: from ``documents`` to token ids.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows that the stage before it kept, and gives a
DataFrame that is written as Parquet to the shared folder and read again for the next. All but the last give
the columns of ``documents``.

Nulls, empty and very long texts, repeated rows and further columns are treated as each operator's module says;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from metricloom.llm import bpe, exact_dedup, mixing, simhash, toxicity
from metricloom.llm.common import table
from metricloom.llm.queries import VOCABULARY
from metricloom.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below one half; learned from the labels that are not held out."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest ``doc_id``."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by SimHash fingerprints, over three words and within three bits, the row with the smallest ``doc_id``."""
    return simhash.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once, or up to three times."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row."""
    return bpe.encode_documents(docs, VOCABULARY)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# The toxicity stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
