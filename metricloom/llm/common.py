"""Small helpers of the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of every contract: the blank and U+0009 to U+000D.
SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACES = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def packed(docs: DataFrame, **keys: Column) -> DataFrame:
    """The rows of ``docs`` as one column ``row`` beside the keys, so that no column of theirs can clash with another's;
    ``select("row.*")`` gives them back."""
    return docs.select(F.struct("*").alias("row"), *[column.alias(name) for name, column in keys.items()])


def id_keys() -> dict[str, Column]:
    """``doc_id`` in two keys without nulls, for joins that hold null ids equal."""
    return {"id": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0).cast("bigint")), "no_id": F.col("doc_id").isNull()}


def map_arrow(
    df: DataFrame, schema: str, rows: Callable[[pa.RecordBatch], dict[str, object] | None], piece: int = 512
) -> DataFrame:
    """``mapInArrow`` over slices of at most ``piece`` rows, so that a task holds few long texts at a
    time whatever the session's batch size; ``rows`` returns the columns of ``schema`` by name."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def column(values: object, kind: pa.DataType) -> pa.Array:
        return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, piece):
                out = rows(batch.slice(start, piece))
                if out is not None:
                    yield pa.RecordBatch.from_arrays([column(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


class Shared:
    """An object broadcast to tasks, class and all. A worker unpacks it once and keeps it, with whatever the
    object remembers, for the tasks of the stage that it runs. Only for objects of bounded size."""

    def __init__(self, spark: SparkSession, thing: object):
        self.packed = spark.sparkContext.broadcast(cloudpickle.dumps(thing))

    @property
    def value(self) -> object:
        kept = self.packed.__dict__
        if "unpacked" not in kept:
            kept["unpacked"] = cloudpickle.loads(self.packed.value)
        return kept["unpacked"]
