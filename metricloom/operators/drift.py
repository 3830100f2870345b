"""Where messages depart from the declared schema: fields that nobody declared, that changed their kind, or that never come.

Messages are read as variants, so nothing needs to be known of them. The objects that the schema declares are looked into, down to
its leaves; what lies inside undeclared objects and inside arrays is not. Counting is an aggregate by field and kind, reduced before
the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricloom.schemas import struct_of
from metricloom.session import materialize

# Kinds of JSON values by the type that a variant of them has.
KINDS = {
    "VOID": "null",
    "BOOLEAN": "flag",
    "BIGINT": "whole",
    "DECIMAL": "number",
    "DOUBLE": "number",
    "STRING": "text",
    "OBJECT": "object",
    "ARRAY": "array",
}
EXPECTED, RETYPED, UNKNOWN, ABSENT = "expected", "retyped", "unknown", "absent"


def _accepted(kind: T.DataType) -> list[str]:
    """Kinds that the declared type may have in JSON; null always may stand there."""
    if isinstance(kind, T.StructType):
        own = ["object"]
    elif isinstance(kind, T.ArrayType):
        own = ["array"]
    elif isinstance(kind, T.MapType):
        own = ["object"]
    elif isinstance(kind, T.BooleanType):
        own = ["flag"]
    elif isinstance(kind, T.IntegralType):
        own = ["whole"]
    elif isinstance(kind, T.NumericType):
        own = ["number", "whole"]
    else:
        own = ["text"]
    return [*own, "null"]


def _paths(schema: T.StructType, above: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], T.DataType]]:
    for field in schema.fields:
        path = (*above, field.name)
        yield path, field.dataType
        if isinstance(field.dataType, T.StructType):
            yield from _paths(field.dataType, path)


def kind_of(value: Column) -> Column:
    """The kind of a variant."""
    names = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    return names[F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)]


def field_kinds(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``field, kind, message_count`` over the JSON texts in ``value``: how many messages hold a value of a kind in a field, which is named by
    its path with dots. Texts that are no JSON, and JSON that is no object, count nowhere."""
    spark = df.sparkSession
    parsed = df.select(F.try_parse_json("value").alias("message"))
    places = [("", F.col("message"))]
    for path, kind in _paths(schema):
        if isinstance(kind, T.StructType):
            steps = "$" + "".join(f'["{p}"]' for p in path)
            places.append((".".join(path) + ".", F.try_variant_get("message", steps, "variant")))
    objects = parsed.select(F.explode(F.array(*[F.struct(F.lit(p).alias("prefix"), v.alias("object")) for p, v in places])).alias("o")).select("o.*")
    members = objects.lateralJoin(spark.tvf.variant_explode(F.col("object").outer())).where(F.col("key").isNotNull())
    field = F.concat("prefix", "key").alias("field")
    return members.groupBy(field, kind_of(F.col("value")).alias("kind")).agg(F.count(F.lit(1)).alias("message_count"))


def schema_drift(df: DataFrame, message: Mapping[str, str] | T.StructType) -> DataFrame:
    """``field, kind, message_count, status`` of the texts in ``value``: each field and kind that occurs is ``expected``, ``retyped`` (declared, but
    not with that kind) or ``unknown``; declared fields that no message holds are ``absent``, with no kind and a count of 0."""
    schema = message if isinstance(message, T.StructType) else struct_of(message)
    accepted = {".".join(path): _accepted(kind) for path, kind in _paths(schema)}
    declared = F.create_map(*[x for name, kinds in accepted.items() for x in (F.lit(name), F.array(*map(F.lit, kinds)))])
    known = declared[F.col("field")]
    status = F.when(known.isNull(), UNKNOWN).when(F.array_contains(known, F.col("kind")), EXPECTED).otherwise(RETYPED)
    # Written out, so that the messages are read once; it has a row per field and kind.
    found = materialize(field_kinds(df, schema), "field-kinds")
    names = df.sparkSession.createDataFrame([(name,) for name in accepted], "field string")
    present = found.where(F.col("field").isin(*accepted)).select("field").distinct()
    absent = names.join(present, "field", "left_anti")
    return found.withColumn("status", status).unionByName(
        absent.select("field", F.lit(None).cast("string").alias("kind"), F.lit(0).cast("bigint").alias("message_count"), F.lit(ABSENT).alias("status"))
    )
