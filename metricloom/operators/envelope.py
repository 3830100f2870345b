"""Nested API documents and JSON messages to flat rows, and back."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricloom.functions.casts import document_instant, to_instant, whole_number
from metricloom.schemas import CORRUPT, ITEM_FIELDS, Field, item_schema, struct_of


def _typed(value: Column, field: Field, instant: Callable[[Column], Column]) -> Column:
    if field.becomes == field.arrives:
        return value
    if field.becomes == "timestamp":
        return instant(value)
    return whole_number(value, field.becomes)


def project_fields(
    df: DataFrame, fields: Iterable[Field], root: str, keep: Iterable[str] = (), instant: Callable[[Column], Column] = to_instant
) -> DataFrame:
    """One flat, typed column per field of the struct column ``root``; ``instant`` reads times."""
    columns = [_typed(F.col(f"{root}.{f.path}"), f, instant).alias(f.name) for f in fields]
    return df.select(*keep, *columns)


def project_paths(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """Nested values by dotted path, renamed: ``{"author": "snippet.author.value"}``."""
    return df.select(*[F.col(path).alias(name) for name, path in paths.items()])


def flatten_envelope(df: DataFrame, entity: str) -> DataFrame:
    """One typed row per element of ``items``; documents with no items give no rows and
    everything else in the envelope is left behind. Times must have the documents' own form."""
    items = df.select(F.explode("items").alias("item"))
    return project_fields(items, ITEM_FIELDS[entity], "item", instant=document_instant)


def decode_value(df: DataFrame) -> DataFrame:
    """Message bytes as text."""
    return df.select(F.col("value").cast("string").alias("value"))


def parse_flat(
    df: DataFrame, message: Mapping[str, str], renames: Mapping[str, str] | None = None
) -> DataFrame:
    """Columns of a flat JSON message; ``message`` maps its declared columns to types.

    Unreadable text gives a row of NULLs and a value of the wrong type gives NULL.
    """
    schema = struct_of(message)
    names = renames or {}
    parsed = df.select(F.from_json("value", schema).alias("message"))
    return parsed.select(*[F.col(f"message.{f.name}").alias(names.get(f.name, f.name)) for f in schema])


def parse_nested(df: DataFrame, entity: str, leave_out: Iterable[str] = ()) -> DataFrame:
    """Typed columns of a message that holds one API item."""
    skipped = set(leave_out)
    fields = [f for f in ITEM_FIELDS[entity] if f.name not in skipped]
    parsed = df.select(F.from_json("value", item_schema(entity)).alias("item"))
    return project_fields(parsed, fields, "item")


def to_json_value(df: DataFrame, key: str | None = None) -> DataFrame:
    """Each row as a ``value`` of JSON text, with a text ``key`` if a key column is named.
    NULL columns are left out of the JSON."""
    value = F.to_json(F.struct("*")).alias("value")
    if key is None:
        return df.select(value)
    return df.select(F.col(key).cast("string").alias("key"), value)


def with_reject_mark(df: DataFrame, message: Mapping[str, str] | T.StructType) -> DataFrame:
    """``df`` plus the ``parsed`` message and whether it is ``rejected``: broken JSON, a
    value of the wrong type, or no text at all."""
    schema = message if isinstance(message, T.StructType) else struct_of(message)
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json("value", with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})
    read = df.select("*", parsed.alias("parsed"))
    rejected = F.col("parsed").isNull() | F.col(f"parsed.{CORRUPT}").isNotNull()
    return read.withColumn("rejected", rejected)


def rejects(df: DataFrame, message: Mapping[str, str] | T.StructType) -> DataFrame:
    """The rows whose ``value`` cannot be read as the declared message in full."""
    return with_reject_mark(df, message).where("rejected").drop("parsed", "rejected")


def _iso(c: Column) -> Column:
    """ISO-8601 UTC text of an instant. The zone-less timestamp in between keeps the session
    zone, and the hours it skips in spring, out of it."""
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(c), F.expr("timestamp_ntz'1970-01-01 00:00:00'"))
    return F.concat(F.replace(utc.cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def _as_item(members: list[tuple[list[str], Column]]) -> Column:
    groups: dict[str, list[tuple[list[str], Column]]] = {}
    for path, value in members:
        groups.setdefault(path[0], []).append((path[1:], value))
    parts = []
    for name, inside in groups.items():
        value = inside[0][1] if inside[0][0] == [] else _as_item(inside)
        parts.append(value.alias(name))
    return F.struct(*parts)


def nested_item(df: DataFrame, entity: str) -> Column:
    """The API item of a flat row: the inverse of the projection. Columns that ``df`` does
    not have are left out."""
    members = []
    for field in ITEM_FIELDS[entity]:
        if field.name not in df.columns:
            continue
        value = F.col(field.name)
        if field.becomes == "timestamp":
            value = _iso(value)
        elif field.becomes != field.arrives:
            value = value.cast(field.arrives)
        members.append((field.path.split("."), value))
    return _as_item(members)
