import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricloom.operators.envelope import (
    decode_value,
    flatten_envelope,
    nested_item,
    parse_flat,
    parse_nested,
    project_paths,
    rejects,
    to_json_value,
)
from metricloom.schemas import ENTITIES, ITEM_FIELDS, TABLE_COLUMNS, envelope_schema, item_schema

MESSAGE = {"id": "string", "n": "int"}
TEXTS = [
    ('{"id":"a","n":5}', ("a", 5), False),
    ("{bad", (None, None), True),
    ('{"id":7,"n":"5"}', ("7", None), True),
    ('{"id":"a","n":99999999999}', ("a", None), True),
    ('{"id":"a","n":1,"more":true}', ("a", 1), False),
    ('{"id":"a"}', ("a", None), False),
    ("", (None, None), True),
    (None, (None, None), True),
]
CHANNEL = {
    "kind": "item",
    "id": "c1",
    "snippet": {"title": "T", "description": "D", "publishedAt": "2020-03-08T10:30:00Z", "country": "RS"},
    "statistics": {"subscriberCount": "12", "videoCount": "3", "viewCount": "9999999999"},
    "player": {"embed": "not kept"},
}


def values(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string").coalesce(1)


def test_parse_flat(spark, ansi):
    rows = parse_flat(values(spark, [t[0] for t in TEXTS]), MESSAGE).collect()
    assert [tuple(r) for r in rows] == [t[1] for t in TEXTS]


def test_parse_flat_renames(spark):
    assert parse_flat(values(spark, ["{}"]), MESSAGE, {"n": "count"}).columns == ["id", "count"]


def test_rejects(spark):
    rows = rejects(values(spark, [t[0] for t in TEXTS]), MESSAGE)
    assert rows.columns == ["i", "value"]
    assert sorted(r.i for r in rows.collect()) == [i for i, t in enumerate(TEXTS) if t[2]]


def test_decode_value(spark):
    rows = spark.createDataFrame([(bytearray("é{}", "utf-8"),)], "value binary")
    assert decode_value(rows).first().value == "é{}"


def test_to_json_value_leaves_nulls_out(spark):
    rows = spark.createDataFrame([("a", None, 1), ("b", "x", None)], "k string, s string, n int")
    assert [tuple(r) for r in to_json_value(rows, "n").orderBy("value").collect()] == [
        ("1", '{"k":"a","n":1}'),
        (None, '{"k":"b","s":"x"}'),
    ]
    assert to_json_value(rows).columns == ["value"]


def test_parse_nested_channel(spark, zone):
    row = parse_nested(values(spark, [json.dumps(CHANNEL)]), "channels").withColumn("published_at", F.unix_millis("published_at"))
    assert tuple(row.first()) == ("c1", "T", "D", 1583663400000, "RS", 12, 3, 9999999999)


def test_parse_nested_leave_out(spark):
    columns = parse_nested(values(spark, ["{}"]), "videos", ["made_for_kids"]).columns
    assert "made_for_kids" not in columns and "duration" in columns


def test_flatten_envelope(spark):
    documents = [
        {"etag": "e", "kind": "list", "pageInfo": {"totalResults": 2}, "items": [CHANNEL, {**CHANNEL, "id": "c2"}]},
        {"items": []},
        {"etag": "no items"},
        {"items": [{"id": "c3"}]},
        {"items": [{"id": "c4", "statistics": {"viewCount": "many", "videoCount": "99999999999"}}]},
    ]
    schema = envelope_schema("channels")
    read = values(spark, [json.dumps(d) for d in documents]).select(F.from_json("value", schema).alias("d")).select("d.items")
    rows = flatten_envelope(read, "channels")
    assert rows.columns == list(TABLE_COLUMNS["channels"])
    found = {r.channel_id: r for r in rows.collect()}
    assert sorted(found) == ["c1", "c2", "c3", "c4"]
    assert found["c2"].view_count == 9999999999
    assert found["c3"].channel_title is None and found["c3"].view_count is None
    assert found["c4"].view_count is None and found["c4"].video_count is None


def test_project_paths(spark):
    rows = spark.sql("SELECT named_struct('a', named_struct('b', 1, 'c', 'x')) AS s, 2 AS n")
    out = project_paths(rows, {"b": "s.a.b", "text": "s.a.c", "n": "n"})
    assert out.columns == ["b", "text", "n"] and tuple(out.first()) == (1, "x", 2)


@pytest.mark.parametrize("entity", ENTITIES)
def test_item_schema_holds_every_path(entity):
    for field in ITEM_FIELDS[entity]:
        kind = item_schema(entity)
        for step in field.path.split("."):
            kind = kind[step].dataType
        assert kind.simpleString() == field.arrives


@pytest.mark.parametrize("entity", ENTITIES)
def test_nested_item_round_trip(spark, zone, entity):
    kinds = {f.name: f.becomes for f in ITEM_FIELDS[entity]}
    sample = {"string": "'té\"x'", "bigint": "9999999999", "int": "42", "boolean": "true"}
    # An hour that Los Angeles skips, with microseconds.
    moment = "timestamp_micros(1710064800123456L)"
    full = ", ".join(f"CAST({sample.get(k, moment)} AS {k}) AS {n}" for n, k in kinds.items())
    empty = ", ".join(f"CAST(NULL AS {k}) AS {n}" for n, k in kinds.items())
    rows = spark.sql(f"SELECT {full} UNION ALL SELECT {empty}")
    messages = rows.select(F.to_json(nested_item(rows, entity)).alias("value"))
    back = parse_nested(messages, entity)
    assert back.columns == rows.columns
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_unused_parts_are_not_parsed_and_used_ones_once(spark):
    rows = parse_nested(values(spark, ["{}"]), "channels")
    one = rows.select("channel_title")._jdf.queryExecution().optimizedPlan().toString()
    assert "snippet" in one and "statistics" not in one
    every = rows._jdf.queryExecution().optimizedPlan().toString()
    assert every.count("from_json(") == 1


def test_rejects_of_nested_messages(spark):
    rows = values(spark, [json.dumps(CHANNEL), '{"id": {"not": "text"'])
    assert [r.i for r in rejects(rows, item_schema("channels")).collect()] == [1]
    assert isinstance(item_schema("channels"), T.StructType)
