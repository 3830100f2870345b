"""New keys, counted batches, repeatable appends, drifting schemas and bucketed snapshots."""

import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from metricloom.operators.drift import schema_drift
from metricloom.operators.envelope import decode_value
from metricloom.schemas import item_schema
from metricloom.session import scratch_path
from metricloom.sources import files
from metricloom.sources.bucketed import day_to_day, group_change, key_change, write_bucketed
from metricloom.sources.tables import TableStore, read_table
from metricloom.sources.topics import IDENTITY, MESSAGE, Topic, read_identified, read_stream
from metricloom.streaming.counts import stream_with_counts
from metricloom.streaming.ledger import append_rows, stream_to_store
from metricloom.streaming.new_keys import stream_new_keys
from metricloom.workload.batches import forget_last_commit
from metricloom.workload.reports import snapshots
from tests.conftest import SMALL


def send(spark, topic, texts):
    rows = spark.createDataFrame([(None, t if t is None else bytearray(t, "utf-8")) for t in texts], MESSAGE)
    rows.coalesce(1).write.mode("append").parquet(topic.name)


def values(spark, store, name="t"):
    return sorted(r.value for r in read_table(spark, store, name).collect())


@pytest.fixture
def pipe(spark):
    topic, store, checkpoint = Topic(scratch_path(spark, "in")), TableStore(scratch_path(spark, "store")), scratch_path(spark, "checkpoint")

    def run(append=append_rows, name="t", source=topic, place=checkpoint):
        rows = read_identified(spark, source).select(F.col("value").cast("string"), *IDENTITY)
        return stream_to_store(rows, store, name, place, append=append)

    return topic, store, checkpoint, run


def test_a_batch_that_is_done_is_passed_over(spark, pipe):
    topic, store, checkpoint, run = pipe
    for texts in (["a", "b", "a"], ["c"]):
        send(spark, topic, texts)
        for _ in range(3):
            run()
            forget_last_commit(spark, checkpoint)
    assert values(spark, store) == ["a", "a", "b", "c"]  # equal messages are two messages
    states = read_table(spark, store, "t_ledger").collect()
    assert sorted((r.batch_id, r.state) for r in states) == [(0, "begun"), (0, "done"), (1, "begun"), (1, "done")]


@pytest.mark.parametrize("kept", ["false", "message_offset < 2", "true"])
def test_a_batch_lost_half_way_is_completed(spark, pipe, kept):
    topic, store, _, run = pipe
    send(spark, topic, [str(i) for i in range(5)])

    def lost(rows, to, name):
        append_rows(rows.where(kept), to, name)
        raise RuntimeError("gone")

    for _ in range(2):
        with pytest.raises(StreamingQueryException, match="gone"):
            run(lost)
    run()
    assert values(spark, store) == [str(i) for i in range(5)]


def test_several_streams_share_a_store(spark, pipe):
    topic, store, _, run = pipe
    send(spark, topic, ["x", "y"])
    run()
    run(place=scratch_path(spark, "checkpoint"))
    assert values(spark, store) == ["x", "x", "y", "y"]
    with pytest.raises(ValueError, match="message_source"):
        stream_to_store(read_stream(spark, topic), store, "t", "unused")


def test_a_first_write_is_a_plain_append(spark, pipe):
    topic, _, _, run = pipe
    send(spark, topic, ["x"])
    plans = []

    def noted(rows, to, name):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        append_rows(rows, to, name)

    run(noted)
    assert len(plans) == 1 and "Join" not in plans[0] and "Exchange" not in plans[0]


def test_new_keys_come_once_over_all_runs(spark):
    store, checkpoint = TableStore(scratch_path(spark, "store")), scratch_path(spark, "checkpoint")
    for pairs in ([("a", 1), ("a", 1), ("b", 1), (None, 2)], [("a", 1), ("a", 2), ("c", 1)], [("c", 1), ("b", 1)]):
        spark.createDataFrame(pairs, "k string, p int").write.mode("append").parquet(store.path("t"))
        for _ in range(2):  # a restart, and a repeated batch
            stream_new_keys(spark, store, "t", "k", "new", checkpoint, "p")
        forget_last_commit(spark, checkpoint)
    stream_new_keys(spark, store, "t", "k", "new", checkpoint, "p")
    found = sorted((r.p, r.k, r.batch_id) for r in read_table(spark, store, "new").collect())
    assert found == [(1, "a", 0), (1, "b", 0), (1, "c", 1), (2, "a", 1)]
    with pytest.raises(ValueError, match="folder"):
        stream_new_keys(spark, TableStore("jdbc:x"), "t", "k", "new", checkpoint)


def test_counts_of_every_batch(spark):
    topic, store, checkpoint = Topic(scratch_path(spark, "in")), TableStore(scratch_path(spark, "store")), scratch_path(spark, "checkpoint")
    for texts in (['{"id": "a", "snippet": {"title": "t"}}', "{", "", None], ['{"snippet": {"title": "t"}}'], ["[", "["]):
        send(spark, topic, texts)
        for _ in range(2):
            stream_with_counts(decode_value(read_stream(spark, topic)), item_schema("channels"), "id", store, "t", "counts", checkpoint, transform=lambda r: r.select("id"))
            forget_last_commit(spark, checkpoint)
    counts = sorted((r.batch_id, r.row_count, r.null_key_count, r.reject_count) for r in read_table(spark, store, "counts").collect())
    assert counts == [(0, 4, 3, 3), (1, 1, 1, 0), (2, 2, 2, 2)]
    assert sorted(str(r.id) for r in read_table(spark, store, "t").collect()) == ["None", "a"]


def test_drift_of_every_kind(spark):
    texts = ['{"a": 1, "o": {"x": true, "y": null}, "l": [1]}', '{"a": 1.5, "o": [], "new": {"in": 1}}', '{"a": "1", "l": {}, "q.r": 2}', "[1]", "7", "", None, "{", "{}", '{"o": {}}']
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    schema = spark.createDataFrame([], "a int, o struct<x: boolean, y: string, z: double>, l array<int>").schema
    found = {(r.field, r.kind, r.message_count, r.status) for r in schema_drift(df, schema).collect()}
    assert found == {
        ("a", "whole", 1, "expected"),
        ("a", "number", 1, "retyped"),
        ("a", "text", 1, "retyped"),
        ("o", "object", 2, "expected"),
        ("o", "array", 1, "retyped"),
        ("o.x", "flag", 1, "expected"),
        ("o.y", "null", 1, "expected"),
        ("o.z", None, 0, "absent"),
        ("l", "array", 1, "expected"),
        ("l", "object", 1, "retyped"),
        ("new", "object", 1, "unknown"),
        ("q.r", "whole", 1, "unknown"),
    }
    assert {r.status for r in schema_drift(df.where("false"), schema).collect()} == {"absent"}


@pytest.fixture(scope="module")
def bucketed(spark):
    rows, name = snapshots(spark, SMALL), f"t_{uuid.uuid4().hex}"
    write_bucketed(rows, TableStore(scratch_path(spark, "store")), "t", "id", ["country"], "view_count", 4, name)
    yield name
    spark.sql(f"DROP TABLE {name}")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_what_is_keyed_needs_no_shuffle(spark, bucketed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = day_to_day(spark, bucketed, "id", "view_count", "2024-01-03", "2024-01-02")
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan(key_change(spark, bucketed, "id", "view_count"))
    assert "Exchange" not in plan(spark.table(bucketed).groupBy("id", "snapshot_date").count())
    sums = plan(group_change(spark, bucketed, ["country"], "view_count")).split("Scan parquet")[0]
    assert sums.count("Exchange hash") <= 2


def test_buckets_hold_the_last_snapshots(spark, bucketed):
    rows = spark.table(bucketed)
    assert rows.count() == rows.select("id", "snapshot_date").distinct().count() > 0
    joined = day_to_day(spark, bucketed, "id", "view_count", "2024-01-03", "2024-01-02")
    days = {d: {r.id: r.view_count for r in rows.where(f"snapshot_date = date'{d}'").collect()} for d in ("2024-01-03", "2024-01-02")}
    found = {r.id: (r.view_count, r.view_count_before) for r in joined.collect()}
    assert found == {k: (days["2024-01-03"].get(k), days["2024-01-02"].get(k)) for k in days["2024-01-03"].keys() | days["2024-01-02"].keys()}
    with pytest.raises(ValueError, match="folder"):
        write_bucketed(rows, TableStore("jdbc:x"), "t", "id", [], "view_count")
    assert files.names(spark, scratch_path(spark, "nothing")) == []
