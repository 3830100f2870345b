"""Packed tables, dead letters and topics that hold each message once, also when batches are repeated."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from metricloom.operators.envelope import decode_value
from metricloom.schemas import item_schema
from metricloom.session import scratch_path
from metricloom.sources import files
from metricloom.sources.tables import TableStore, read_table
from metricloom.sources.topics import MESSAGE, Topic, read_stream, read_topic
from metricloom.streaming import compaction
from metricloom.streaming.compaction import Version, compact, current, read_compacted, vacuum, versions
from metricloom.streaming.dead_letters import both_writer, reject_reason, stream_with_rejects
from metricloom.streaming.runner import folder_writer, stream_to_topic, topic_writer
from metricloom.workload.batches import forget_last_commit


@pytest.fixture
def as_query(spark):
    """Run batch writers as if a stream of the given id did."""

    def run(write, query, frame, batch):
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", query)
        try:
            write(frame, batch)
        finally:
            spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)

    return run


def fill(spark, as_query, path, batches, query="q1", partition_by=()):
    write = folder_writer(path, partition_by)
    for batch in batches:
        rows = spark.range(batch * 10, batch * 10 + 10).select("id", (F.col("id") % 3).alias("third"))
        as_query(write, query, rows.coalesce(1), batch)


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def packed_files(path):
    return glob.glob(f"{path}/_packed/**/*.parquet", recursive=True)


def test_small_batches_become_one_file(spark, as_query):
    path = scratch_path(spark, "table")
    fill(spark, as_query, path, range(40))
    assert read_compacted(spark, path).count() == 400 and current(spark, path) == Version()
    version = compact(spark, path)
    assert version.upto == {"q1": 38} and len(packed_files(path)) == 1
    assert ids(read_compacted(spark, path)) == list(range(400))
    assert ids(spark.read.parquet(path)) == list(range(400))  # readers that know nothing of it
    assert compact(spark, path) == version
    assert vacuum(spark, path) == 39
    assert ids(read_compacted(spark, path)) == list(range(400)) and len(glob.glob(f"{path}/query_id=q1/*")) == 1


def test_files_keep_to_the_target_size(spark, as_query):
    path = scratch_path(spark, "table")
    fill(spark, as_query, path, range(30))
    one = max(os.path.getsize(f) for f in glob.glob(f"{path}/query_id=q1/batch_id=1/*.parquet"))
    compact(spark, path, target_bytes=one * 5)
    assert 5 <= len(packed_files(path)) <= 8
    assert ids(read_compacted(spark, path)) == list(range(300))


def test_the_newest_batch_still_replaces_itself(spark, as_query):
    path = scratch_path(spark, "table")
    fill(spark, as_query, path, range(5))
    fill(spark, as_query, path, range(100, 102), query="q2")
    assert compact(spark, path).upto == {"q1": 3, "q2": 100}
    as_query(folder_writer(path), "q1", spark.range(7000, 7003).select("id", F.lit(0).cast("bigint").alias("third")), 4)
    expected = sorted([*range(40), *range(1000, 1020), *range(7000, 7003)])
    assert ids(read_compacted(spark, path)) == expected
    fill(spark, as_query, path, [5])
    compact(spark, path)
    vacuum(spark, path)
    assert ids(read_compacted(spark, path)) == sorted([*expected, *range(50, 60)])
    # What was small was packed again with what was new, and stays at a file of each.
    for batch in range(6, 10):
        fill(spark, as_query, path, [batch])
        compact(spark, path)
        vacuum(spark, path)
        assert len(current(spark, path).packed) == 1 and len(packed_files(path)) <= 2


def test_a_version_is_readable_until_it_is_removed(spark, as_query):
    path = scratch_path(spark, "table")
    fill(spark, as_query, path, range(4))
    first = compact(spark, path)
    old = read_compacted(spark, path, first)
    fill(spark, as_query, path, range(4, 8))
    second = compact(spark, path)
    assert [v.number for v in versions(spark, path)] == [1, 2]
    assert ids(old) == list(range(40)) and ids(read_compacted(spark, path, second)) == list(range(80))
    vacuum(spark, path, keep=2)
    assert ids(read_compacted(spark, path, first)) == list(range(80))
    vacuum(spark, path)
    assert versions(spark, path) == [second] and ids(read_compacted(spark, path)) == list(range(80))


def test_unfinished_compactions_do_not_count(spark, as_query, monkeypatch):
    path = scratch_path(spark, "table")
    fill(spark, as_query, path, range(4))

    def lost(*args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(compaction.files, "write_new", lost)
        with pytest.raises(RuntimeError, match="lost"):
            compact(spark, path)
    assert ids(read_compacted(spark, path)) == list(range(40))
    files.write_new(spark, f"{path}/_manifests/000000000.json", '{"number": 0, "pac')
    assert current(spark, path) == Version()
    compact(spark, path)
    assert ids(read_compacted(spark, path)) == list(range(40))
    with pytest.raises(Exception, match="already exists"):
        files.write_new(spark, f"{path}/_manifests/000000001.json", "{}")


def test_packing_does_not_shuffle_and_partitions_stay(spark, as_query):
    path = scratch_path(spark, "table")
    fill(spark, as_query, path, range(6), partition_by=["third"])
    compact(spark, path, partition_by=["third"])
    assert {os.path.basename(os.path.dirname(f)) for f in packed_files(path)} == {"third=0", "third=1", "third=2"}
    rows = read_compacted(spark, path)
    assert ids(rows) == list(range(60)) and all(r.id % 3 == r.third for r in rows.collect())
    plan = read_compacted(compaction._packing_session(spark, 1 << 20), path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


MESSAGES = ['{"id": 1}', '{"id": "many"}', "", None, '{"id": 2', "  ", '{"id": 3}', "[1]", "7"]


def send(spark, topic, texts):
    rows = spark.createDataFrame([(None, t if t is None else bytearray(t, "utf-8")) for t in texts], MESSAGE)
    rows.coalesce(1).write.mode("append").parquet(topic.name)


def test_every_message_is_in_one_table_once(spark):
    topic, store, checkpoint = Topic(scratch_path(spark, "in")), TableStore(scratch_path(spark, "store")), scratch_path(spark, "checkpoint")
    for texts in (MESSAGES, ['{"id": 9}', "{"]):
        send(spark, topic, texts)
        for _ in range(2):
            stream_with_rejects(decode_value(read_stream(spark, topic)), {"id": "int"}, store, "good", "bad", checkpoint)
            forget_last_commit(spark, checkpoint)
    assert ids(read_table(spark, store, "good")) == [1, 3, 9]
    bad = read_table(spark, store, "bad").collect()
    assert sorted((r.reason, str(r.value)) for r in bad) == sorted(
        [("misfit", '{"id": "many"}'), ("empty", ""), ("empty", "None"), ("broken", '{"id": 2'), ("empty", "  "), ("misfit", "[1]"), ("misfit", "7"), ("broken", "{")]
    )
    with pytest.raises(ValueError, match="folders"):
        stream_with_rejects(decode_value(read_stream(spark, topic)), {"id": "int"}, TableStore("jdbc:x"), "good", "bad", checkpoint)


def test_nested_messages_and_a_transform(spark, as_query):
    store = TableStore(scratch_path(spark, "store"))
    batch = spark.createDataFrame([('{"id": "c1", "snippet": {"title": "T"}}',), ('{"snippet": 5}',)], "value string")
    write = both_writer(item_schema("channels"), store, "good", "bad", lambda rows: rows.select("id", "snippet.title"))
    for _ in range(2):
        as_query(write, "q", batch, 0)
    assert [(r.id, r.title) for r in read_table(spark, store, "good").collect()] == [("c1", "T")]
    assert [(r.value, r.reason) for r in read_table(spark, store, "bad").collect()] == [('{"snippet": 5}', "misfit")]


def test_reasons(column):
    assert column(["", None, " \t", "{", '{"a": 1}', "nul"], "string", reject_reason(F.col("c"))) == ["empty", "empty", "broken", "broken", "misfit", "broken"]


def test_a_repeated_batch_brings_no_new_files(spark, as_query):
    path = scratch_path(spark, "topic")
    rows = spark.createDataFrame([("k", bytearray(b"{}"))], MESSAGE)
    as_query(topic_writer(path), "q", rows, 0)
    before = glob.glob(f"{path}/**/*.parquet", recursive=True)
    as_query(topic_writer(path), "q", rows, 0)
    as_query(topic_writer(path), "other", rows, 0)
    after = glob.glob(f"{path}/query_id=q/**/*.parquet", recursive=True)
    assert after == before and read_topic(spark, Topic(path)).count() == 2
    assert os.listdir(f"{path}/_staged") == []


def test_messages_of_a_batch_lost_half_way_are_not_seen(spark, as_query, monkeypatch):
    path = scratch_path(spark, "topic")
    rows = spark.createDataFrame([("k", bytearray(b"{}"))], MESSAGE)
    as_query(topic_writer(path), "q", rows, 0)

    def lost(*args):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(files, "move_new", lost)
        with pytest.raises(RuntimeError, match="lost"):
            as_query(topic_writer(path), "q", rows, 1)
    assert read_topic(spark, Topic(path)).count() == 1
    as_query(topic_writer(path), "q", rows, 1)
    assert read_topic(spark, Topic(path)).count() == 2


def test_chained_streams_meet_each_message_once(spark):
    source, between, last = (Topic(scratch_path(spark, n)) for n in ("in", "between", "out"))
    first, second = scratch_path(spark, "checkpoint"), scratch_path(spark, "checkpoint")
    for round_ in range(3):
        send(spark, source, [f'{{"id": {round_}}}'])
        for _ in range(2):
            stream_to_topic(decode_value(read_stream(spark, source)), between, first)
            stream_to_topic(decode_value(read_stream(spark, between)), last, second)
            forget_last_commit(spark, first)
    assert read_topic(spark, last).count() == 3
