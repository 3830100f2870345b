import json

import pytest
from pyspark.sql import functions as F

from metricloom.plans.consume import consumed, preview_consume, received, run_consume, run_consume_channels
from metricloom.plans.dated import dated, preview_dated, run_dated, run_dated_videos
from metricloom.plans.snapshot import (
    preview_snapshot,
    run_snapshot,
    run_snapshot_channels,
    run_snapshot_table,
    snapshot,
)
from metricloom.schemas import ENTITIES
from metricloom.session import scratch_path
from metricloom.sources.tables import TableStore, read_table
from metricloom.sources.topics import MESSAGE, Topic, publish, read_topic, topic_rows
from metricloom.streaming.runner import folder_writer

AT = "2024-01-02T03:04:05Z"
FLAT = {
    "channels": {"channel_id": "c1", "subscriber_count": 5, "video_count": 2, "view_count": 9999999999},
    "playlists": {"playlist_id": "p1", "playlist_title": "one two!", "published_at": "2020-03-08T10:30:00.000Z", "videos_count": 3},
    "videos": {"video_id": "v1", "video_description": "see @Twitter, twitter", "published_at": "2020-03-08T10:30:00.000Z"},
    "comments": {"comment_id": "x1", "comment_text": "a b c", "published_at_timestamp": "2020-03-08T10:30:00.000Z"},
}
NESTED = {
    "channels": {"id": "c1", "snippet": {"title": "T"}, "statistics": {"viewCount": "7"}},
    "playlists": {"id": "p1", "snippet": {"title": "one two!"}, "contentDetails": {"itemCount": 3}},
    "videos": {"id": "v1", "snippet": {"categoryId": "31"}, "contentDetails": {"duration": "PT1M"}, "statistics": {"likeCount": "4"}},
    "comments": {"id": "x1", "snippet": {"topLevelComment": {"snippet": {"textDisplay": "a b c", "likeCount": 2}}}},
}
DATED = {
    "channels": {"channel_id": "c1", "published_at": "1640995199999"},
    "playlists": {"playlist_id": "p1", "published_at": "1640995200000", "playlist_title_length": 2},
    "videos": {"video_id": "v1", "published_at": None, "duration": "PT1H", "view_count": 12.9},
    "comments": {"comment_id": "x1", "published_at": "soon", "comment_author_channel_name": "A", "text_length": 3},
}


def send(spark, topic, texts):
    rows = spark.createDataFrame([(None, t if t is None else bytearray(t, "utf-8")) for t in texts], MESSAGE)
    rows.coalesce(1).write.mode("append").parquet(topic.name)


def messages(spark, topic):
    return read_topic(spark, topic)


def topic(spark, label, **options):
    return Topic(scratch_path(spark, label), options=options)


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


@pytest.fixture
def odd(spark):
    """Messages that must not fail a job: broken, empty, missing, of other types."""
    return ["{bad", "", None, "[]", '{"id": 5, "channel_id": {"a": 1}, "published_at": [1], "duration": "P1DT5M"}']


@pytest.mark.parametrize("entity", ENTITIES)
def test_consume_is_the_batch_result(spark, entity, odd):
    source, sink, checkpoint = topic(spark, "in", maxFilesPerTrigger="1"), topic(spark, "out"), scratch_path(spark, "ck")
    send(spark, source, [json.dumps(FLAT[entity])])
    send(spark, source, odd)
    run_consume(spark, entity, source, sink, checkpoint)
    expected = topic_rows(consumed(messages(spark, source), entity), "channel_id" if entity == "channels" else "published_at")
    same(messages(spark, sink), expected)
    # Again on the same checkpoint: nothing twice, only what is new.
    run_consume(spark, entity, source, sink, checkpoint)
    assert messages(spark, sink).count() == 1 + len(odd)
    send(spark, source, [json.dumps(FLAT[entity])])
    run_consume(spark, entity, source, sink, checkpoint)
    assert messages(spark, sink).count() == 2 + len(odd)


def test_consumed_columns(spark):
    source = {e: topic(spark, e) for e in ENTITIES}
    for entity, where in source.items():
        send(spark, where, [json.dumps(FLAT[entity])])
    rows = {e: consumed(messages(spark, t), e).first().asDict() for e, t in source.items()}
    assert rows["channels"] == FLAT["channels"]
    assert rows["playlists"]["playlist_title_length"] == 2
    assert (rows["videos"]["twitter_count"], rows["videos"]["reddit_count"]) == (2, 0)
    assert rows["comments"]["text_length"] == 3 and rows["comments"]["published_at"] is not None
    assert "published_at_timestamp" not in rows["comments"]
    assert "text_length" not in received(messages(spark, source["comments"]), "comments").columns


@pytest.mark.parametrize("entity", ENTITIES)
def test_snapshot_is_the_batch_result(spark, entity, odd):
    source, sink = topic(spark, "in", maxFilesPerTrigger="1"), topic(spark, "out")
    send(spark, source, [json.dumps(NESTED[entity])])
    send(spark, source, odd)
    run_snapshot(spark, entity, source, sink, scratch_path(spark, "ck"), at=AT)
    same(messages(spark, sink), topic_rows(snapshot(messages(spark, source), entity, AT)))
    assert messages(spark, sink).where("key IS NOT NULL").count() == 0


def test_snapshot_columns(spark):
    rows = {}
    for entity in ENTITIES:
        source = topic(spark, entity)
        send(spark, source, [json.dumps(NESTED[entity])])
        df = snapshot(messages(spark, source), entity, AT)
        assert df.columns[0] == "current_time" and "made_for_kids" not in df.columns
        rows[entity] = df.first()
    assert rows["channels"].view_count == 7
    assert rows["playlists"].playlist_title_length == 2
    assert (rows["videos"].category, rows["videos"].duration, rows["videos"].like_count) == ("Anime / Animation", "PT1M", 4)
    assert (rows["comments"].text_length, rows["comments"].comment_like_count) == (3, 2)


def test_snapshot_time_is_one_per_batch(spark):
    source, sink = topic(spark, "in"), topic(spark, "out")
    send(spark, source, ['{"id": "c1"}', '{"id": "c2"}'])
    run_snapshot_channels(spark, source, sink, checkpoint=scratch_path(spark, "ck"))
    times = {json.loads(bytes(r.value))["current_time"] for r in messages(spark, sink).collect()}
    assert len(times) == 1


@pytest.mark.parametrize("entity", ENTITIES)
def test_dated_is_the_batch_result(spark, entity, odd):
    source, store, checkpoint = topic(spark, "in", maxFilesPerTrigger="1"), TableStore(scratch_path(spark, "s")), scratch_path(spark, "ck")
    send(spark, source, [json.dumps(DATED[entity])])
    send(spark, source, odd)
    run_dated(spark, entity, source, store, checkpoint, name="t")
    expected = dated(messages(spark, source), entity)
    same(read_table(spark, store, "t").drop("query_id", "batch_id"), expected)
    run_dated(spark, entity, source, store, checkpoint, name="t")
    assert read_table(spark, store, "t").count() == 1 + len(odd)


def test_dated_columns(spark, zone):
    rows = {}
    for entity in ENTITIES:
        source = topic(spark, entity)
        send(spark, source, [json.dumps(DATED[entity])])
        rows[entity] = dated(messages(spark, source), entity).first()
    assert (rows["channels"].year, rows["channels"].month) == ("2021", "December")
    assert (rows["playlists"].year, rows["playlists"].month) == ("2022", "January")
    assert (rows["videos"].year, rows["videos"].month) == ("n/a", None)
    assert (rows["videos"].view_count, rows["videos"].duration_seconds) == (12, 3600)
    assert "duration" not in rows["videos"].asDict()
    assert (rows["comments"].year, rows["comments"].month) == (None, None)
    assert rows["comments"].comment_author_channel_title == "A"


def test_a_new_checkpoint_adds_to_the_table(spark):
    source, store = topic(spark, "in"), TableStore(scratch_path(spark, "s"))
    send(spark, source, [json.dumps(DATED["channels"])])
    for _ in range(2):
        run_dated(spark, "channels", source, store, scratch_path(spark, "ck"), name="t")
    assert read_table(spark, store, "t").count() == 2


def test_two_streams_and_a_batch_share_a_topic(spark):
    source, sink = topic(spark, "in"), topic(spark, "out")
    send(spark, source, [json.dumps(FLAT["channels"])])
    for _ in range(2):
        run_consume_channels(spark, source, sink, checkpoint=scratch_path(spark, "ck"))
    publish(spark.range(1), sink)
    assert messages(spark, sink).count() == 3
    assert messages(spark, sink).columns == ["key", "value"]


def test_a_repeated_batch_replaces_itself(spark):
    store = TableStore(scratch_path(spark, "s"))
    write = folder_writer(store.path("t"))
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "q")
    try:
        for batch_id, rows in ((0, 3), (1, 4), (1, 4), (0, 3)):
            write(spark.range(rows), batch_id)
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert read_table(spark, store, "t").count() == 7


def test_batches_of_one_day_add_up(spark):
    source, store, checkpoint = topic(spark, "in", maxFilesPerTrigger="1"), TableStore(scratch_path(spark, "s")), scratch_path(spark, "ck")
    for i in range(3):
        send(spark, source, [json.dumps({"id": f"c{i}"})])
    run_snapshot_table(spark, "channels", source, store, checkpoint, name="t", at=AT)
    table = read_table(spark, store, "t")
    assert table.count() == 3 and table.select("batch_id").distinct().count() == 3
    assert {str(r.snapshot_date) for r in table.collect()} == {"2024-01-02"}


def test_chained_streams(spark):
    """Messages to a topic, that topic to another, each with a checkpoint of its own."""
    first, second, third = (topic(spark, f"t{i}") for i in range(3))
    send(spark, first, [json.dumps(NESTED["channels"])])
    run_snapshot_channels(spark, first, second, checkpoint=scratch_path(spark, "ck"), at=AT)
    run_consume_channels(spark, second, third, checkpoint=scratch_path(spark, "ck"))
    row = messages(spark, third).first()
    assert row.key == "c1" and json.loads(bytes(row.value)) == {"channel_id": "c1", "view_count": 7}


def test_previews(spark):
    for entity in ENTITIES:
        for preview, sample in ((preview_consume, FLAT), (preview_snapshot, NESTED), (preview_dated, DATED)):
            source = topic(spark, "in")
            send(spark, source, [json.dumps(sample[entity])])
            view = f"{preview.__name__}_{entity}"
            preview(spark, entity, source, memory=view)
            assert spark.table(view).count() == 1


def test_preview_on_the_console(spark):
    source = topic(spark, "in")
    send(spark, source, [json.dumps(FLAT["channels"])])
    query = preview_consume(spark, "channels", source)
    progress = query.lastProgress
    assert progress["numInputRows"] == 1 and "Console" in progress["sink"]["description"]


def test_continuous_batches(spark):
    source, store = topic(spark, "in"), TableStore(scratch_path(spark, "s"))
    send(spark, source, [json.dumps(DATED["videos"])])
    query = run_dated_videos(spark, source, store, checkpoint=scratch_path(spark, "ck"), name="t", every="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive and read_table(spark, store, "t").count() == 1
    finally:
        query.stop()


def test_publish_appends(spark):
    sink = topic(spark, "out")
    rows = spark.range(3).withColumn("name", F.lit("x"))
    publish(rows, sink, key="id")
    publish(rows, sink)
    assert sorted(str(r.key) for r in messages(spark, sink).collect()) == ["0", "1", "2", "None", "None", "None"]


def test_kafka_options():
    source = Topic("videos", "broker:9092", {"maxOffsetsPerTrigger": "1000"})
    kind, options = source.reader()
    assert kind == "kafka"
    assert options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "videos",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        "maxOffsetsPerTrigger": "1000",
    }
    assert Topic("videos", "b", {"startingOffsets": "latest"}).reader()[1]["startingOffsets"] == "latest"
    assert source.writer() == ("kafka", {"kafka.bootstrap.servers": "broker:9092", "topic": "videos"})


def test_streams_keep_no_state_and_do_not_shuffle(spark):
    source, store = topic(spark, "in"), TableStore(scratch_path(spark, "s"))
    send(spark, source, [json.dumps(DATED["videos"])])
    query = run_dated_videos(spark, source, store, checkpoint=scratch_path(spark, "ck"), name="t")
    assert query.lastProgress["stateOperators"] == []
    for transform in (consumed, snapshot, dated):
        plan = transform(messages(spark, source), "videos")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan
