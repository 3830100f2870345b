"""The calls made for Kafka and JDBC, which are not run here."""

from metricloom.sources.tables import TableStore, read_table, write_table
from metricloom.sources.topics import Topic, publish, read_stream, read_topic
from metricloom.streaming.runner import stream_to_topic


class Recorder:
    """Stands in for a reader or writer: notes every call and returns itself."""

    def __init__(self):
        self.calls = {}

    def __getattr__(self, name):
        def note(*args, **kwargs):
            self.calls[name] = kwargs or args
            return self

        return note


class Session:
    def __init__(self):
        self.read = Recorder()
        self.readStream = Recorder()


class Rows:
    """A DataFrame of which only the writer is used."""

    def __init__(self):
        self.write = Recorder()
        self.writeStream = Recorder()

    def select(self, *columns):
        return self


STORE = TableStore("jdbc:postgresql://db/batch", {"user": "u", "numPartitions": "8"})
TOPIC = Topic("videos", "broker:9092", {"maxOffsetsPerTrigger": "1000"}, {"kafka.acks": "all"})


def test_jdbc_read():
    session = Session()
    read_table(session, STORE, "public.videos")
    assert session.read.calls["format"] == ("jdbc",)
    assert session.read.calls["options"] == {
        "fetchsize": "10000",
        "user": "u",
        "numPartitions": "8",
        "url": "jdbc:postgresql://db/batch",
        "dbtable": "public.videos",
    }


def test_jdbc_write():
    rows = Rows()
    write_table(rows, STORE, "public.videos")
    assert rows.write.calls["format"] == ("jdbc",) and rows.write.calls["mode"] == ("errorifexists",)
    assert rows.write.calls["options"]["dbtable"] == "public.videos"
    assert "save" in rows.write.calls


def test_kafka_reads():
    session = Session()
    read_stream(session, TOPIC)
    read_topic(session, TOPIC)
    for reader in (session.readStream, session.read):
        assert reader.calls["format"] == ("kafka",) and reader.calls["options"]["subscribe"] == "videos"
        assert reader.calls["options"]["failOnDataLoss"] == "true"
        assert "schema" not in reader.calls and reader.calls["load"] == ()


def test_kafka_writes(spark, monkeypatch):
    rows = Rows()
    monkeypatch.setattr("metricloom.sources.topics.topic_rows", lambda df, key: df)
    monkeypatch.setattr("metricloom.streaming.runner.topic_rows", lambda df, key: df)
    publish(rows, TOPIC)
    stream_to_topic(rows, TOPIC, "hdfs:///ck", every="1 second")
    sink = {"kafka.acks": "all", "kafka.bootstrap.servers": "broker:9092", "topic": "videos"}
    assert rows.write.calls["format"] == ("kafka",) and rows.write.calls["options"] == sink
    stream = rows.writeStream.calls
    assert stream["format"] == ("kafka",) and stream["options"] == sink
    assert stream["option"] == ("checkpointLocation", "hdfs:///ck")
    assert stream["trigger"] == {"processingTime": "1 second"} and "start" in stream


def test_data_loss_can_be_accepted():
    kind, options = Topic("videos", "broker:9092", {"failOnDataLoss": "false"}).reader()
    assert kind == "kafka" and options["failOnDataLoss"] == "false"
