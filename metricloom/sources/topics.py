"""Message topics: Kafka, or a folder of Parquet files with the same key and value columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricloom.operators.envelope import to_json_value

MESSAGE = "key string, value binary"
# What tells one message from all others: the topic partition or file that holds it, and its place there.
IDENTITY = ("message_source", "message_offset")


@dataclass(frozen=True)
class Topic:
    """A topic by name on Kafka brokers (``servers`` set), or a folder.

    A first run starts at the earliest message so that it is complete; ``options`` override
    that and add limits such as ``maxOffsetsPerTrigger`` or ``maxFilesPerTrigger``. Messages that expired
    unread fail the query, unless the option ``failOnDataLoss=false`` lets it skip them. ``sink_options`` are those
    of the writer: security, compression, acknowledgements, batching.
    """

    name: str
    servers: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    sink_options: dict[str, str] = field(default_factory=dict)

    @property
    def is_folder(self) -> bool:
        return self.servers is None

    def reader(self) -> tuple[str, dict[str, str]]:
        if self.servers is None:
            return "parquet", {**self.options, "recursiveFileLookup": "true"}
        defaults = {"startingOffsets": "earliest", "failOnDataLoss": "true"}
        fixed = {"kafka.bootstrap.servers": self.servers, "subscribe": self.name}
        return "kafka", {**defaults, **self.options, **fixed}

    def writer(self) -> tuple[str, dict[str, str]]:
        if self.servers is None:
            return "parquet", {**self.sink_options, "path": self.name}
        return "kafka", {**self.sink_options, "kafka.bootstrap.servers": self.servers, "topic": self.name}


def read_stream(spark: SparkSession, topic: Topic) -> DataFrame:
    kind, options = topic.reader()
    reader = spark.readStream.format(kind).options(**options)
    return reader.schema(MESSAGE).load(topic.name) if topic.is_folder else reader.load()


def read_identified(spark: SparkSession, topic: Topic) -> DataFrame:
    """A stream of ``key, value`` and the ``IDENTITY`` of each message, which is the same whenever a batch is read again."""
    messages = read_stream(spark, topic)
    if topic.is_folder:
        source, offset = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    else:
        source, offset = F.concat_ws("/", "topic", "partition"), F.col("offset")
    return messages.select("key", "value", source.alias(IDENTITY[0]), offset.cast("bigint").alias(IDENTITY[1]))


def read_topic(spark: SparkSession, topic: Topic) -> DataFrame:
    """All messages of a topic as they are now."""
    kind, options = topic.reader()
    reader = spark.read.format(kind).options(**options)
    return reader.schema(MESSAGE).load(topic.name) if topic.is_folder else reader.load()


def topic_rows(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as messages: JSON bytes, keyed if a key column is named."""
    messages = to_json_value(df, key)
    if key is None:
        messages = messages.select(F.lit(None).cast("string").alias("key"), "value")
    return messages.select("key", F.col("value").cast("binary").alias("value"))


def publish(df: DataFrame, topic: Topic, key: str | None = None) -> None:
    """Send the rows of a batch DataFrame to a topic."""
    kind, options = topic.writer()
    topic_rows(df, key).write.format(kind).options(**options).mode("append").save()
