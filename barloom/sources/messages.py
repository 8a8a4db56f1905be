"""Raw message frames: from a topic, or from stored message files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Column contract of a raw message, the same for the topic and for files.
MESSAGE_SCHEMA = ("key binary, value binary, topic string, partition int, "
                  "offset bigint, timestamp timestamp")
MESSAGE_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp"]


def topic_options(servers: str, topic: str, starting: str = "earliest",
                  ending: str | None = None, **extra: str) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic,
               "startingOffsets": starting, **extra}
    if ending is not None:
        options["endingOffsets"] = ending
    return options


def read_topic(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    """Bounded read of a topic from the earliest to the latest offsets."""
    options = topic_options(servers, topic, "earliest", "latest", **extra)
    return spark.read.format("kafka").options(**options).load().select(*MESSAGE_COLUMNS)


def stream_topic(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                 **extra: str) -> DataFrame:
    """Unbounded read; ``starting`` is ``latest`` to ingest, ``earliest`` to inspect."""
    options = topic_options(servers, topic, starting, **extra)
    return spark.readStream.format("kafka").options(**options).load().select(*MESSAGE_COLUMNS)


def read_message_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(MESSAGE_SCHEMA).format(fmt).load(path)


def stream_message_files(spark: SparkSession, path: str, fmt: str = "parquet",
                         files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(MESSAGE_SCHEMA).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
