"""Ticks: parsing raw messages and the newest tick per symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.guards import require_columns

TICK_JSON = "symbol string, price double"
PAYLOAD_JSON = TICK_JSON + ", event_time string"
TICK_COLUMNS = ["symbol", "price", "topic", "partition_id", "kafka_offset", "event_time"]


def decode_messages(messages: DataFrame) -> DataFrame:
    """Key and value as text, bus columns under their table names."""
    return messages.select(
        F.col("key").cast("string").alias("key_str"),
        F.col("value").cast("string").alias("value_str"),
        "topic", F.col("partition").alias("partition_id"),
        F.col("offset").alias("kafka_offset"), F.col("timestamp").alias("event_time"))


def parse_payload(decoded: DataFrame, time_source: str = "broker") -> DataFrame:
    """JSON to columns; text that is no tick gives NULL fields.

    Tick time is the broker's by default; ``payload`` takes the message's own field.
    """
    if time_source == "broker":
        body, event_time = F.from_json("value_str", TICK_JSON), F.col("event_time")
    elif time_source == "payload":
        body = F.from_json("value_str", PAYLOAD_JSON)
        event_time = F.try_to_timestamp(F.col("body.event_time"))
    else:
        raise ValueError(f"unknown time source {time_source}")
    # A generator, so that the text is parsed once and filters on the fields stay above it.
    once = decoded.select("topic", "partition_id", "kafka_offset", "event_time",
                          F.explode(F.array(body)).alias("body"))
    return once.select(
        F.col("body.symbol").alias("symbol"), F.col("body.price").alias("price"),
        "topic", "partition_id", "kafka_offset", event_time.alias("event_time"))


def parse_ticks(messages: DataFrame, time_source: str = "broker") -> DataFrame:
    """Raw messages to ticks; the same plan serves batch and streaming frames."""
    parsed = parse_payload(decode_messages(messages), time_source)
    return parsed.filter(F.col("symbol").isNotNull() & F.col("price").isNotNull())


def latest_ticks(ticks: DataFrame) -> DataFrame:
    """Newest tick per symbol: by event time, then offset (missing = -1), then partition.

    A maximum over an ordered struct, so rows fold map-side and a symbol that holds
    a third of all ticks still reaches its reducer as one row per map task.
    """
    require_columns(ticks, ["symbol", "price", "event_time", "kafka_offset"], "ticks")
    usable = ticks.dropna(subset=["symbol", "price", "event_time"])
    partition = F.col("partition_id") if "partition_id" in ticks.columns \
        else F.lit(None).cast("int")
    order = F.struct(
        F.col("event_time"), F.coalesce("kafka_offset", F.lit(-1)).alias("kafka_offset"),
        F.coalesce(partition, F.lit(-1)).alias("partition_id"), F.col("price"))
    return usable.groupBy("symbol").agg(F.max(order).alias("newest")).select(
        "symbol", "newest.price", "newest.partition_id", "newest.kafka_offset",
        "newest.event_time")


def tick_order(ticks: DataFrame) -> DataFrame:
    """All ticks sorted by symbol, newest first."""
    return ticks.orderBy(F.asc("symbol"), F.desc("event_time"), F.desc("kafka_offset"))


def latest_event_date(ticks: DataFrame) -> DataFrame:
    return ticks.agg(F.max(F.to_date("event_time")).alias("as_of_date"))
