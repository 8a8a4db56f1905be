"""Publishing ticks as keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.bars import newest_close


def tick_messages(bars: DataFrame, event_time: Column | None = None,
                  source: str = "bars") -> DataFrame:
    """Newest close per symbol as (key, value) text; missing closes are skipped."""
    at = event_time if event_time is not None else F.current_timestamp()
    stamp = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    payload = F.struct("symbol", F.round("price", 4).alias("price"),
                       stamp.alias("event_time"), F.lit(source).alias("source"))
    return newest_close(bars).select(F.col("symbol").alias("key"),
                                     F.to_json(payload).alias("value"))


def message_frame(messages: DataFrame, topic: str, at: Column | None = None) -> DataFrame:
    """Messages in the raw column contract, for file-backed topics; offsets are unique."""
    partition = F.pmod(F.xxhash64("key"), F.lit(4)).cast("int")
    return messages.withColumn("partition", partition).select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"), "partition",
        F.monotonically_increasing_id().alias("offset"),
        (at if at is not None else F.current_timestamp()).alias("timestamp"))


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers) \
        .option("topic", topic).save()
