"""Tick streams: the batch parser on a stream, with replay-safe sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom.operators.bars import merge_ticks
from barloom.operators.ticks import latest_ticks
from barloom.sinks.files import drop_folder, folder_names, output_state
from barloom.sinks.relational import append_table

MESSAGE_KEY = ["topic", "partition_id", "kafka_offset"]


def start_append(ticks: DataFrame, path: str, progress: str, once: bool = False) -> StreamingQuery:
    """Append ticks to Parquet; the file sink's log makes each batch count once."""
    writer = ticks.writeStream.format("parquet").outputMode("append") \
        .option("path", path).option("checkpointLocation", progress)
    return (writer.trigger(availableNow=True) if once else writer).start()


def start_console(ticks: DataFrame, progress: str, rows: int = 50) -> StreamingQuery:
    return ticks.writeStream.format("console").outputMode("append") \
        .option("numRows", rows).option("truncate", False) \
        .option("checkpointLocation", progress).start()


def start_batches(ticks: DataFrame, sink: Callable[[DataFrame, int], None], progress: str,
                  once: bool = False) -> StreamingQuery:
    writer = ticks.writeStream.foreachBatch(sink).outputMode("append") \
        .option("checkpointLocation", progress)
    return (writer.trigger(availableNow=True) if once else writer).start()


def stamp_batch(batch: DataFrame) -> DataFrame:
    return batch.withColumn("ingested_at", F.current_timestamp())


def batch_folder_sink(path: str) -> Callable[[DataFrame, int], None]:
    """One folder per batch id: a replayed batch replaces its own rows. Skips empty batches."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            stamp_batch(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return sink


def new_messages(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of the batch that are not stored yet, by topic, partition and offset."""
    return batch.join(stored.select(*MESSAGE_KEY), MESSAGE_KEY, "left_anti")


def relational_sink(options: dict[str, str], replay_safe: bool = True
                    ) -> Callable[[DataFrame, int], None]:
    """Append each batch to a table over JDBC, leaving out rows a failed run already wrote.

    Only stored rows from the batch's smallest offset on are compared; that limit is
    pushed to the database.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        low = batch.agg(F.min("kafka_offset")).first()[0]
        if low is not None:
            rows = batch
            if replay_safe:
                stored = batch.sparkSession.read.format("jdbc").options(**options).load()
                rows = new_messages(batch, stored.filter(F.col("kafka_offset") >= low))
            append_table(stamp_batch(rows), options)
        batch.unpersist()
    return sink


def latest_state_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Keep the latest-tick table current: batch n folds its ticks into the state of n - 1.

    Each batch writes its own folder from the one before it, so a replay rewrites the
    same content, and out-of-order arrival does not matter. One row per symbol.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        merged = latest_ticks(batch)
        if batch_id > 0:
            earlier = spark.read.parquet(f"{path}/state-{batch_id - 1}")
            merged = latest_ticks(merged.unionByName(earlier))
        merged.write.mode("overwrite").parquet(f"{path}/state-{batch_id}")
        drop_folder(spark, f"{path}/state-{batch_id - 2}")
    return sink


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Latest-tick table after the newest finished batch."""
    done = [int(name.split("-")[1]) for name in folder_names(spark, path)
            if name.startswith("state-") and output_state(spark, f"{path}/{name}")[1]]
    return spark.read.parquet(f"{path}/state-{max(done)}")


def current_bars(base: DataFrame, state: DataFrame) -> DataFrame:
    """Base history with the latest ticks merged in; always the unmodified base."""
    return merge_ticks(base, state)
