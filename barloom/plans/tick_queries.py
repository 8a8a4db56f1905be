"""Queries over raw messages, ticks and their merge into bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions.scalars import utc_date
from barloom.operators import bars as B
from barloom.operators import calendar as C
from barloom.operators import quality, serving
from barloom.operators import ticks as K
from barloom.operators.features import engineer_features
from barloom.plans import inputs
from barloom.plans.oracle_prefix import FEATURES, MESSAGES, PREDICTION_PREFIX, TICK_PREFIX
from barloom.plans.registry import query
from barloom.session import stage, staging_path
from barloom.sinks.publish import tick_messages
from barloom.sinks.upsert import upsert_rows
from barloom.sources.tables import read_parquet_prefix
from barloom.streaming import ticks as S

BRAND_PREFIX = ",".join([TICK_PREFIX, FEATURES.format(name="bfeat", bars="bars_brand")])
EVENT_PREFIX = ",".join([TICK_PREFIX, FEATURES.format(name="efeat", bars="bars_event")])
# Rows a brand must exceed in the history filter: between the brands' row counts at sf0.01.
BRAND_HISTORY = 1510
BAR_SPEC = "symbol date:d open:f high:f low:f close:f volume:f"
TICK_SPEC = "symbol price:f topic partition_id:i kafka_offset:i event_time:t"
LATEST_SPEC = "symbol price:f partition_id:i kafka_offset:i event_time:t"


@query("src5_parquet_prefix", "o_orderkey:i o_custkey:i o_orderpriority o_totalprice:f",
       "one AS (SELECT 1)",
       "SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders")
def parquet_prefix(spark, sf_dir):
    return read_parquet_prefix(spark, f"{sf_dir}/orders.parquet",
                               ["o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"])


@query("prj1_decoded_messages", "key_str topic partition_id:i kafka_offset:i event_time:t",
       TICK_PREFIX, "SELECT * FROM messages")
def decoded_messages(spark, sf_dir):
    return K.decode_messages(inputs.raw_messages(spark, sf_dir))


@query("prj2_parsed_messages", TICK_SPEC, TICK_PREFIX, "SELECT * FROM messages")
def parsed_messages(spark, sf_dir):
    return K.parse_payload(K.decode_messages(inputs.raw_messages(spark, sf_dir)))


@query("prj5_event_dates", "symbol kafka_offset:i event_date:d", TICK_PREFIX,
       "SELECT symbol, kafka_offset, CAST(event_time AS DATE) AS event_date FROM ticks")
def event_dates(spark, sf_dir):
    return inputs.ticks(spark, sf_dir).withColumn("event_date", utc_date("event_time"))


@query("flt1_valid_ticks", TICK_SPEC, TICK_PREFIX, "SELECT * FROM ticks")
def valid_ticks(spark, sf_dir):
    return inputs.ticks(spark, sf_dir)


@query("top4_tick_order", TICK_SPEC, TICK_PREFIX,
       "SELECT * FROM ticks ORDER BY symbol, event_time DESC, kafka_offset DESC")
def tick_order(spark, sf_dir):
    return K.tick_order(inputs.ticks(spark, sf_dir))


@query("win10_latest_ticks", LATEST_SPEC, TICK_PREFIX, "SELECT * FROM latest")
def latest_ticks(spark, sf_dir):
    return K.latest_ticks(inputs.ticks(spark, sf_dir))


def shifted_latest(spark, sf_dir):
    """Newest ticks moved in time by symbol, so that every merge branch occurs."""
    days = F.when(F.col("symbol") == "CLICK", 3).when(F.col("symbol") == "ERROR", -60).otherwise(0)
    moved = F.col("event_time") + F.make_dt_interval(days)
    return K.latest_ticks(inputs.ticks(spark, sf_dir)).withColumn("event_time", moved)


MERGE_SQL = """
moved AS (SELECT symbol, price, CAST(event_time AS DATE) + CASE symbol WHEN 'CLICK' THEN 3
    WHEN 'ERROR' THEN -60 ELSE 0 END AS event_date FROM latest),
ends AS (SELECT symbol, max(date) AS last_date, arg_max(volume, date) AS last_volume
    FROM bars_event GROUP BY 1),
mplan AS (SELECT m.symbol, m.price, e.last_volume, m.event_date, e.last_date,
    EXISTS (SELECT 1 FROM bars_event b WHERE b.symbol = m.symbol AND b.date = m.event_date) AS hit
    FROM moved m JOIN ends e ON m.symbol = e.symbol),
targets AS (SELECT *, CASE WHEN hit OR event_date > last_date THEN event_date ELSE last_date END
    AS target FROM mplan)"""


@query("jn4_tick_merge", BAR_SPEC, TICK_PREFIX + "," + MERGE_SQL, """
SELECT b.symbol, b.date, coalesce(p.price, b.open) AS open, coalesce(p.price, b.high) AS high,
    coalesce(p.price, b.low) AS low, coalesce(p.price, b.close) AS close, b.volume
FROM bars_event b LEFT JOIN targets p ON b.symbol = p.symbol AND b.date = p.target
UNION ALL
SELECT symbol, target, price, price, price, price, last_volume FROM targets
WHERE NOT hit AND event_date > last_date""")
def tick_merge(spark, sf_dir):
    return B.merge_ticks(inputs.bars_event_day(spark, sf_dir), shifted_latest(spark, sf_dir))


@query("jn6_ticks_with_history", "symbol price:f n_rows:i", EVENT_PREFIX, """
SELECT l.symbol, l.price, h.n_rows FROM latest l JOIN (
    SELECT symbol, count(*) AS n_rows FROM efeat GROUP BY 1 HAVING count(*) > 5) h
ON l.symbol = h.symbol""")
def ticks_with_history(spark, sf_dir):
    features = engineer_features(inputs.bars_event_day(spark, sf_dir))
    return C.with_history(K.latest_ticks(inputs.ticks(spark, sf_dir)), features, 5)


@query("flt7_long_history", "symbol date:d close:f ret:f", BRAND_PREFIX, f"""
SELECT symbol, date, close, ret FROM bfeat WHERE symbol IN (
    SELECT symbol FROM bfeat GROUP BY 1 HAVING count(*) > {BRAND_HISTORY})""")
def long_history(spark, sf_dir):
    return C.long_enough(engineer_features(inputs.bars_brand_day(spark, sf_dir)), BRAND_HISTORY)


@query("set3_missing_names", "table_name", BRAND_PREFIX, f"""
SELECT DISTINCT p_brand AS table_name FROM part EXCEPT
SELECT symbol FROM bfeat GROUP BY 1 HAVING count(*) > {BRAND_HISTORY}""")
def missing_names(spark, sf_dir):
    part = inputs.table(spark, sf_dir, "part")
    features = engineer_features(inputs.bars_brand_day(spark, sf_dir))
    present = features.groupBy("symbol").count().filter(F.col("count") > BRAND_HISTORY) \
        .select(F.col("symbol").alias("table_name"))
    return quality.missing_from(part.select(F.col("p_brand").alias("table_name")), present)


@query("snk9_tick_messages", "key symbol price:f source", TICK_PREFIX, """
SELECT symbol AS key, symbol, round(arg_max(close, date), 4) AS price, 'bars' AS source
FROM bars_event GROUP BY symbol""")
def published_ticks(spark, sf_dir):
    body = F.from_json("value", "symbol string, price double, event_time string, source string")
    return tick_messages(inputs.bars_event_day(spark, sf_dir)).select("key", body.alias("b")) \
        .select("key", "b.*")


@query("agg6_row_counts", "table n_rows:i", ",".join([MESSAGES, PREDICTION_PREFIX]), """
SELECT 'ticks' AS "table", count(*) AS n_rows FROM ticks
UNION ALL SELECT 'predictions', count(*) FROM preds
UNION ALL SELECT 'newest_run', count(*) FROM run""")
def row_counts(spark, sf_dir):
    preds = stage(inputs.predictions(spark, sf_dir))
    return serving.row_counts({"ticks": inputs.ticks(spark, sf_dir), "predictions": preds,
                               "newest_run": serving.of_latest_run(preds)})


def rerun_rows(preds):
    """A rerun of one model's runs (each row sent twice) plus a new run."""
    base = preds.filter(F.col("model_name") == "model_odd")
    first = base.withColumn("pred_close", F.col("pred_close") * 1.01) \
        .withColumn("position", F.lit(0))
    second = base.withColumn("pred_close", F.col("pred_close") * 1.02) \
        .withColumn("position", F.lit(1))
    rerun = preds.withColumn("prediction_run_id", F.concat(F.lit("re"), "prediction_run_id")) \
        .withColumn("position", F.lit(2))
    return first.unionByName(second).unionByName(rerun)


PREDICTION_SPEC = ("prediction_run_id as_of_date:d model_name ticker last_close:f pred_close:f "
                   "pred_return:f graph_gate:f created_at:t")
UPSERT_SQL = """
SELECT prediction_run_id, as_of_date, model_name, ticker, last_close,
    CASE WHEN model_name = 'model_odd' THEN pred_close * 1.02 ELSE pred_close END AS pred_close,
    pred_return, graph_gate,
    CASE WHEN model_name = 'model_odd' THEN TIMESTAMP '2030-01-01 00:00:00' ELSE created_at END
        AS created_at FROM preds
UNION ALL
SELECT 're' || prediction_run_id, as_of_date, model_name, ticker, last_close, pred_close,
    pred_return, graph_gate, TIMESTAMP '2030-01-01 00:00:00' FROM preds"""


@query("snk5_upsert", PREDICTION_SPEC, PREDICTION_PREFIX, UPSERT_SQL)
def upsert(spark, sf_dir):
    preds = stage(inputs.predictions(spark, sf_dir))
    now = F.to_timestamp(F.lit("2030-01-01 00:00:00"))
    return upsert_rows(preds, rerun_rows(preds), now=now)


def _tick_stream(spark, sf_dir):
    schema = inputs.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet") \
        .parquet(sf_dir)
    return K.parse_ticks(inputs.events_to_messages(events))


@query("str1_streamed_ticks", TICK_SPEC, TICK_PREFIX, "SELECT * FROM ticks")
def streamed_ticks(spark, sf_dir):
    out = staging_path(spark, "stream")
    S.start_append(_tick_stream(spark, sf_dir), f"{out}/data", f"{out}/progress",
                   once=True).awaitTermination()
    return spark.read.parquet(f"{out}/data")


@query("str3_batch_folders", TICK_SPEC, TICK_PREFIX, "SELECT * FROM ticks")
def batch_folders(spark, sf_dir):
    out = staging_path(spark, "stream")
    S.start_batches(_tick_stream(spark, sf_dir), S.batch_folder_sink(f"{out}/data"),
                    f"{out}/progress", once=True).awaitTermination()
    return spark.read.parquet(f"{out}/data")


def _streamed_state(spark, sf_dir):
    out = staging_path(spark, "stream")
    S.start_batches(_tick_stream(spark, sf_dir), S.latest_state_sink(f"{out}/state"),
                    f"{out}/progress", once=True).awaitTermination()
    return S.read_state(spark, f"{out}/state")


@query("str5_streamed_latest", LATEST_SPEC, TICK_PREFIX, "SELECT * FROM latest")
def streamed_latest(spark, sf_dir):
    return _streamed_state(spark, sf_dir)


@query("str5_streamed_bars", BAR_SPEC, TICK_PREFIX, """
SELECT b.symbol, b.date, coalesce(l.price, b.open) AS open, coalesce(l.price, b.high) AS high,
    coalesce(l.price, b.low) AS low, coalesce(l.price, b.close) AS close, b.volume
FROM bars_event b LEFT JOIN latest l
ON b.symbol = l.symbol AND b.date = CAST(l.event_time AS DATE)""")
def streamed_bars(spark, sf_dir):
    return S.current_bars(inputs.bars_event_day(spark, sf_dir), _streamed_state(spark, sf_dir))
