"""Market-panel inputs derived from the given tables.

Orders, line items and events are read as markets: an order priority, a brand or an
event type is a symbol, and a day of its rows is a bar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.config import BacktestConfig, GraphConfig
from barloom.functions.scalars import predicted_return
from barloom.operators.calendar import aligned_panel
from barloom.operators.features import engineer_features
from barloom.operators.samples import by_t, StepPlan, plan_steps
from barloom.operators.scaling import apply_minmax, fit_minmax
from barloom.operators.ticks import parse_ticks
from barloom.session import staging_path
from barloom.sinks.run_store import RunStore

TOPIC = "stock-price"
BACKTEST = BacktestConfig(lookback=20, test_days=20, initial_train=200, val_days=20)
# The given prices are independent noise: only loose thresholds leave edges.
GRAPH = GraphConfig(recent_days=120, pearson_threshold=0.02, pearson_topk=2, min_support=0.05,
                    min_confidence=0.10, lift_threshold=1.0, assoc_topk=2, final_topk=2)
MODELS = ["naive", "ma5", "ma20"]
CONTESTS = [("ma5", "naive"), ("ma20", "naive"), ("ma20", "ma5")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events_to_messages(events: DataFrame) -> DataFrame:
    """Events as raw messages; some rows are made dirty by their id.

    Batch and streaming frames both pass through here.
    """
    every = F.col("event_id")
    symbol = F.when(every % 83 != 0, F.upper("event_type"))
    clean = F.to_json(F.struct(symbol.alias("symbol"), F.col("value").alias("price")))
    quoted = F.to_json(F.struct(symbol.alias("symbol"),
                                F.col("value").cast("string").alias("price")))
    value = F.when(every % 97 == 0, "not json").when(every % 89 == 0, quoted).otherwise(clean)
    return events.select(
        F.upper("event_type").cast("binary").alias("key"), value.cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"), (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"))


def raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_messages(table(spark, sf_dir, "events"))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_ticks(raw_messages(spark, sf_dir))


def _order_bars(orders: DataFrame, date: Column) -> DataFrame:
    return orders.groupBy(F.col("o_orderpriority").alias("symbol"), date.alias("date")).agg(
        F.min_by("o_totalprice", "o_orderkey").alias("open"),
        F.max("o_totalprice").alias("high"), F.min("o_totalprice").alias("low"),
        F.max_by("o_totalprice", "o_orderkey").alias("close"),
        F.count("*").cast("double").alias("volume"))


def bars_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_bars(table(spark, sf_dir, "orders"), F.to_date("o_orderdate"))


def bars_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_bars(table(spark, sf_dir, "orders"),
                       F.trunc(F.to_date("o_orderdate"), "month"))


def bars_event_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.struct("ts", "event_id")
    return table(spark, sf_dir, "events").groupBy(
        F.upper("event_type").alias("symbol"), F.to_date("ts").alias("date")).agg(
            F.min_by("value", at).alias("open"), F.max("value").alias("high"),
            F.min("value").alias("low"), F.max_by("value", at).alias("close"),
            F.count("*").cast("double").alias("volume"))


def bars_brand_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars per brand; only aggregates that do not depend on row order.

    The part side is not hinted: the planner broadcasts it while it is small and
    otherwise splits skewed parts at run time.
    """
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.to_date("l_shipdate").alias("date"), price.alias("price"), "l_quantity")
    return lines.join(part, F.col("l_partkey") == F.col("p_partkey")) \
        .groupBy(F.col("p_brand").alias("symbol"), "date").agg(
            F.avg("price").alias("open"), F.max("price").alias("high"),
            F.min("price").alias("low"), F.avg("price").alias("close"),
            F.sum("l_quantity").alias("volume"))


def gapped_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars with holes: no close on single-order days, no open on two-order days."""
    bars = bars_day(spark, sf_dir)
    return bars.withColumns({
        "close": F.when(F.col("volume") != 1, F.col("close")),
        "open": F.when(F.col("volume") != 2, F.col("open")),
        "volume": F.when(F.col("volume") != 3, F.col("volume"))})


def day_panel(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Aligned daily panel with features, and its calendar."""
    return aligned_panel(engineer_features(bars_day(spark, sf_dir)))


def month_panel(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return aligned_panel(engineer_features(bars_month(spark, sf_dir)))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A predictions table: one run per common date."""
    panel, _ = day_panel(spark, sf_dir)
    known = F.col("t") % 13 != 0
    rank = F.row_number().over(Window.partitionBy("date").orderBy("symbol"))
    rows = panel.select(
        F.concat(F.lit("run_"), F.date_format("date", "yyyyMMdd")).alias("prediction_run_id"),
        F.col("date").alias("as_of_date"),
        F.when(F.col("t") % 2 == 0, "model_even").otherwise("model_odd").alias("model_name"),
        F.col("symbol").alias("ticker"), F.col("close").alias("last_close"),
        F.col("ma5").alias("pred_close"), known.alias("known"),
        (F.abs("ret") / (1 + F.abs("ret"))).alias("gate"),
        (F.col("date").cast("timestamp")
         + F.make_dt_interval(F.lit(0), F.lit(18), F.lit(0), rank)).alias("created_at"))
    return rows.select(
        "prediction_run_id", "as_of_date", "model_name", "ticker", "last_close", "pred_close",
        F.when(F.col("known"), predicted_return()).alias("pred_return"),
        F.when(F.col("known"), F.col("gate")).alias("graph_gate"), "created_at")


_stores: dict[tuple[str, str], RunStore] = {}


def prediction_store(spark: SparkSession, sf_dir: str) -> RunStore:
    """The predictions as a stored table, written once per application and source."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        store = RunStore(spark, staging_path(spark, "stored-predictions"))
        store.create(predictions(spark, sf_dir))
        _stores[key] = store
    return _stores[key]


def scaled_panel(panel: DataFrame, plan: StepPlan, columns: list[str]) -> DataFrame:
    params = fit_minmax(panel, plan.train_start, plan.initial_end, columns)
    return apply_minmax(panel, params, columns)


def model_samples(panel: DataFrame, plan: StepPlan) -> DataFrame:
    """Scaled closes with the forecasts of three simple models per (t, symbol)."""
    scaled = scaled_panel(panel, plan, ["close"])
    mean = {f"ma{k}": F.avg("close").over(by_t().rowsBetween(-k, -1)) for k in (5, 20)}
    return scaled.select(
        "t", "date", F.col("symbol").alias("ticker"), F.col("close").alias("y_true"),
        F.lag("close").over(by_t()).alias("last_close"),
        F.lag("close").over(by_t()).alias("naive"), mean["ma5"].alias("ma5"),
        mean["ma20"].alias("ma20"), F.abs(F.lag("ret").over(by_t())).alias("move"))


def forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long forecasts of the simple models over the test dates."""
    panel, calendar = day_panel(spark, sf_dir)
    plan = plan_steps(calendar, BACKTEST)
    rows = model_samples(panel, plan).filter(F.col("t") >= plan.first_test)
    # Stand-in gate: a share of the last move, smaller for smoother models.
    models = F.array(*[
        F.struct(F.lit(m).alias("model"), F.col(m).alias("y_pred"),
                 (F.col("move") / (k + F.col("move"))).alias("gate"))
        for k, m in enumerate(MODELS, start=1)])
    step = (F.col("t") - plan.first_test + 1).cast("int")
    return rows.select(step.alias("step"), "date", "ticker", "y_true", "last_close",
                       F.explode(models).alias("m")) \
        .select("m.model", "step", "date", "ticker", "y_true", "m.y_pred", "last_close", "m.gate")
