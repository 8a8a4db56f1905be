"""Dashboard queries over the predictions table and close history."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions import scalars as P
from barloom.operators import serving as V
from barloom.plans import inputs
from barloom.plans.oracle_prefix import BAR_PREFIX, PREDICTION_PREFIX
from barloom.plans.registry import query

ITEM_SPEC = ("prediction_run_id as_of_date:d model_name ticker last_close:f pred_close:f "
             "pred_return:f graph_gate:f created_at:t")
ONE_RUN = "run_19990331"


def _run(spark, sf_dir):
    return inputs.prediction_store(spark, sf_dir).latest()


@query("src_predictions", ITEM_SPEC, PREDICTION_PREFIX, "SELECT * FROM preds")
def predictions(spark, sf_dir):
    return inputs.predictions(spark, sf_dir)


@query("agg1_latest_run", "prediction_run_id", PREDICTION_PREFIX, "SELECT * FROM last_run")
def latest_run(spark, sf_dir):
    directory = inputs.prediction_store(spark, sf_dir).runs()
    return V.latest_run(directory.withColumnRenamed("last_created_at", "created_at"))


@query("jn1_latest_run_rows", ITEM_SPEC, PREDICTION_PREFIX, "SELECT * FROM run")
def latest_run_rows(spark, sf_dir):
    return _run(spark, sf_dir)


RUN_SPEC = ("prediction_run_id as_of_date:d model_name row_count:i first_created_at:t "
            "last_created_at:t")
RUN_SQL = """
SELECT prediction_run_id, as_of_date, model_name, count(*) AS row_count,
    min(created_at) AS first_created_at, max(created_at) AS last_created_at
FROM preds GROUP BY 1, 2, 3 ORDER BY last_created_at DESC, prediction_run_id DESC LIMIT {n}"""


@query("agg2_recent_runs", RUN_SPEC, PREDICTION_PREFIX, RUN_SQL.format(n=10))
def recent_runs(spark, sf_dir):
    return V.recent_runs(inputs.prediction_store(spark, sf_dir).runs())


@query("agg3_latest_run_metadata", RUN_SPEC, PREDICTION_PREFIX, RUN_SQL.format(n=1))
def latest_run_metadata(spark, sf_dir):
    return V.latest_run_metadata(inputs.prediction_store(spark, sf_dir).runs())


@query("agg4_dashboard_summary", "prediction_run_id model_name as_of_date:d row_count:i "
       "ticker_count:i avg_pred_return:f max_pred_return:f min_pred_return:f last_updated:t",
       PREDICTION_PREFIX, """
SELECT prediction_run_id, max(model_name) AS model_name, max(as_of_date) AS as_of_date,
    count(*) AS row_count, count(DISTINCT ticker) AS ticker_count,
    avg(pred_return) AS avg_pred_return, max(pred_return) AS max_pred_return,
    min(pred_return) AS min_pred_return, max(created_at) AS last_updated FROM run GROUP BY 1""")
def dashboard_summary(spark, sf_dir):
    return V.dashboard_summary(_run(spark, sf_dir))


@query("agg5_run_headers", "prediction_run_id as_of_date:d model_name row_count:i",
       PREDICTION_PREFIX, """
SELECT prediction_run_id, arg_min(as_of_date, ticker) AS as_of_date,
    arg_min(model_name, ticker) AS model_name, count(*) AS row_count FROM preds GROUP BY 1""")
def run_headers(spark, sf_dir):
    return V.run_header(inputs.predictions(spark, sf_dir))


@query("flt3_run_items", ITEM_SPEC, PREDICTION_PREFIX,
       f"SELECT * FROM preds WHERE prediction_run_id = '{ONE_RUN}'")
def run_items(spark, sf_dir):
    return V.run_items(inputs.prediction_store(spark, sf_dir).run(ONE_RUN), ONE_RUN)


@query("set4_tickers", "ticker", PREDICTION_PREFIX, "SELECT DISTINCT ticker FROM preds")
def tickers(spark, sf_dir):
    return V.tickers(inputs.predictions(spark, sf_dir))


@query("flt4_ticker_search", ITEM_SPEC, PREDICTION_PREFIX,
       "SELECT * FROM preds WHERE contains(upper(ticker), 'HIGH')")
def ticker_search(spark, sf_dir):
    return V.search_tickers(inputs.predictions(spark, sf_dir), " high ")


@query("flt4_search_counter", "shown:i total:i", PREDICTION_PREFIX, """
SELECT count(*) FILTER (WHERE contains(upper(ticker), 'HIGH')) AS shown, count(*) AS total
FROM preds""")
def search_counter(spark, sf_dir):
    return V.search_counter(inputs.predictions(spark, sf_dir), "high")


@query("top3_ticker_history", ITEM_SPEC, PREDICTION_PREFIX,
       "SELECT * FROM preds WHERE ticker = '2-HIGH' ORDER BY created_at DESC LIMIT 30")
def ticker_history(spark, sf_dir):
    rows = inputs.prediction_store(spark, sf_dir).newest_of("2-HIGH", 30)
    return V.ticker_history(rows, "2-HIGH", 30)


@query("prj12_history_timeline", "ticker label created_at:t pred_close:f actual:f confidence:f",
       PREDICTION_PREFIX, """
SELECT h.ticker, strftime(h.created_at, '%Y-%m-%d') AS label, h.created_at, h.pred_close,
    c.actual, coalesce(h.graph_gate, 0) * 100 AS confidence
FROM (SELECT * FROM preds WHERE ticker = '2-HIGH' ORDER BY created_at DESC LIMIT 30) h
LEFT JOIN (SELECT symbol, arg_max(close, date) AS actual FROM bars_day GROUP BY 1) c
ON h.ticker = c.symbol""")
def history_timeline(spark, sf_dir):
    return V.history_timeline(ticker_history(spark, sf_dir), inputs.bars_day(spark, sf_dir))


@query("prj7_price_change", "prediction_run_id ticker change:f sign", PREDICTION_PREFIX, """
SELECT prediction_run_id, ticker, pred_close - last_close AS change,
    CASE WHEN pred_close > last_close THEN 'positive' WHEN pred_close < last_close THEN 'negative'
    ELSE 'neutral' END AS sign FROM preds""")
def price_change(spark, sf_dir):
    return inputs.predictions(spark, sf_dir).withColumn("change", P.price_change()) \
        .withColumn("sign", P.sign_class(P.price_change()))


@query("prj8_predicted_return", "prediction_run_id ticker value:f", PREDICTION_PREFIX, """
SELECT prediction_run_id, ticker, CASE WHEN abs(last_close) > 1e-12
    THEN (pred_close - last_close) / abs(last_close) END AS value FROM preds""")
def predicted_return(spark, sf_dir):
    return inputs.predictions(spark, sf_dir).withColumn("value", P.predicted_return())


@query("prj9_confidence_tier", "prediction_run_id ticker tier", PREDICTION_PREFIX, """
SELECT prediction_run_id, ticker, CASE WHEN coalesce(graph_gate, 0) > 0.6 THEN 'High'
    WHEN coalesce(graph_gate, 0) >= 0.3 THEN 'Medium' ELSE 'Low' END AS tier FROM preds""")
def confidence_tier(spark, sf_dir):
    return inputs.predictions(spark, sf_dir).withColumn("tier", P.confidence_tier())


@query("prj10_report_text", "prediction_run_id ticker last pct_known created", PREDICTION_PREFIX,
       """
SELECT prediction_run_id, ticker, printf('%.2f', last_close) AS last,
    CASE WHEN pred_return IS NULL THEN '—' ELSE 'known' END AS pct_known,
    strftime(created_at, '%Y-%m-%d %H:%M:%S') || ' UTC' AS created FROM preds""")
def report_text(spark, sf_dir):
    percent = P.percent_text("pred_return")
    return inputs.predictions(spark, sf_dir).select(
        "prediction_run_id", "ticker", P.number_text("last_close", 2).alias("last"),
        F.when(percent == P.DASH, percent).otherwise("known").alias("pct_known"),
        P.utc_text("created_at").alias("created"))


@query("prj11_scatter", "prediction_run_id ticker x:f y:f", PREDICTION_PREFIX, """
SELECT prediction_run_id, ticker, coalesce(graph_gate, 0) AS x,
    abs(coalesce(pred_return, 0)) * 100 AS y FROM preds""")
def scatter(spark, sf_dir):
    return inputs.predictions(spark, sf_dir).select(
        "prediction_run_id", "ticker", P.zero_if_null("graph_gate").alias("x"),
        (F.abs(P.zero_if_null("pred_return")) * 100).alias("y"))


@query("agg16_run_kpis", "prediction_run_id win_rate:f win_rate_known:f mean_gate:f max_return:f "
       "min_return:f", PREDICTION_PREFIX, """
SELECT prediction_run_id,
    avg(CASE WHEN coalesce(pred_return, 0) >= 0 THEN 1.0 ELSE 0.0 END) * 100 AS win_rate,
    avg(CASE WHEN pred_return >= 0 THEN 1.0 WHEN pred_return < 0 THEN 0.0 END) * 100
        AS win_rate_known,
    avg(coalesce(graph_gate, 0)) AS mean_gate,
    greatest(max(coalesce(pred_return, 0)), 0) AS max_return,
    least(min(coalesce(pred_return, 0)), 0) AS min_return FROM preds GROUP BY 1""")
def run_kpis(spark, sf_dir):
    return V.run_kpis(inputs.predictions(spark, sf_dir))


@query("agg17_tier_counts", "prediction_run_id tier n:i", PREDICTION_PREFIX, """
SELECT r.prediction_run_id, t.tier, count(*) FILTER (WHERE t.tier =
    CASE WHEN coalesce(graph_gate, 0) > 0.6 THEN 'High'
    WHEN coalesce(graph_gate, 0) >= 0.3 THEN 'Medium' ELSE 'Low' END) AS n
FROM preds r, (VALUES ('High'), ('Medium'), ('Low')) t(tier) GROUP BY 1, 2""")
def tier_counts(spark, sf_dir):
    return V.tier_counts(inputs.predictions(spark, sf_dir))


HISTOGRAM_SQL = """
vals AS (SELECT prediction_run_id, 'return_pct' AS metric, coalesce(pred_return, 0) * 100 AS v
        FROM preds
    UNION ALL SELECT prediction_run_id, 'gate', coalesce(graph_gate, 0) FROM preds),
lims AS (SELECT prediction_run_id, metric, min(v) AS lo,
    CASE WHEN max(v) <> min(v) THEN max(v) - min(v) ELSE 1.0 END / 5 AS width
    FROM vals GROUP BY 1, 2),
frac AS (SELECT *, pow(10.0, floor(log10(width))) AS power FROM lims),
stepped AS (SELECT *, power * CASE WHEN width / power <= 1 THEN 1.0 WHEN width / power <= 2 THEN 2.0
    WHEN width / power <= 5 THEN 5.0 ELSE 10.0 END AS step FROM frac),
e0 AS (SELECT *, floor(lo / step) * step AS a0 FROM stepped),
edges AS (SELECT *, a0 + step AS a1, a0 + step + step AS a2, a0 + step + step + step AS a3,
    a0 + step + step + step + step AS a4, a0 + step + step + step + step + step AS a5 FROM e0),
bins AS (SELECT prediction_run_id, metric, 0 AS bin, a0 AS low, a1 AS high, step FROM edges
    UNION ALL SELECT prediction_run_id, metric, 1, a1, a2, step FROM edges
    UNION ALL SELECT prediction_run_id, metric, 2, a2, a3, step FROM edges
    UNION ALL SELECT prediction_run_id, metric, 3, a3, a4, step FROM edges
    UNION ALL SELECT prediction_run_id, metric, 4, a4, a5, step FROM edges)"""


@query("agg18_histogram", "prediction_run_id metric bin:i low:f high:f n:i",
       PREDICTION_PREFIX + "," + HISTOGRAM_SQL, """
SELECT b.prediction_run_id, b.metric, b.bin, b.low, b.high, count(v.v) FILTER (WHERE v.v >= b.low
    AND (v.v < b.high OR (b.bin = 4 AND v.v <= b.high))) AS n
FROM bins b LEFT JOIN vals v ON b.prediction_run_id = v.prediction_run_id AND b.metric = v.metric
GROUP BY 1, 2, 3, 4, 5""")
def histogram(spark, sf_dir):
    return V.histogram(inputs.predictions(spark, sf_dir))


@query("agg22_movers_known", "prediction_run_id side ticker value:f", PREDICTION_PREFIX, """
SELECT prediction_run_id, side, ticker, value FROM (
    SELECT prediction_run_id, 'top' AS side, ticker, pred_return AS value, row_number() OVER (
        PARTITION BY prediction_run_id ORDER BY pred_return DESC, ticker) AS rk
    FROM preds WHERE pred_return IS NOT NULL
    UNION ALL SELECT prediction_run_id, 'bottom', ticker, pred_return, row_number() OVER (
        PARTITION BY prediction_run_id ORDER BY pred_return, ticker)
    FROM preds WHERE pred_return IS NOT NULL) x WHERE rk = 1""")
def movers_known(spark, sf_dir):
    return V.movers(inputs.predictions(spark, sf_dir))


@query("agg22_movers_zero", "prediction_run_id side ticker value:f", PREDICTION_PREFIX, """
SELECT prediction_run_id, side, ticker, value FROM (
    SELECT prediction_run_id, 'top' AS side, ticker, coalesce(pred_return, 0) AS value,
        row_number() OVER (PARTITION BY prediction_run_id
            ORDER BY coalesce(pred_return, 0) DESC, ticker) AS rk FROM preds
    UNION ALL SELECT prediction_run_id, 'bottom', ticker, coalesce(pred_return, 0),
        row_number() OVER (PARTITION BY prediction_run_id
            ORDER BY coalesce(pred_return, 0), ticker) FROM preds) x WHERE rk = 1""")
def movers_zero(spark, sf_dir):
    return V.movers(inputs.predictions(spark, sf_dir), null_as_zero=True)


@query("top1_confidence", "ticker confidence:f", PREDICTION_PREFIX, """
SELECT ticker, coalesce(graph_gate, 0) AS confidence FROM run
ORDER BY confidence DESC, ticker LIMIT 5""")
def top_confidence(spark, sf_dir):
    return V.top_confidence(_run(spark, sf_dir))


@query("top2_return_extremes", "side ticker return_pct:f", PREDICTION_PREFIX, """
SELECT * FROM (SELECT 'top' AS side, ticker, coalesce(pred_return, 0) * 100 AS return_pct FROM run
    ORDER BY return_pct DESC, ticker LIMIT 5) a
UNION ALL SELECT * FROM (SELECT 'bottom', ticker, coalesce(pred_return, 0) * 100 AS return_pct
    FROM run ORDER BY return_pct, ticker DESC LIMIT 5) b""")
def return_extremes(spark, sf_dir):
    return V.return_extremes(_run(spark, sf_dir))


@query("flt8_usable_closes", "symbol date:d close:f", BAR_PREFIX,
       "SELECT * FROM gapped WHERE close IS NOT NULL")
def usable_closes(spark, sf_dir):
    """Closes that went through text, as in a price file; holes come back as blanks."""
    text = inputs.gapped_bars(spark, sf_dir).withColumn(
        "close_text", F.coalesce(F.col("close").cast("string"), F.lit("n/a")))
    return text.select("symbol", "date", P.to_number(F.col("close_text")).alias("close")) \
        .filter(F.col("close").isNotNull())


@query("win11_last_prices", "symbol date:d close:f", BAR_PREFIX, """
SELECT symbol, date, close FROM (SELECT *, row_number() OVER (PARTITION BY symbol
    ORDER BY date DESC) AS rk FROM bars_day) x WHERE rk <= 30""")
def last_prices(spark, sf_dir):
    return V.last_prices(inputs.bars_day(spark, sf_dir), 30)


@query("win12_price_changes", "symbol date:d change:f change_pct:f", BAR_PREFIX, """
SELECT symbol, date, close - coalesce(prev, close) AS change, CASE WHEN coalesce(prev, close) > 0
    THEN (close - coalesce(prev, close)) / coalesce(prev, close) * 100 ELSE 0 END AS change_pct
FROM feat_lag""")
def price_changes(spark, sf_dir):
    return V.price_changes(inputs.bars_day(spark, sf_dir))


@query("agg19_price_statistics", "symbol min_close:f max_close:f mean_close:f newest_close:f "
       "price_range:f volatility_pct:f", BAR_PREFIX, """
SELECT symbol, min(close) AS min_close, max(close) AS max_close, avg(close) AS mean_close,
    arg_max(close, date) AS newest_close, max(close) - min(close) AS price_range,
    (max(close) - min(close)) / avg(close) * 100 AS volatility_pct
FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rk FROM bars_day) x
WHERE rk <= 30 GROUP BY 1""")
def price_statistics(spark, sf_dir):
    return V.price_statistics(V.last_prices(inputs.bars_day(spark, sf_dir), 30))
