"""Shared CTEs of the SQL checks: the same inputs, stated in plain SQL."""

FEATURES = """
{name}_lag AS (SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY date) AS prev,
    row_number() OVER (PARTITION BY symbol ORDER BY date) AS rn FROM {bars}),
{name}_ret AS (SELECT symbol, date, open, high, low, close, volume,
    CASE WHEN rn = 1 THEN 0.0 ELSE close / nullif(prev, 0) - 1 END AS ret FROM {name}_lag),
{name}_all AS (SELECT *,
    CASE WHEN count(close) OVER w5 = 5 THEN avg(close) OVER w5 END AS ma5,
    CASE WHEN count(close) OVER w20 = 20 THEN avg(close) OVER w20 END AS ma20,
    CASE WHEN count(ret) OVER w5 = 5 THEN stddev_samp(ret) OVER w5 END AS vol5,
    CASE WHEN count(ret) OVER w20 = 20 THEN stddev_samp(ret) OVER w20 END AS vol20
    FROM {name}_ret
    WINDOW w5 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
           w20 AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
{name} AS (SELECT * FROM {name}_all WHERE open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL
    AND volume IS NOT NULL AND close IS NOT NULL AND ret IS NOT NULL AND ma5 IS NOT NULL
    AND ma20 IS NOT NULL AND vol5 IS NOT NULL AND vol20 IS NOT NULL)"""

PANEL = """
{name}_cal AS (SELECT date, CAST(row_number() OVER (ORDER BY date) - 1 AS INTEGER) AS t FROM (
    SELECT date FROM {feat} GROUP BY date
    HAVING count(DISTINCT symbol) = (SELECT count(DISTINCT symbol) FROM {feat})) d),
{name} AS (SELECT f.*, c.t FROM {feat} f JOIN {name}_cal c ON f.date = c.date)"""

MESSAGES = """
messages AS (SELECT upper(event_type) AS key_str, 'stock-price' AS topic,
    CAST(user_id % 4 AS INTEGER) AS partition_id, event_id AS kafka_offset, ts AS event_time,
    CASE WHEN event_id % 97 <> 0 AND event_id % 83 <> 0 THEN upper(event_type) END AS symbol,
    CASE WHEN event_id % 97 <> 0 AND event_id % 89 <> 0 THEN value END AS price FROM events),
ticks AS (SELECT symbol, price, topic, partition_id, kafka_offset, event_time FROM messages
    WHERE symbol IS NOT NULL AND price IS NOT NULL),
ranked_ticks AS (SELECT *, row_number() OVER (PARTITION BY symbol
    ORDER BY event_time DESC, kafka_offset DESC, partition_id DESC) AS rk FROM ticks),
latest AS (SELECT symbol, price, partition_id, kafka_offset, event_time FROM ranked_ticks
    WHERE rk = 1)"""

BARS = """
bars_day AS (SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date,
    arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
    min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
    CAST(count(*) AS DOUBLE) AS volume FROM orders GROUP BY 1, 2),
bars_month AS (SELECT o_orderpriority AS symbol,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
    arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
    min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
    CAST(count(*) AS DOUBLE) AS volume FROM orders GROUP BY 1, 2),
event_ends AS (SELECT upper(event_type) AS symbol, CAST(ts AS DATE) AS date, value,
    row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts, event_id) AS a,
    row_number() OVER (PARTITION BY event_type, CAST(ts AS DATE)
        ORDER BY ts DESC, event_id DESC) AS z FROM events),
bars_event AS (SELECT symbol, date, max(CASE WHEN a = 1 THEN value END) AS open,
    max(value) AS high, min(value) AS low, max(CASE WHEN z = 1 THEN value END) AS close,
    CAST(count(*) AS DOUBLE) AS volume FROM event_ends GROUP BY 1, 2),
bars_brand AS (SELECT p_brand AS symbol, CAST(l_shipdate AS DATE) AS date,
    avg(l_extendedprice / l_quantity) AS open, max(l_extendedprice / l_quantity) AS high,
    min(l_extendedprice / l_quantity) AS low, avg(l_extendedprice / l_quantity) AS close,
    sum(l_quantity) AS volume FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
gapped AS (SELECT symbol, date, CASE WHEN volume <> 2 THEN open END AS open, high, low,
    CASE WHEN volume <> 1 THEN close END AS close,
    CASE WHEN volume <> 3 THEN volume END AS volume FROM bars_day)"""

PREDICTIONS = """
preds AS (SELECT 'run_' || strftime(date, '%Y%m%d') AS prediction_run_id, date AS as_of_date,
    CASE WHEN t % 2 = 0 THEN 'model_even' ELSE 'model_odd' END AS model_name, symbol AS ticker,
    close AS last_close, ma5 AS pred_close,
    CASE WHEN t % 13 <> 0 AND abs(close) > 1e-12 THEN (ma5 - close) / abs(close) END
        AS pred_return,
    CASE WHEN t % 13 <> 0 THEN abs(ret) / (1 + abs(ret)) END AS graph_gate,
    CAST(date AS TIMESTAMP) + INTERVAL 18 HOUR
        + to_seconds(row_number() OVER (PARTITION BY date ORDER BY symbol)) AS created_at
    FROM panel),
last_run AS (SELECT prediction_run_id FROM preds GROUP BY 1
    ORDER BY max(created_at) DESC, prediction_run_id DESC LIMIT 1),
run AS (SELECT p.* FROM preds p JOIN last_run l ON p.prediction_run_id = l.prediction_run_id)"""

# Backtest constants: lookback 20, 20 test days, 200 initial training days, 20 validation
# days, graph window 120.
BACKTEST = """
dims AS (SELECT max(t) + 1 AS n_dates, max(t) + 1 - 20 AS first_test,
    greatest(0, max(t) + 1 - 20 - 200) AS train_start FROM panel_cal),
steps AS (SELECT CAST(c.t - d.first_test + 1 AS INTEGER) AS step, c.t AS test_t,
    c.date AS test_date, d.train_start, c.t - 1 AS train_end,
    greatest(d.train_start, c.t - 120) AS graph_start
    FROM panel_cal c, dims d WHERE c.t >= d.first_test),
close_range AS (SELECT symbol, min(close) AS close_min, max(close) AS close_max
    FROM panel, dims WHERE t BETWEEN train_start AND first_test - 1 GROUP BY symbol),
scaled AS (SELECT p.t, p.date, p.symbol, p.ret,
    (p.close - r.close_min) / CASE WHEN r.close_max <> r.close_min
        THEN r.close_max - r.close_min ELSE 1 END AS close
    FROM panel p JOIN close_range r ON p.symbol = r.symbol),
msamples AS (SELECT t, date, symbol AS ticker, close AS y_true, lag(close) OVER w AS last_close,
    lag(close) OVER w AS naive,
    avg(close) OVER (PARTITION BY symbol ORDER BY t ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
        AS ma5,
    avg(close) OVER (PARTITION BY symbol ORDER BY t ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)
        AS ma20,
    abs(lag(ret) OVER w) AS move
    FROM scaled WINDOW w AS (PARTITION BY symbol ORDER BY t)),
tests AS (SELECT m.*, s.step FROM msamples m JOIN steps s ON m.t = s.test_t),
fc AS (SELECT 'naive' AS model, step, date, ticker, y_true, naive AS y_pred, last_close,
        move / (1 + move) AS gate FROM tests
    UNION ALL SELECT 'ma5', step, date, ticker, y_true, ma5, last_close, move / (2 + move)
        FROM tests
    UNION ALL SELECT 'ma20', step, date, ticker, y_true, ma20, last_close, move / (3 + move)
        FROM tests),
samples AS (SELECT t, date, symbol, lag(close) OVER w AS last_close, close AS target,
    close - lag(close) OVER w AS residual, lag(volume) OVER w AS node_volume,
    lag(ret) OVER w AS node_ret, lag(ma5) OVER w AS node_ma5, lag(ma20) OVER w AS node_ma20,
    lag(vol5) OVER w AS node_vol5, lag(vol20) OVER w AS node_vol20
    FROM panel WINDOW w AS (PARTITION BY symbol ORDER BY t)),
day_mse AS (SELECT model, step, date, avg(pow(y_true - y_pred, 2)) AS day_mse FROM fc
    GROUP BY 1, 2, 3),
tick_mse AS (SELECT model, ticker, avg(pow(y_true - y_pred, 2)) AS mse FROM fc GROUP BY 1, 2)"""

# Graph constants: Pearson 0.02 top 2, support 0.05, confidence 0.10, lift 1.0 top 2,
# association weight 0.5, final top 2.
PAIRS = """
win_rows AS (SELECT s.step, p.t, p.symbol, p.ret FROM {panel} p
    JOIN {steps} s ON p.t BETWEEN s.graph_start AND s.train_end),
freq AS (SELECT step, symbol, avg(CASE WHEN ret > 0 THEN 1.0 ELSE 0.0 END) AS p_up,
    avg(CASE WHEN ret < 0 THEN 1.0 ELSE 0.0 END) AS p_down, avg(ret) AS mean_ret,
    min(ret) AS min_ret, max(ret) AS max_ret FROM win_rows GROUP BY 1, 2),
dev AS (SELECT w.*, w.ret - f.mean_ret AS d FROM win_rows w
    JOIN freq f ON w.step = f.step AND w.symbol = f.symbol),
moments AS (SELECT x.step, x.symbol AS src, y.symbol AS dst,
    sum(x.d * y.d) AS sxy, sum(x.d * x.d) AS sxx, sum(y.d * y.d) AS syy,
    avg(CASE WHEN x.ret > 0 AND y.ret > 0 THEN 1.0 ELSE 0.0 END) AS both_up,
    avg(CASE WHEN x.ret < 0 AND y.ret < 0 THEN 1.0 ELSE 0.0 END) AS both_down
    FROM dev x JOIN dev y ON x.step = y.step AND x.t = y.t AND x.symbol <> y.symbol
    GROUP BY 1, 2, 3),
directed AS (SELECT m.step, m.src, m.dst,
    CASE WHEN a.min_ret = a.max_ret OR b.min_ret = b.max_ret THEN 0.0
        ELSE sxy / sqrt(sxx * syy) END AS corr,
    both_up, both_down, a.p_up AS up_src, b.p_up AS up_dst, a.p_down AS down_src,
    b.p_down AS down_dst
    FROM moments m JOIN freq a ON m.step = a.step AND m.src = a.symbol
    JOIN freq b ON m.step = b.step AND m.dst = b.symbol),
pearson_raw AS (SELECT step, src, dst, round(abs(corr), 12) AS weight FROM directed
    WHERE round(abs(corr), 12) >= 0.02),
rules AS (SELECT step, src, dst, greatest(both_up, both_down) AS support,
    greatest(both_up / (up_src + 1e-8), both_down / (down_src + 1e-8)) AS confidence,
    greatest(both_up / (up_src * up_dst + 1e-8), both_down / (down_src * down_dst + 1e-8)) AS lift
    FROM directed),
kept_rules AS (SELECT * FROM rules WHERE support >= 0.05 AND confidence >= 0.10 AND lift >= 1.0),
assoc_raw AS (SELECT step, src, dst, round(lift / max(lift) OVER (PARTITION BY step), 12) AS weight
    FROM kept_rules)"""

TOPK = """
{name}_top AS (SELECT step, src, dst, weight FROM (SELECT *, row_number() OVER (
    PARTITION BY step, src ORDER BY weight DESC, dst DESC) AS rk FROM {edges}
    WHERE weight > 0) r WHERE rk <= {k}),
{name} AS (SELECT step, src, dst, max(weight) AS weight FROM (
    SELECT * FROM {name}_top UNION ALL SELECT step, dst, src, weight FROM {name}_top) u
    GROUP BY 1, 2, 3)"""


def graph_ctes(panel: str, steps: str) -> str:
    parts = [
        PAIRS.format(panel=panel, steps=steps),
        TOPK.format(name="pearson", edges="pearson_raw", k=2),
        TOPK.format(name="assoc", edges="assoc_raw", k=2),
        """
merged AS (SELECT step, src, dst, max(weight) AS weight FROM (
    SELECT * FROM pearson UNION ALL SELECT step, src, dst, weight * 0.5 FROM assoc) u
    GROUP BY 1, 2, 3)""",
        TOPK.format(name="combined", edges="merged", k=2),
        f"""
looped AS (SELECT step, src, dst, weight FROM combined UNION ALL
    SELECT s.step, p.symbol, p.symbol, 1.0
    FROM {steps} s, (SELECT DISTINCT symbol FROM {panel}) p),
degree AS (SELECT step, src, greatest(sum(weight), 1e-8) AS deg FROM looped GROUP BY 1, 2),
graph AS (SELECT l.step, l.src, l.dst, l.weight,
    l.weight / sqrt(a.deg * b.deg) AS norm_weight FROM looped l
    JOIN degree a ON l.step = a.step AND l.src = a.src
    JOIN degree b ON l.step = b.step AND l.dst = b.src)"""]
    return ",".join(parts)


TICK_PREFIX = ",".join([MESSAGES, BARS])
BAR_PREFIX = ",".join([BARS, FEATURES.format(name="feat", bars="bars_day"),
                       PANEL.format(name="panel", feat="feat")])
PREDICTION_PREFIX = ",".join([BAR_PREFIX, PREDICTIONS])
BACKTEST_PREFIX = ",".join([BAR_PREFIX, BACKTEST])
GRAPH_PREFIX = ",".join([BACKTEST_PREFIX, graph_ctes("panel", "steps")])
