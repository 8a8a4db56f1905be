"""Queries that go through a sink and come back through a source, and data checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions import scalars as P
from barloom.guards import DataCheckError
from barloom.operators import quality as Q
from barloom.operators import ticks as K
from barloom.operators.bars import BAR_COLUMNS
from barloom.plans import inputs
from barloom.plans.oracle_prefix import BARS, MESSAGES, PREDICTION_PREFIX, TICK_PREFIX
from barloom.plans.registry import query
from barloom.plans.tick_queries import BAR_SPEC, PREDICTION_SPEC, TICK_SPEC, UPSERT_SQL, rerun_rows
from barloom.session import stage, staging_path
from barloom.sinks import files
from barloom.sinks.publish import message_frame, tick_messages
from barloom.sinks.run_store import RunStore
from barloom.sources import documents, messages, prices, tables

NO_PREFIX = "one AS (SELECT 1)"
TABLES = ["orders", "lineitem", "part", "events"]


@query("src1_stored_messages", TICK_SPEC, MESSAGES, "SELECT * FROM ticks")
def stored_messages(spark, sf_dir):
    path = staging_path(spark, "messages")
    inputs.raw_messages(spark, sf_dir).write.parquet(path)
    return K.parse_ticks(messages.read_message_files(spark, path))


@query("snk1_tick_files", TICK_SPEC, MESSAGES, "SELECT * FROM ticks")
def tick_files(spark, sf_dir):
    path = staging_path(spark, "ticks")
    files.overwrite_parquet(inputs.ticks(spark, sf_dir), path)
    return tables.read_parquet_prefix(spark, path, K.TICK_COLUMNS)


@query("snk6_replaced_prefix", BAR_SPEC, BARS, "SELECT * FROM bars_month")
def replaced_prefix(spark, sf_dir):
    path = staging_path(spark, "prefix")
    files.replace_prefix(inputs.bars_day(spark, sf_dir), path)
    files.replace_prefix(inputs.bars_month(spark, sf_dir), path)
    return tables.read_parquet_prefix(spark, path, BAR_COLUMNS)


@query("snk7_csv_cache", BAR_SPEC, BARS + """,
filled AS (SELECT symbol, date, open, high, low, volume,
    last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS close FROM gapped)""", """
SELECT symbol, date, coalesce(open, close) AS open, coalesce(high, close) AS high,
    coalesce(low, close) AS low, close, coalesce(volume, 0.0) AS volume
FROM filled WHERE close IS NOT NULL""")
def csv_cache(spark, sf_dir):
    path = staging_path(spark, "cache")
    files.write_bar_cache(inputs.gapped_bars(spark, sf_dir), path)
    return prices.read_bar_cache(spark, path)


@query("snk8_json_documents", "as_of_date:d ticker last_close:f pred_close:f pred_return:f "
       "graph_gate:f", PREDICTION_PREFIX, "SELECT * FROM preds")
def json_documents(spark, sf_dir):
    path = staging_path(spark, "documents")
    files.write_json(files.prediction_documents(inputs.predictions(spark, sf_dir)), path)
    read = spark.read.schema(documents.DOCUMENT_SCHEMA).json(path)
    return documents.document_rows(read)


@query("snk9_published_ticks", "symbol price:f topic", TICK_PREFIX, """
SELECT symbol, round(arg_max(close, date), 4) AS price, 'stock-price' AS topic
FROM bars_event GROUP BY symbol""")
def published_ticks(spark, sf_dir):
    path = staging_path(spark, "topic")
    sent = tick_messages(inputs.bars_event_day(spark, sf_dir))
    message_frame(sent, inputs.TOPIC).write.parquet(path)
    return K.parse_ticks(messages.read_message_files(spark, path))


@query("snk5_upserted_table", PREDICTION_SPEC, PREDICTION_PREFIX, UPSERT_SQL)
def upserted_table(spark, sf_dir):
    store = RunStore(spark, staging_path(spark, "predictions"))
    preds = stage(inputs.predictions(spark, sf_dir))
    store.create(preds)
    store.upsert(rerun_rows(preds), now=F.to_timestamp(F.lit("2030-01-01 00:00:00")))
    return store.rows()


@query("snk5_run_directory", "prediction_run_id as_of_date:d model_name row_count:i "
       "first_created_at:t last_created_at:t", PREDICTION_PREFIX, f"""
SELECT prediction_run_id, as_of_date, model_name, count(*) AS row_count,
    min(created_at) AS first_created_at, max(created_at) AS last_created_at
FROM ({UPSERT_SQL}) u GROUP BY 1, 2, 3""")
def run_directory(spark, sf_dir):
    store = RunStore(spark, staging_path(spark, "predictions"))
    preds = stage(inputs.predictions(spark, sf_dir))
    store.create(preds)
    store.upsert(rerun_rows(preds), now=F.to_timestamp(F.lit("2030-01-01 00:00:00")))
    return store.runs()


@query("prj3_numeric_text", "event_id:i number:f", NO_PREFIX, """
SELECT event_id, try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS number FROM events""")
def numeric_text(spark, sf_dir):
    text = F.get_json_object("props", "$.k")
    return inputs.table(spark, sf_dir, "events").select(
        "event_id", P.to_number(text).alias("number"))


@query("prj6_symbol_list", "p_partkey:i position:i symbol", NO_PREFIX, """
SELECT p_partkey, unnest(range(len(parts))) AS position, unnest(parts) AS symbol FROM (
    SELECT p_partkey, list_filter(list_transform(string_split(
        ' ' || p_brand || ' ,' || p_type || ', ,' || p_name, ','), lambda s: upper(trim(s))),
        lambda s: s <> '') AS parts FROM part) x""")
def symbol_list(spark, sf_dir):
    text = F.concat(F.lit(" "), "p_brand", F.lit(" ,"), "p_type", F.lit(", ,"), "p_name")
    return inputs.table(spark, sf_dir, "part").select(
        "p_partkey", F.posexplode(P.symbol_list(text)).alias("position", "symbol"))


@query("dq3_table_state", "tables_ok missing_tables tick_count:i", MESSAGES, """
SELECT false AS tables_ok, 'ONE,TWO' AS missing_tables, count(*) AS tick_count FROM ticks""")
def table_state(spark, sf_dir):
    ticks = inputs.ticks(spark, sf_dir)
    present = ticks.select(F.col("symbol").alias("table_name"))
    return Q.table_state(Q.missing_names(["TWO", "CLICK", "ONE", "VIEW"], present), ticks)


AUDIT_SPEC = ("run_id all_ok n_checks:i n_failed:i tables_ok output_ok tick_count:i parquet_files_count:i "
              "has_success_marker missing_tables notes")


@query("dq4_audit_row", AUDIT_SPEC, MESSAGES, """
SELECT 'nightly' AS run_id, true AS all_ok, 4 AS n_checks, 0 AS n_failed, NULL::BOOLEAN AS tables_ok,
    NULL::BOOLEAN AS output_ok, NULL::BIGINT AS tick_count, NULL::BIGINT AS parquet_files_count,
    NULL::BOOLEAN AS has_success_marker, NULL::VARCHAR AS missing_tables,
    'all checks completed' AS notes FROM (SELECT count(*) AS n FROM orders) o WHERE n > 0
UNION ALL
SELECT 'failing', false, 6, 2, false, false, (SELECT count(*) FROM ticks), 0, false, 'checked_absent',
    'output nowhere=parquet_files=0, success_marker=False | table checked_absent=does not exist'""")
def audit_row(spark, sf_dir):
    """A passing run of the older, narrower layout, then a failing one with all fields."""
    path = staging_path(spark, "audit")
    checks = []
    for name in TABLES:
        inputs.table(spark, sf_dir, name).createOrReplaceTempView(f"checked_{name}")
        checks.append(Q.has_rows(spark, f"checked_{name}"))
    Q.run_gate(Q.checks_frame(spark, checks), "nightly", path)
    nowhere = staging_path(spark, "nowhere")
    files_count, marker = files.output_state(spark, nowhere)
    absent = Q.has_rows(spark, "checked_absent")
    name, ok, detail = Q.output_complete(spark, nowhere)
    failing = Q.checks_frame(spark, [*checks, absent, ("output nowhere", ok, detail)])
    try:
        Q.run_gate(failing, "failing", path, {"tables": "table", "output": "output"}, {
            "tick_count": inputs.ticks(spark, sf_dir).count(), "parquet_files_count": files_count,
            "has_success_marker": marker, "missing_tables": "checked_absent"})
    except DataCheckError:
        return Q.read_audit(spark, path)
    raise AssertionError("the gate let failed checks pass")


# Header lines of price files, dealt over the symbols in their order.
LAYOUTS = [["Date", "Open", "High", "Low", "Close", "Volume"], ["datetime", "Close", "Volume"],
           ["Date", "Volume", "Close", "Low", "High", "Open"]]


def _price_folder(spark, bars):
    path = staging_path(spark, "prices")
    bars = stage(bars.select("symbol", *(F.col(n.lower()).alias(n) for n in LAYOUTS[0])), "bars")
    # One name per order priority.
    names = sorted(r["symbol"] for r in bars.select("symbol").distinct().collect())
    for k, name in enumerate(names):
        rows = bars.filter(F.col("symbol") == name).withColumn("datetime", F.col("Date"))
        files.write_named_csv(rows.select(LAYOUTS[k % 3]), path,
                              name.replace("-", "+") if k % 3 == 0 else name)
    return path


@query("src3_price_files", BAR_SPEC, BARS + """,
named AS (SELECT *, (dense_rank() OVER (ORDER BY symbol) - 1) % 3 AS layout FROM bars_day)""", """
SELECT CASE WHEN layout = 0 THEN replace(symbol, '-', '+') ELSE symbol END AS symbol, date,
    CASE WHEN layout = 1 THEN close ELSE open END AS open,
    CASE WHEN layout = 1 THEN close ELSE high END AS high,
    CASE WHEN layout = 1 THEN close ELSE low END AS low, close, volume FROM named""")
def price_files(spark, sf_dir):
    """A folder of one CSV file per symbol in three layouts, names with blanks and plus signs."""
    return prices.read_price_csv(spark, _price_folder(spark, inputs.bars_day(spark, sf_dir)))


@query("src4_close_history", "symbol date:d close:f", BARS + """,
named AS (SELECT *, (dense_rank() OVER (ORDER BY symbol) - 1) % 3 AS layout FROM bars_month)""", """
SELECT CASE WHEN layout = 0 THEN replace(symbol, '-', '+') ELSE symbol END AS symbol, date, close
FROM named""")
def close_history(spark, sf_dir):
    return prices.read_close_history(spark, _price_folder(spark, inputs.bars_month(spark, sf_dir)))
