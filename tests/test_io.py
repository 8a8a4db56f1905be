"""Sources, sinks, upsert, checks and the audit gate."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barloom.guards import DataCheckError
from barloom.operators import metrics as M
from barloom.operators import quality as Q
from barloom.operators import scoring
from barloom.operators import serving as V
from barloom.operators import ticks as K
from barloom.sinks import files, relational
from barloom.sinks.publish import message_frame, tick_messages
from barloom.sinks.run_store import RunStore
from barloom.sinks.upsert import last_per_key, upsert_rows
from barloom.sources import documents, messages, prices, tables
from tests.panels import bars, day
from tests.test_golden import PREDICTION, at


def csv(folder: Path, name: str, text: str) -> str:
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_price_csv_variants(spark, tmp_path):
    one = csv(tmp_path / "a", "AAPL.csv",
              "Date,Open,High,Low,Close,Adj Close,Volume\n2024-01-03,3,4,2,x,9,7\n"
              "2024-01-02,1,2,,1.5,9,\n2024-01-01,,,,,,5\n")
    rows = prices.read_price_csv(spark, one).orderBy("date").collect()
    assert [tuple(r) for r in rows] == [
        ("AAPL", day(1), 1.0, 2.0, 1.5, 1.5, 0.0), ("AAPL", day(2), 3.0, 4.0, 2.0, 1.5, 7.0)]
    two = csv(tmp_path / "b", "BRK.B.csv",
              "datetime,Close\n2024-01-01 09:30:00,5\n2024-01-02 16:00:00,6\n")
    rows = prices.read_price_csv(spark, two).orderBy("date").collect()
    assert [tuple(r) for r in rows] == [("BRK.B", day(0), 5.0, 5.0, 5.0, 5.0, 0.0),
                                        ("BRK.B", day(1), 6.0, 6.0, 6.0, 6.0, 0.0)]


def test_price_csv_needs_date_and_close(spark, tmp_path):
    with pytest.raises(DataCheckError, match="Close"):
        prices.read_price_csv(spark, csv(tmp_path / "a", "A.csv", "Date,Open\n2024-01-01,1\n"))
    with pytest.raises(DataCheckError, match="date"):
        prices.read_price_csv(spark, csv(tmp_path / "b", "A.csv", "Close\n1\n"))


def test_price_folder(spark, tmp_path):
    for name in ("MSFT", "AAPL"):
        folder = csv(tmp_path / "raw", f"{name}.csv", "Date,Close,Volume\n2024-01-01,1,2\n")
    assert [r.symbol for r in prices.read_price_csv(spark, folder).orderBy("symbol").collect()] \
        == ["AAPL", "MSFT"]
    assert prices.read_price_csv(spark, folder, ["MSFT"]).count() == 1


def test_close_history_skips_bad_rows(spark, tmp_path):
    folder = csv(tmp_path / "raw", "A.csv", "date,close\n2024-01-01,1\n2024-01-02,\n,3\n"
                                            "2024-01-04,abc\n2024-01-05,5\n")
    assert [r.close for r in prices.read_close_history(spark, folder).orderBy("date").collect()] \
        == [1.0, 5.0]


def test_parquet_prefix_guards(spark, tmp_path):
    path = str(tmp_path / "set")
    with pytest.raises(DataCheckError):
        tables.read_parquet_prefix(spark, path)
    frame = bars(spark, {"A": [1.0]})
    files.overwrite_parquet(frame, path, files=1)
    assert tables.read_parquet_prefix(spark, path, ["symbol"]).count() == 1
    with pytest.raises(DataCheckError, match="price"):
        tables.read_parquet_prefix(spark, path, ["symbol", "price"])
    files.overwrite_parquet(frame.limit(0), path)
    with pytest.raises(DataCheckError, match="no rows"):
        tables.read_parquet_prefix(spark, path)


def test_overwrite_and_replace(spark, tmp_path):
    path = str(tmp_path / "out")
    files.overwrite_parquet(bars(spark, {"A": [1.0, 2.0]}), path)
    files.overwrite_parquet(bars(spark, {"B": [3.0]}), path, files=1)
    assert [r.symbol for r in spark.read.parquet(path).collect()] == ["B"]
    assert files.output_state(spark, path) == (1, True)
    with pytest.raises(DataCheckError):
        files.replace_prefix(bars(spark, {"B": [3.0]}).limit(0), path)
    assert spark.read.parquet(path).count() == 1
    files.replace_prefix(bars(spark, {"C": [3.0]}), path)
    assert spark.read.parquet(path).first().symbol == "C"


def test_csv_report_and_cache(spark, tmp_path):
    frame = bars(spark, {"A": [1.0, 2.0], "B": [3.0]})
    files.write_report(frame, str(tmp_path / "report"))
    assert spark.read.option("header", True).csv(str(tmp_path / "report")).count() == 3
    files.write_bar_cache(frame, str(tmp_path / "cache"))
    assert sorted(p.name for p in (tmp_path / "cache").glob("symbol=*")) == ["symbol=A", "symbol=B"]


def test_topic_options():
    assert messages.topic_options("h:1", "stock-price", "earliest", "latest") == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "stock-price",
        "startingOffsets": "earliest", "endingOffsets": "latest"}
    assert "endingOffsets" not in messages.topic_options("h:1", "t", "latest")


def test_relational_overwrite_refuses_empty(spark):
    options = tables.jdbc_options("jdbc:nowhere:x", "ticks", user="u", fetchsize=10)
    assert options == {"url": "jdbc:nowhere:x", "dbtable": "ticks", "user": "u", "fetchsize": "10"}
    with pytest.raises(DataCheckError, match="ticks"):
        relational.overwrite_table(bars(spark, {"A": [1.0]}).limit(0), options)


def test_inline_rows(spark):
    assert tables.inline_rows(spark, [("A", 1.0), ("B", 2.0)], "symbol string, price double") \
        .count() == 2


def test_published_messages_parse_back(spark):
    frame = bars(spark, {"A": [1.0, 2.123456], "B": [5.0, None], "C": [7.0, float("nan")]})
    sent = tick_messages(frame, F.to_timestamp(F.lit("2024-01-05 01:02:03")))
    body = json.loads(sent.first().value)
    assert body["price"] == 2.1235 and body["source"] == "bars"
    assert body["event_time"].startswith("2024-01-05T01:02:03")
    raw = message_frame(sent, "stock-price", F.to_timestamp(F.lit("2024-01-05 01:02:03")))
    assert raw.columns == messages.MESSAGE_COLUMNS
    assert [(r.symbol, r.price) for r in K.parse_ticks(raw).collect()] == [("A", 2.1235)]


def document(rows):
    return {"checkpoint": "c.pt", "input_npz": "w.npz", "as_of_date": "2024-01-05",
            "device": "cpu", "model_dims": {"lookback": 20}, "num_nodes": len(rows),
            "predictions": rows}


def item(ticker, pred=1.0, ret=None):
    return {"ticker": ticker, "last_close": 1.0, "pred_close": pred, "pred_return": ret,
            "graph_gate": 0.5}


def write_document(tmp_path, rows):
    path = tmp_path / "pred.json"
    path.write_text(json.dumps(document(rows), indent=2))
    return str(path)


def test_document_to_stored_run(spark, tmp_path):
    path = write_document(tmp_path, [item("A"), item("B", 2.0, 1.0), item("A", 3.0)])
    rows = documents.document_rows(documents.read_prediction_documents(spark, path))
    run = scoring.stored_run(rows, "hybrid", "local_20240105_000000")
    stored = {r.ticker: r for r in last_per_key(run).collect()}
    assert stored["A"].pred_close == 3.0 and stored["A"].pred_return is None
    assert stored["B"].pred_return == 1.0 and stored["B"].checkpoint_path == "c.pt"
    assert stored["A"].as_of_date == dt.date(2024, 1, 5)
    assert stored["A"].output_json_path.endswith("pred.json")


def test_empty_document_is_refused(spark, tmp_path):
    with pytest.raises(DataCheckError):
        documents.document_rows(
            documents.read_prediction_documents(spark, write_document(tmp_path, [])))
    other = tmp_path / "other.json"
    other.write_text('{"as_of_date": "2024-01-05"}')
    with pytest.raises(DataCheckError):
        documents.document_rows(documents.read_prediction_documents(spark, str(other)))


def test_documents_round_trip(spark, tmp_path):
    rows = spark.createDataFrame(
        [("r1", day(0), "m", t, 1.0, 2.0, None, 0.5, at(0)) for t in "BA"], PREDICTION)
    files.write_json(files.prediction_documents(rows), str(tmp_path / "docs"))
    text = "".join(p.read_text() for p in (tmp_path / "docs").glob("part-*.json"))
    body = json.loads(text)
    assert body["num_nodes"] == 2
    assert [p["ticker"] for p in body["predictions"]] == ["A", "B"]
    assert body["predictions"][0]["pred_return"] is None


def test_run_id(spark):
    stamp = spark.range(1).select(
        scoring.run_id("local", F.to_timestamp(F.lit("2024-01-05 01:02:03")))).first()[0]
    assert stamp == "local_20240105_010203"


def stored(spark, run, values, hour):
    return spark.createDataFrame(
        [(run, day(0), "m", t, 1.0, v, None, None, at(0, hour)) for t, v in values.items()],
        PREDICTION)


def stored_on(spark, run, on, values, hour):
    return spark.createDataFrame(
        [(run, on, "m", t, 1.0, v, None, None, at(0, hour)) for t, v in values.items()], PREDICTION)


def files_of(path):
    return {p.relative_to(path): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def held(frame):
    return {(r.prediction_run_id, str(r.as_of_date), r.ticker): r.pred_close for r in frame.collect()}


def test_upsert_of_one_run_touches_one_day(spark, tmp_path):
    path = str(tmp_path / "store")
    store = RunStore(spark, path)
    with pytest.raises(DataCheckError):
        store.rows()
    store.create(stored_on(spark, "r1", day(0), {"A": 1.0, "B": 2.0}, 1).unionByName(
        stored_on(spark, "r2", day(1), {"A": 5.0}, 2)).unionByName(
        stored_on(spark, "r3", None, {"A": 6.0}, 3)))
    before, days = files_of(path), store.days()
    assert set(days) == {str(day(0)), str(day(1)), "none"}
    incoming = stored_on(spark, "r1", day(0), {"B": 9.0, "C": 3.0}, 4).withColumn("position", F.lit(0))
    for version in (2, 3):  # a second run of the same upsert changes no row
        assert store.upsert(incoming) == version
        assert held(store.rows()) == {
            ("r1", str(day(0)), "A"): 1.0, ("r1", str(day(0)), "B"): 9.0, ("r1", str(day(0)), "C"): 3.0,
            ("r2", str(day(1)), "A"): 5.0, ("r3", "None", "A"): 6.0}
    now = store.days()
    assert {d for d in now if now[d] != days.get(d)} == {str(day(0))}
    assert before.items() <= files_of(path).items()  # no file was changed
    new = [p for p in files_of(path).keys() - before.keys() if p.parts[0] == "rows"]
    assert {p.parent.name for p in new} == {f"as_of_day={day(0)}"}
    assert held(store.rows(1))[("r1", str(day(0)), "B")] == 2.0
    runs = {r.prediction_run_id: r.row_count for r in store.runs().collect()}
    assert runs == {"r1": 3, "r2": 1, "r3": 1}
    assert store.latest_run_id() == "r1" and store.latest().count() == 3
    assert store.run("r3").count() == 1 and store.run("nothing").count() == 0


def test_a_run_that_moves_to_another_day_leaves_no_row_behind(spark, tmp_path):
    store = RunStore(spark, str(tmp_path / "store"))
    store.create(stored_on(spark, "r1", day(0), {"A": 1.0, "B": 2.0}, 1))
    store.upsert(stored_on(spark, "r1", day(5), {"A": 7.0, "B": 8.0}, 2).withColumn("position", F.lit(0)))
    assert held(store.rows()) == {("r1", str(day(5)), "A"): 7.0, ("r1", str(day(5)), "B"): 8.0}
    assert set(store.days()) == {str(day(5))}
    assert [tuple(r)[:4] for r in store.runs().collect()] == [("r1", day(5), "m", 2)]


def test_a_killed_write_leaves_the_version_before(spark, tmp_path, monkeypatch):
    store = RunStore(spark, str(tmp_path / "store"))
    store.create(stored_on(spark, "r1", day(0), {"A": 1.0}, 1))
    incoming = stored_on(spark, "r1", day(0), {"A": 2.0}, 2).withColumn("position", F.lit(0))
    with monkeypatch.context() as m:
        m.setattr(RunStore, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            store.upsert(incoming)
    assert store.versions() == [1] and held(store.rows()) == {("r1", str(day(0)), "A"): 1.0}
    store.upsert(incoming)
    with pytest.raises(DataCheckError):  # another writer of the same version
        store._publish(2, {})
    assert held(store.rows()) == {("r1", str(day(0)), "A"): 2.0}
    assert store.vacuum(keep=1) == 4 and store.versions() == [2]
    assert held(store.rows()) == {("r1", str(day(0)), "A"): 2.0}


def test_newest_rows_of_a_ticker_read_the_days_they_need(spark, tmp_path):
    rows = None
    for k in range(12):
        tickers = {"A": float(k)} | ({"B": float(k)} if k < 4 else {})
        part = stored_on(spark, f"r{k}", day(k), tickers, k)
        rows = part if rows is None else rows.unionByName(part)
    store = RunStore(spark, str(tmp_path / "store"))
    store.create(rows)

    def newest(ticker, n):
        found = store.newest_of(ticker, n)
        return found, [r.pred_close for r in V.ticker_history(found, ticker, n).collect()]
    found, values = newest("A", 2)
    assert values == [11.0, 10.0] and len(found.inputFiles()) <= 12 and found.count() == 2
    assert newest("B", 3)[1] == [3.0, 2.0, 1.0] and newest("B", 30)[1] == [3.0, 2.0, 1.0, 0.0]
    assert newest("C", 3)[1] == []


def test_later_duplicate_wins_and_created_at_is_refreshed(spark):
    target = stored(spark, "r1", {"A": 1.0}, 1)
    incoming = stored(spark, "r1", {"A": 2.0}, 1).withColumn("position", F.lit(1)).unionByName(
        stored(spark, "r1", {"A": 3.0}, 1).withColumn("position", F.lit(0)))
    row = upsert_rows(target, incoming, now=F.to_timestamp(F.lit("2030-01-01"))).collect()
    assert len(row) == 1 and row[0].pred_close == 2.0 and row[0].created_at.year == 2030


def test_checks_audit_and_gate(spark, tmp_path):
    out, audit = str(tmp_path / "out"), str(tmp_path / "audit")
    assert Q.output_complete(spark, out)[1] is False
    bars(spark, {"A": [1.0]}).createOrReplaceTempView("ticks_now")
    bars(spark, {"A": [1.0]}).limit(0).createOrReplaceTempView("ticks_none")
    checks = [Q.has_rows(spark, t) for t in ("ticks_now", "ticks_none", "ticks_absent")]
    assert [ok for _, ok, _ in checks] == [True, False, False]
    checks.append(Q.output_complete(spark, out))
    with pytest.raises(DataCheckError) as failure:
        Q.run_gate(Q.checks_frame(spark, checks), "run-1", audit)
    assert "has no rows" in str(failure.value) and "does not exist" in str(failure.value)
    files.overwrite_parquet(bars(spark, {"A": [1.0]}), out)
    Q.run_gate(Q.checks_frame(spark, [Q.output_complete(spark, out)]), "run-2", audit)
    rows = {r.run_id: r for r in spark.read.parquet(audit).collect()}
    assert rows["run-1"].n_failed == 3 and not rows["run-1"].all_ok
    assert rows["run-2"].notes == "all checks completed"


def test_audit_rows_of_two_layouts_read_as_one_table(spark, tmp_path):
    audit = str(tmp_path / "audit")
    ok = Q.checks_frame(spark, [("table a", True, ""), ("output o", True, "")])
    Q.run_gate(ok, "old", audit)
    Q.run_gate(ok, "new", audit, {"tables": "table", "kafka": "topic"},
               {"tick_count": 7, "missing_tables": ""})
    rows = {r.run_id: r for r in Q.read_audit(spark, audit).collect()}
    assert (rows["old"].tables_ok, rows["old"].tick_count, rows["old"].all_ok) == (None, None, True)
    assert (rows["new"].tables_ok, rows["new"].kafka_ok, rows["new"].tick_count) == (True, None, 7)


def test_price_file_names_and_headers(spark, tmp_path):
    from barloom.sources.prices import by_header, read_close_history
    names = ["A+B", "A B", "X%Y", "BRK%20A", "É.1"]
    for k, name in enumerate(names):
        text = f"\ufeff\n\nDate,Close\n2020-01-0{k + 1},{k}\n" if k == 2 else f"Date,Close\n2020-01-0{k + 1},{k}\n"
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "other.csv").write_text("x" * 20_000 + ",date,close\n1,2020-01-09,9\n")
    assert sorted(len(g) for g in by_header(spark, str(tmp_path))) == [1, 5]
    got = {r["symbol"]: r["close"] for r in read_close_history(spark, str(tmp_path)).collect()}
    assert got == {name: float(k) for k, name in enumerate(names)} | {"other": 9.0}


def test_missing_tables_and_tick_count(spark):
    present = spark.createDataFrame([("predictions",), ("pipeline_audit",)], "table_name string")
    missing = Q.missing_names(["predictions", "ticks", "model_registry"], present)
    state = Q.table_state(missing, bars(spark, {"A": [1.0, 2.0]})).first()
    assert (state.tables_ok, state.missing_tables, state.tick_count) == \
        (False, "model_registry,ticks", 2)


def test_stacked_forecasts_keep_missing_gate(spark):
    with_gate = spark.createDataFrame([("a", 0.5)], "model string, gate double")
    without = spark.createDataFrame([("b",)], "model string")
    assert {r.model: r.gate for r in M.stack_forecasts([with_gate, without]).collect()} == \
        {"a": 0.5, "b": None}


def test_upserts_with_the_clock_lose_no_stored_row(spark, tmp_path):
    from barloom.operators.scoring import run_id, stored_run
    rows = spark.range(10).selectExpr(
        "concat('T', id) ticker", "date'2020-01-01' as_of_date", "1.0D last_close",
        "1.1D pred_close", "0.1D pred_return", "cast(null as double) graph_gate",
        "cast(id as int) position")
    old = spark.range(40).selectExpr("concat('old_', id) run").join(rows)
    from pyspark.sql import functions as F
    store = RunStore(spark, str(tmp_path / "predictions"))
    store.create(stored_run(old, "m", F.col("run")).drop("position"))
    for k in range(4):
        store.upsert(stored_run(rows, "m", run_id(f"new{k}")))
    kept = store.rows()
    assert kept.filter("prediction_run_id LIKE 'old%'").count() == 400
    assert kept.filter("prediction_run_id LIKE 'new%'").count() == 40


def test_price_files_are_read_by_their_own_headers(spark, tmp_path):
    from barloom.sources.prices import read_close_history, read_price_csv
    (tmp_path / "A.csv").write_text("Date,Open,High,Low,Close,Volume\n2020-01-01,1,2,0.5,1.5,10\n")
    (tmp_path / "B.csv").write_text("datetime,Close,Volume\n2020-01-01,7,70\n2020-01-02,8,80\n")
    (tmp_path / "C.csv").write_text("Date,Volume,Close,Low,High,Open\n2020-01-01,777,5,4.5,6,5.5\n")
    (tmp_path / "D.csv").write_text("")
    got = {(r["symbol"], str(r["date"])): (r["open"], r["high"], r["low"], r["close"], r["volume"])
           for r in read_price_csv(spark, str(tmp_path)).collect()}
    assert got == {("A", "2020-01-01"): (1, 2, 0.5, 1.5, 10),
                   ("B", "2020-01-01"): (7, 7, 7, 7, 70), ("B", "2020-01-02"): (8, 8, 8, 8, 80),
                   ("C", "2020-01-01"): (5.5, 6, 4.5, 5, 777)}
    closes = read_close_history(spark, str(tmp_path)).collect()
    assert sorted((r["symbol"], r["close"]) for r in closes) == [
        ("A", 1.5), ("B", 7), ("B", 8), ("C", 5)]
