"""Streams give what batch gives, in any file order and after replays."""

import datetime as dt

import pytest

from barloom.operators import ticks as K
from barloom.operators.bars import merge_ticks
from barloom.sources import messages
from barloom.streaming import ticks as S
from tests.panels import bars

FILES = 4


def write_messages(spark, path, seed=0):
    rows = []
    for k in range(200):
        symbol = "ABC"[k % 3]
        body = f'{{"symbol": "{symbol}", "price": {k}.5}}' if k % 7 else "junk"
        stamp = dt.datetime(2024, 1, 1) + dt.timedelta(hours=(k * 37) % 200)
        rows.append((b"k", body.encode(), "stock-price", k % 4, k, stamp))
    df = spark.createDataFrame(rows, messages.MESSAGE_SCHEMA)
    # Several files, so that a stream takes several batches, in no time order.
    df.repartition(FILES, "partition").write.parquet(path)


@pytest.fixture
def source(spark, tmp_path):
    path = str(tmp_path / "messages")
    write_messages(spark, path)
    return path


def parsed_stream(spark, source):
    return K.parse_ticks(messages.stream_message_files(spark, source, files_per_batch=1))


def parsed_batch(spark, source):
    return K.parse_ticks(messages.read_message_files(spark, source))


def rows(df):
    return sorted(map(repr, df.select(*K.TICK_COLUMNS).collect()))


def finish(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def test_append_equals_batch_and_resumes(spark, source, tmp_path):
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    for _ in range(2):  # the second start finds nothing new
        finish(S.start_append(parsed_stream(spark, source), out, progress, once=True))
        assert rows(spark.read.parquet(out)) == rows(parsed_batch(spark, source))


def test_batch_folders_survive_replay(spark, source, tmp_path):
    out = str(tmp_path / "out")
    sink = S.batch_folder_sink(out)
    for attempt in range(2):  # fresh progress replays every batch id
        finish(S.start_batches(parsed_stream(spark, source), sink,
                               str(tmp_path / f"progress{attempt}"), once=True))
        assert rows(spark.read.parquet(out)) == rows(parsed_batch(spark, source))
    assert "ingested_at" in spark.read.parquet(out).columns


def test_empty_batch_is_skipped(spark, source, tmp_path):
    out = tmp_path / "out"
    S.batch_folder_sink(str(out))(parsed_batch(spark, source).limit(0), 0)
    assert not out.exists()


def test_new_messages_by_offset(spark, source):
    ticks = parsed_batch(spark, source)
    stored = ticks.filter("kafka_offset < 100")
    assert rows(S.new_messages(ticks, stored)) == rows(ticks.filter("kafka_offset >= 100"))


def test_latest_state_and_bars_equal_batch(spark, source, tmp_path):
    state = str(tmp_path / "state")
    finish(S.start_batches(parsed_stream(spark, source), S.latest_state_sink(state),
                           str(tmp_path / "progress"), once=True))
    got, want = S.read_state(spark, state), K.latest_ticks(parsed_batch(spark, source))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    base = bars(spark, {s: [1.0, 2.0] for s in "ABC"}, {"A": [0, 30], "B": [0, 1], "C": [0, 5]})
    assert sorted(map(repr, S.current_bars(base, got).collect())) == \
        sorted(map(repr, merge_ticks(base, want).collect()))


def test_replayed_state_batch_is_the_same(spark, source, tmp_path):
    state = str(tmp_path / "state")
    sink = S.latest_state_sink(state)
    ticks = parsed_batch(spark, source)
    sink(ticks.filter("kafka_offset < 120"), 0)
    for _ in range(2):
        sink(ticks.filter("kafka_offset >= 120"), 1)
    assert sorted(map(repr, S.read_state(spark, state).collect())) == \
        sorted(map(repr, K.latest_ticks(ticks).collect()))


def test_console_sink_runs(spark, source, tmp_path):
    query = S.start_console(parsed_stream(spark, source), str(tmp_path / "progress"), rows=1)
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None


def test_topic_start_options():
    assert messages.topic_options("h:1", "t", "latest")["startingOffsets"] == "latest"
