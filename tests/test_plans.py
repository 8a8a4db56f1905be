"""Shape of the physical plans: pruning, pushdown, partial work, no cross products."""

import re

import pytest

from barloom.config import GraphConfig
from barloom.operators import features as X
from barloom.operators import graph as G
from barloom.operators import serving as V
from barloom.operators import ticks as K
from barloom.operators.bars import merge_ticks
from barloom.operators.pairs import pair_statistics
from barloom.operators.samples import StepPlan, build_samples
from barloom.plans import inputs
from barloom.session import stage
from barloom.sinks.run_store import RunStore
from tests.panels import correlated, panel

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored_runs(spark, tmp_path_factory):
    store = RunStore(spark, str(tmp_path_factory.mktemp("runs") / "t"))
    store.create(inputs.predictions(spark, "/root/testdata/sf0.01"))
    return store


def test_latest_run_reads_the_directory_only(spark, stored_runs):
    text = plan(V.latest_run(stored_runs.runs().withColumnRenamed("last_created_at", "created_at")))
    assert re.search(r"ReadSchema: struct<prediction_run_id:string,last_created_at:timestamp,as_of_day:string>", text)
    assert "TakeOrderedAndProject" in text and "pred_close" not in text


def test_one_run_prunes_days_and_pushes_its_filter(spark, stored_runs):
    df = stored_runs.run("run_19990331")
    text = plan(df)
    assert "EqualTo(prediction_run_id,run_19990331)" in text
    assert re.search(r"PartitionFilters: \[.*as_of_day#\d+.* = 1999-03-31", text)
    assert df.count() == 5
    summary = plan(V.dashboard_summary(stored_runs.latest()))
    assert re.search(r"PartitionFilters: \[.*as_of_day#\d+.* = ", summary)
    newest = stored_runs.newest_of("2-HIGH", 30)
    assert re.search(r"PartitionFilters: \[.*as_of_day#\d+.* IN", plan(newest))
    assert 30 <= newest.count() <= 60


def test_bars_fold_before_the_shuffle_and_read_what_they_need(spark):
    text = plan(inputs.bars_day(spark, SF))
    assert "partial_max" in text and text.count("Exchange hashpartitioning") == 1
    assert "o_custkey" not in text


def test_features_take_one_exchange_and_one_sort(spark):
    bars = stage(inputs.bars_day(spark, SF))
    text = plan(X.engineer_features(bars))
    assert text.count("Exchange") == 1 and len(re.findall(r"\bSort \[", text)) == 1


def test_merged_bars_keep_their_partitioning_for_the_features(spark):
    bars = stage(inputs.bars_day(spark, SF))
    newest = stage(K.latest_ticks(inputs.ticks(spark, SF)))
    text = plan(X.engineer_features(merge_ticks(bars, newest)))
    assert text.count("Exchange hashpartitioning") == 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_latest_ticks_fold_before_the_shuffle(spark):
    text = plan(K.latest_ticks(inputs.ticks(spark, SF)))
    assert "partial_max" in text and text.count("Exchange hashpartitioning") == 1


def test_top_neighbours_are_limited_before_the_shuffle(spark):
    edges = spark.createDataFrame([(1, "A", "B", 0.5)],
                                  "step int, src string, dst string, weight double")
    assert "WindowGroupLimit" in plan(G.keep_topk(edges, 2)) \
        and "Partial" in plan(G.keep_topk(edges, 2))


def test_pairs_have_no_join(spark):
    frame = stage(panel(spark, correlated(40, 4), list("ABCD")))
    pairs = pair_statistics(frame, StepPlan(35, 5, 0), 30, GraphConfig())
    text = plan(pairs)
    assert "Join" not in text and "CartesianProduct" not in text
    assert text.count("Exchange hashpartitioning") == 2


def test_samples_take_one_exchange(spark):
    frame = stage(panel(spark, correlated(40, 4), list("ABCD")))
    assert plan(build_samples(frame, 5, ["close", "ret"])).count("Exchange") == 1


def test_run_items_limit_and_header(spark, stored_runs):
    rows = stored_runs.rows()
    assert [r.ticker for r in V.run_items(rows, "run_19990331", limit=2).collect()] == \
        ["1-URGENT", "2-HIGH"]
    header = V.run_header(V.run_items(rows, "run_19990331")).first()
    assert header.row_count == 5
    with pytest.raises(ValueError):
        V.run_items(rows, "run_19990331", limit=0)


def test_messages_are_parsed_once(spark):
    from barloom.operators.ticks import parse_ticks
    messages = spark.createDataFrame(
        [(b"k", b'{"symbol": "A", "price": 1.5}', "t", 0, 1, None), (b"k", b"junk", "t", 0, 2, None),
         (b"k", None, "t", 0, 3, None)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp")
    ticks = parse_ticks(messages)
    assert [(r["symbol"], r["price"]) for r in ticks.collect()] == [("A", 1.5)]
    plan = ticks._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("from_json") + plan.count("jsontostructs") == 1


def test_steps_meet_the_panel_by_hash_or_by_running_sums(spark):
    from barloom.plans import graph_queries, panel_queries
    from barloom.plans.registry import REGISTRY
    for name in ("gr4_movement_frequencies", "jn8_step_windows", "bt8_collected_predictions",
                 "bt9_blend_candidates", "agg21_standard_fit", "bt5_joint_regression"):
        text = plan(REGISTRY[name].build(spark, "/root/testdata/sf0.01"))
        assert "NestedLoop" not in text and "CartesianProduct" not in text, name
    moments = plan(REGISTRY["agg21_standard_fit"].build(spark, "/root/testdata/sf0.01"))
    windows = moments.split("collect_list")[-1]
    assert windows.count("BroadcastHashJoin") >= 1 and graph_queries and panel_queries
