"""Plans that must hold at scale: pruned scans, no window over a whole series, no cross join."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from leadtime.checks import fixtures as fx
from leadtime.operators import asof, evaluate as ev, faults as flt, report
from leadtime.plans.series import fill_forward, number_rows, previous_row

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def windows_over_rows(text):
    """Partition keys of every window operator in the plan."""
    return re.findall(r"windowspecdefinition\(([^)]*?) (?:ASC|DESC)", text)


@pytest.mark.parametrize("build", [
    lambda t: number_rows(t, ["entity_id"], "ts"),
    lambda t: previous_row(t, ["entity_id"], "ts", ["s_view"]),
    lambda t: fill_forward(t, ["entity_id"], "ts", ["s_view"], number="k"),
])
def test_row_windows_are_per_block(spark, build):
    """Windows partitioned by entity alone may only order the block summaries."""
    text = plan(build(fx.telemetry(spark, SF)))
    for spec in windows_over_rows(text):
        assert "_block" in spec, spec


def test_fault_context_shuffles_readings_once(spark):
    tel = fx.telemetry(spark, SF).select("entity_id", "ts", F.col("n_events").alias("marker"))
    out = asof.fault_context(tel, fx.faults(spark, SF), fx.FAMILIES, kinds=("previous", "next", "cover"))
    exchanges = [line for line in plan(out).splitlines() if "Exchange hashpartitioning" in line]
    assert sum("_block" in e for e in exchanges) <= 2  # readings with faults, and the block summary


@pytest.mark.parametrize("name", ["agg_12_class_balance", "agg_30_threshold_sweep", "jn_6_window_minimum",
                                  "agg_20_pr_curve", "win_9_clusters", "jn_5_alerts_to_events"])
def test_no_cross_join(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scan_is_pruned_and_filtered(spark):
    text = plan(fx.table(spark, SF, "orders").where("o_totalprice > 1000").select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,1000.0)]" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_small_sides_are_broadcast_by_their_size(spark):
    rows = fx.telemetry(spark, SF).select("entity_id", "ts", "s_click")
    from leadtime.operators.splits import temporal_split
    text = plan(temporal_split(rows, by=["entity_id"]))
    assert "BroadcastHashJoin" in text


def test_dedup_reduces_before_the_shuffle(spark):
    text = plan(flt.first_per_bucket(fx.status(spark, SF)))
    assert "partial_min_by" in text and "Window" not in text


def test_latest_reduces_before_the_shuffle(spark):
    text = plan(report.latest(fx.telemetry(spark, SF)))
    assert "partial_max_by" in text and "Window" not in text


def test_event_windows_need_no_nested_loops(spark):
    text = plan(ev.event_windows(fx.scored_table(spark, SF), fx.lead(), 12))
    assert "NestedLoop" not in text


def test_sample_drops_rows_before_it_ranks_them(spark):
    """The counts are combined before their shuffle; of 60,000 rows the rank sees hardly more than it keeps."""
    rows = spark.range(60_000).select(F.lit("a").alias("family"), F.col("id").alias("k"))
    picked = report.sample_rows(rows, 1500, ["k"])
    tree = plan(picked)
    assert "_prefix" in tree and picked.count() == 1500
    ranked = tree.index("row_number()")
    kept = tree.index("_last", ranked)
    assert kept > ranked  # the cut lies below the window
