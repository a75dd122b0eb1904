"""What the plans must and must not contain."""

import os

import pytest

from barlake.operators import bars as bar_ops
from barlake.plans import views
from barlake.plans.catalog import all_queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")

# These write tables or drain streams while they are built.
EAGER = ("streams", "lake", "quality", "continued")
LAZY = sorted(n for n, e in all_queries().items() if e.run.__module__.rsplit(".", 1)[-1] not in EAGER)


@pytest.fixture(autouse=True)
def production_plans(spark):
    key = "spark.sql.codegen.wholeStage"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    yield
    spark.conf.set(key, before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_row_python(spark, name):
    plan = plan_of(all_queries()[name].run(spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "FlatMapGroupsInPandas" not in plan
    assert "MapInArrow" not in plan


def test_versions_are_told_apart_in_one_pass(spark):
    """No column travels twice, and nothing is sorted by key into one task."""
    plan = plan_of(all_queries()["dedupe_bars"].run(spark, FOLDER))
    assert "Window" not in plan and "max_by" not in plan and plan.count("Exchange hashpartitioning(stock") <= 2


def test_live_state_and_decoding_need_no_python(spark):
    for name in ("live_registry_state", "ingest_trades_ndjson", "stream_store_and_log"):
        plan = plan_of(all_queries()[name].run(spark, FOLDER))
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_bars_are_hash_aggregated_before_the_shuffle(spark):
    plan = plan_of(bar_ops.ohlcv_from_trades(views.trades(spark, FOLDER), "1h"))
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1


def test_scan_reads_only_what_a_report_needs(spark):
    plan = plan_of(all_queries()["top_notional"].run(spark, FOLDER))
    schema = plan.split("ReadSchema: ")[1].split(">")[0]
    assert "l_tax" not in schema and "l_discount" not in schema and "TakeOrderedAndProject" in plan


def test_venue_filter_reaches_the_partitions(spark, folder):
    from pyspark.sql import functions as F

    from barlake.operators.lake import TRADE_PARTITIONS, read_staged, with_trade_partitions, write_partitioned

    write_partitioned(with_trade_partitions(views.trades(spark, FOLDER)), folder, TRADE_PARTITIONS, ["trade_time"])
    plan = plan_of(read_staged(spark, folder, TRADE_PARTITIONS).filter(F.col("feed_venue") == "click"))
    assert "feed_venue" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_merge_reads_only_the_touched_months(spark, folder):
    from barlake.operators.lake import prune_to, write_bars_monthly
    from barlake.sources.bars import scan_partitions
    from tests.test_fixtures import bar_rows

    rows = [("A", f"2024-{m:02d}-01", 1.0, 1) for m in range(1, 7)]
    write_bars_monthly(bar_rows(spark, rows), folder)
    touched = spark.createDataFrame([("2024", "03")], "year string, month string")
    kept = prune_to(scan_partitions(spark, folder), touched, ["year", "month"])
    scan = plan_of(kept).split("PartitionFilters: [")[1]
    assert "2024/03" in scan.split("PushedFilters")[0] and kept.count() == 1
    assert "DataFilters: []" in plan_of(kept)


def test_all_windows_of_a_normalisation_share_their_blocks(spark):
    plan = plan_of(all_queries()["volume_zscore"].run(spark, FOLDER))
    assert plan.count("Generate explode") == 1


def test_hours_with_trades_without_volume_are_reported(spark):
    if "interval_consistency_all_trades" not in all_queries():
        pytest.fail("no query reports the hours of trades without volume")
    got = {(r["isin"], r["bar"]) for r in all_queries()["interval_consistency_all_trades"].run(spark, FOLDER).collect()}
    none, some = set(), set()
    for r in views.trades(spark, FOLDER).select("isin", "trade_time", "volume").collect():
        hour = r["isin"], r["trade_time"].replace(minute=0, second=0, microsecond=0)
        minute = *hour, r["trade_time"].minute
        some |= {hour, minute} if r["volume"] else set()
        none |= set() if r["volume"] else {minute}
    due = {m[:2] for m in none if m not in some and m[:2] in some}
    assert due <= got
