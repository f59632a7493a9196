"""Shape of physical plans: shuffles, pruning, aggregation and broadcast choices."""

from __future__ import annotations

import re

import pytest
from helpers import clean_bars, physical_plan

from marketbars.checks import inputs, queries
from marketbars.operators import serve
from marketbars.operators.clean import clean_raw_prices
from marketbars.schema import CLEAN_BAR, RAW_BAR
from marketbars.sources import bars, sinks


def exchanges(df):
    return re.findall(r"Exchange (\w+\([^)]*\)|\w+)", physical_plan(df))


@pytest.fixture
def stored_bars(spark, tmp_path):
    path = str(tmp_path / "bars")
    clean_bars(spark, {"0700": range(1, 40), "AAPL": range(1, 40)}).write.partitionBy(
        "ticker"
    ).parquet(path)
    return spark.read.schema(CLEAN_BAR).parquet(path)


def test_features_of_clean_bars_need_one_shuffle_and_one_sort(stored_bars):
    plan = physical_plan(inputs.with_features(stored_bars))
    assert plan.count("Exchange ") == 1
    assert plan.count("Sort [") == 1
    assert plan.count("Window [") == 2


def test_training_rows_add_no_shuffle_to_features(stored_bars, spark, sf_dir):
    training = inputs.supplier_training(spark, sf_dir)
    assert len(exchanges(training)) == 2
    assert physical_plan(training).count("Window [") == 3


def test_dedup_combines_before_a_shuffle_on_ticker_and_day(spark, sf_dir):
    plan = physical_plan(inputs.clean_suppliers(spark, sf_dir))
    assert "partial_max" in plan
    (only,) = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    assert "ticker" in only and "trade_date" in only


def test_no_global_sort_before_windows(spark, sf_dir):
    assert "rangepartitioning" not in physical_plan(inputs.supplier_features(spark, sf_dir))


def test_bars_are_hash_aggregated_with_map_side_combine(spark, sf_dir):
    plan = physical_plan(inputs.event_bars(spark, sf_dir))
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan
    assert "partial_min_by" in plan


def test_ticker_lookup_prunes_directories(spark, stored_bars):
    plan = physical_plan(serve.market_data(inputs.with_features(stored_bars), "aapl"))
    assert re.search(r"PartitionFilters: \[[^\]]*ticker#\d+ = AAPL", plan)
    assert "TakeOrderedAndProject" in plan


def test_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    sinks.write_raw(bars.conform_raw(clean_bars(spark, {"A": [1], "B": [1]})), path)
    plan = physical_plan(bars.read_bars(spark, path, tickers=["A"], start="2024-01-01"))
    assert "GreaterThanOrEqual(trade_date" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*ticker", plan)


def test_date_filter_passes_below_dedup(spark, tmp_path):
    path = str(tmp_path / "clean")
    spark.createDataFrame([], CLEAN_BAR).write.parquet(path)
    typed = spark.read.schema(CLEAN_BAR).parquet(path)
    cleaned = bars.bars_between(clean_raw_prices(typed), start="2024-01-01")
    assert "GreaterThanOrEqual(trade_date" in physical_plan(cleaned)


def test_scan_reads_only_used_columns(spark, sf_dir):
    plan = physical_plan(queries.REGISTERED["available_tickers"](spark, sf_dir))
    assert "ReadSchema: struct<l_suppkey:bigint>" in plan


def test_bucketed_feature_table_is_windowed_without_a_shuffle(spark, sf_dir, tmp_path):
    sinks.create_database(spark, "plan_checks")
    rows = inputs.supplier_features(spark, sf_dir)
    path = str(tmp_path / "f")
    sinks.save_table(rows, "plan_checks.features", path, bucket_by=(8, "ticker"))
    table = spark.table("plan_checks.features")
    plan = physical_plan(
        queries.dataset.split_series(
            table, queries.regressors.feature_columns(queries.SMALL), "target_close", 0.8
        )
    )
    assert "Exchange " not in plan


def test_raw_write_lets_adaptive_execution_split_a_hot_ticker(spark):
    rows = spark.createDataFrame([], RAW_BAR).hint("rebalance", "ticker")
    assert "REBALANCE_PARTITIONS_BY_COL" in physical_plan(rows)


EAGER = (
    "roundtrip", "predict", "model", "best", "score", "ticker_index", "job_", "sparse_ticker",
    "features_after_changes",
)
# The table of cuts, which MOST_SLICES bounds, and a row for each partition.
SENT = {name for name in queries.REGISTERED if "_sliced" in name} | {"ordered_features_places"}
LAZY = sorted(name for name in queries.REGISTERED if not name.startswith(EAGER))
UNWANTED = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "BatchEvalPython",
    "ArrowEvalPython",
    "BroadcastExchange",
)


@pytest.mark.parametrize("name", sorted({*LAZY} - {"missing_tickers"} - SENT))
def test_no_cross_join_no_python_and_no_broadcast(name, spark, sf_dir):
    plan = physical_plan(queries.REGISTERED[name](spark, sf_dir))
    assert not [word for word in UNWANTED if word in plan]


@pytest.mark.parametrize("name", sorted(SENT))
def test_what_is_sent_has_a_bound_and_nothing_else_is(name, spark, sf_dir):
    plan = physical_plan(queries.REGISTERED[name](spark, sf_dir))
    assert plan.count("BroadcastExchange") == 1
    assert not [word for word in UNWANTED[:-1] if word in plan]


def test_the_one_broadcast_is_of_requested_tickers(spark, sf_dir):
    plan = physical_plan(queries.REGISTERED["missing_tickers"](spark, sf_dir))
    _, broadcast = plan.split("BroadcastExchange")
    assert "IN (F,O,P,X)" in broadcast


def test_feature_write_adds_no_shuffle(spark, sf_dir, tmp_path):
    context = spark.sparkContext
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    context.setJobGroup("feature-write", "one job of three stages")
    try:
        sinks.write_features(inputs.supplier_features(spark, sf_dir), str(tmp_path / "f"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        context.setLocalProperty("spark.jobGroup.id", None)
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("feature-write")]
    # raw bars to dedup, dedup to windows, windows to files
    assert max(len(job.stageIds) for job in jobs) == 3
