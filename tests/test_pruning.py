"""What reaches the files: spellings, bloom filters, footers and the last directories."""

from __future__ import annotations

import re

import pytest
from helpers import clean_bars, physical_plan
from pyspark.sql import functions as F

from marketbars.config import Config, Features, Stocks, Storage
from marketbars.operators.features import add_technical_features
from marketbars.plans import jobs, lookups
from marketbars.schema import PREDICTION, feature_schema
from marketbars.sources import bars, sinks

WINDOWS = ((3,), (1,), 4)


def scan_metric(df, name):
    """Sum of a metric over the scans of a plan that has run."""
    df.collect()
    found, left = 0, [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        if node.nodeName().startswith("Scan ") and node.metrics().contains(name):
            found += node.metrics().apply(name).value()
        left += [node.children().apply(k) for k in range(node.children().size())]
    return found


@pytest.fixture
def source(spark, tmp_path):
    """Bars of one file per ticker, spelled in several ways."""
    rows = clean_bars(spark, {"Aapl": [1, 2], "AAPL": [3], "aapl": [4], "MSFT": [5], "Ibm": [6]})
    path = str(tmp_path / "source")
    rows.repartition("ticker").write.parquet(path)
    return path


def test_ticker_filter_reaches_the_files_in_every_spelling(spark, source):
    config = Config(stocks=Stocks(tickers=("aapl", "IBM"), start_date=None, source_path=source))
    assert bars.spellings(spark.read.parquet(source), config.tickers) == [
        "AAPL", "Aapl", "Ibm", "aapl",
    ]
    wanted = jobs.wanted_rows(spark, config)
    assert "PushedFilters: [In(ticker, [AAPL,Aapl,Ibm,aapl])]" in physical_plan(wanted)
    got = sorted((r.ticker, r.close) for r in wanted.collect())
    assert got == [("AAPL", 1.0), ("AAPL", 2.0), ("AAPL", 3.0), ("AAPL", 4.0), ("IBM", 6.0)]


def test_too_many_spellings_are_not_pushed(spark, source):
    rows = spark.read.parquet(source)
    assert bars.spellings(rows, ["AAPL"], most=2) is None
    assert bars.spellings(rows, ["NONE"]) == []
    assert bars.bars_between(rows, None).count() == rows.count()


def test_bloom_filters_let_a_lookup_skip_files(spark, tmp_path):
    path = str(tmp_path / "predictions")
    rows = spark.range(20_000).select(
        F.concat(F.lit("T"), F.col("id") % 200).alias("ticker"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 200).cast("int")).alias("trade_date"),
        F.col("id").cast("double").alias("prediction"),
        F.col("id").cast("double").alias("actual_close"),
        F.lit("m").alias("model_name"),
        F.lit("2024-01-01").cast("timestamp").alias("predicted_at"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_predictions(rows, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = len(list((tmp_path / "predictions").glob("*.parquet")))
    assert files > 4
    stored = sinks.read_predictions(spark, path)
    one = stored.where("ticker = 'T7'").select("prediction")
    assert len(one.collect()) == 100
    # rows of a file or two, not of all
    assert scan_metric(one, "numOutputRows") <= 2 * 20_000 / files * 2
    assert scan_metric(stored.where("ticker = 'T7x'").select("prediction"), "numOutputRows") == 0


@pytest.fixture
def store(spark, tmp_path):
    config = Config(
        storage=Storage(base_path=str(tmp_path)),
        features=Features(**dict(zip(("ma_windows", "lag_days", "rsi_window"), WINDOWS))),
    )
    closes = {f"T/{k:02}": range(1, 12) for k in range(30)}
    rows = add_technical_features(clean_bars(spark, closes), *WINDOWS)
    sinks.write_features(rows, config.path("processed_parquet_path"))
    return config


def test_summary_comes_from_footers(spark, store):
    path, kind = store.path("processed_parquet_path"), feature_schema(*WINDOWS)
    summary = lookups.footer_summary(spark, path, kind)
    assert "PushedAggregation: [COUNT(*), MIN(trade_date), MAX(trade_date)]" in (
        summary._jdf.queryExecution().executedPlan().toString().replace("  ", " ")
        + summary._sc._jvm.PythonSQLUtils.explainString(summary._jdf.queryExecution(), "formatted")
    )
    row, rows = summary.first(), lookups.stored_features(spark, store)
    assert row.record_count == rows.count() == 300
    assert row.max_trade_date == rows.agg(F.max("trade_date")).first()[0]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_tail_reads_the_last_directories_only(spark, store):
    path, rows = store.path("processed_parquet_path"), lookups.stored_features(spark, store)
    assert lookups.last_tickers(spark, path, rows, 10) == ["T/29"]
    assert lookups.last_tickers(spark, path, rows, 11) == ["T/29", "T/28", "T/27"]
    assert len(lookups.last_tickers(spark, path, rows, 10**6)) == 30
    assert lookups.last_tickers(spark, path + "-none", rows, 1) is None
    tail = lookups.market_data(spark, store, limit=15)
    got = [(r.ticker, r.trade_date) for r in tail.collect()]
    full = lookups.serve.market_data(rows, None, 15, ["ma_3", "rsi_4"])
    assert got == [(r.ticker, r.trade_date) for r in full.collect()] and len(got) == 15
    assert re.search(r"PartitionFilters: \[ticker#\d+ IN \(T/29,T/28,T/27\)", physical_plan(tail))


def test_empty_predictions_have_no_rows(spark, tmp_path):
    sinks.write_predictions(spark.createDataFrame([], PREDICTION), str(tmp_path / "p"))
    assert sinks.read_predictions(spark, str(tmp_path / "p")).collect() == []
