"""A hot ticker or a hot day holding a large share of all rows changes nothing."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from marketbars.checks import inputs
from marketbars.operators.clean import clean_raw_prices
from marketbars.sources.bars import bars_from_ticks, conform_raw, read_bars
from marketbars.sources.sinks import write_raw


@pytest.fixture(scope="module")
def hot_bars(spark, sf_dir):
    """Supplier bars plus as many rows again of one ticker, half of them on one day."""
    raw = inputs.supplier_bars(spark, sf_dir)
    hot_day = F.when(F.col("volume") > 25, F.lit("1999-09-09").cast("timestamp_ntz"))
    extra = raw.withColumn("ticker", F.lit("hot")).withColumn(
        "trade_date", F.coalesce(hot_day, "trade_date")
    )
    return raw.unionByName(extra)


def test_clean_keeps_exactly_the_largest_row_of_every_key(spark, hot_bars):
    pdf = hot_bars.filter(F.col("close").isNotNull()).toPandas()
    order = ["ingestion_timestamp", "open", "high", "low", "close", "adj_close", "volume",
             "dividends", "stock_splits", "source_system"]
    pdf["ticker"] = pdf["ticker"].str.upper()
    pdf["trade_date"] = pdf["trade_date"].dt.date
    wanted = pdf.sort_values(order).groupby(["ticker", "trade_date"]).tail(1)
    got = clean_raw_prices(hot_bars).toPandas()
    key = ["ticker", "trade_date"]
    columns = [*key, "close", "high", "volume"]
    left = got.sort_values(key)[columns].reset_index(drop=True)
    right = wanted.sort_values(key)[columns].reset_index(drop=True)
    assert left.equals(right)
    assert (left.ticker == "HOT").sum() > 0


def test_map_side_combine_shrinks_a_hot_day_before_the_shuffle(spark, hot_bars):
    """Rows that leave the map side are at most one per key and input partition."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        cleaned = clean_raw_prices(hot_bars.coalesce(4))
        keys = len(cleaned.collect())
        node, written = cleaned._jdf.queryExecution().executedPlan(), []
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    while True:
        if node.metrics().contains("shuffleRecordsWritten"):
            written.append(node.metrics().apply("shuffleRecordsWritten").value())
        if node.children().size() != 1:
            break
        node = node.children().apply(0)
    assert len(written) == 1
    assert keys <= written[0] <= 4 * keys
    assert written[0] < 0.8 * hot_bars.filter("close IS NOT NULL").count()


def test_raw_write_splits_a_hot_ticker_over_tasks(spark, hot_bars, tmp_path):
    raw = conform_raw(hot_bars.repartition(8))  # splits run along map outputs
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        write_raw(raw, str(tmp_path / "raw"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "raw" / "ticker=hot").glob("*.parquet"))) > 1
    assert read_bars(spark, str(tmp_path / "raw")).exceptAll(raw).isEmpty()


def test_ticks_of_one_hot_type(spark, sf_dir):
    ticks = (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .withColumn("event_type", F.lit("hot"))
        .withColumn("ts", F.date_trunc("minute", "ts").cast("timestamp_ntz"))
    )
    bars = bars_from_ticks(ticks, ticker="event_type", price="value", sequence="event_id")
    got = {r.trade_date: (r.open, r.high, r.low, r.close, r.volume) for r in bars.collect()}
    rows = duckdb.sql(f"""
        select cast(ts as date), arg_min(value, o), max(value), min(value), arg_max(value, o),
          cast(count(*) as double)
        from (select value, ts, {{'t': date_trunc('minute', ts), 'i': event_id}} as o
          from '{sf_dir}/events.parquet') group by 1""").fetchall()
    assert got == {r[0]: tuple(r[1:]) for r in rows}
