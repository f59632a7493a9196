"""Bars derived from the given tables, as Spark frames and as SQL.

Prices are order and line totals; what matters is the shape: many raw copies of
few series (orders), many long series (lineitem), many short ones (customers),
and ticks (events).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.operators.clean import clean_raw_prices
from marketbars.operators.dataset import split_series, test_rows
from marketbars.operators.features import add_technical_features
from marketbars.schema import training_columns
from marketbars.sources.bars import bars_from_ticks

MA_WINDOWS, LAG_DAYS, RSI_WINDOW = (10, 20), (1, 2, 3), 14
TRAIN_RATIO = 0.8
RUN_TIMESTAMP = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _seconds_after(day: str, count: str):
    """``day`` plus ``count`` seconds."""
    return F.col(day) + F.make_dt_interval(secs=F.col(count).cast("decimal(18,6)"))


def order_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three series, one per order status, with very many copies per day."""
    price = F.col("o_totalprice")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return table(spark, sf_dir, "orders").select(
        F.lower("o_orderstatus").alias("ticker"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("trade_date"),
        (price * 0.99).alias("open"),
        (price * 1.02).alias("high"),
        (price * 0.97).alias("low"),
        F.when(price >= 6000, price).alias("close"),
        (price * 0.98).alias("adj_close"),
        F.col("o_custkey").cast("double").alias("volume"),
        F.when(urgent, 0.5).otherwise(0.0).alias("dividends"),
        F.lit(0.0).alias("stock_splits"),
        _seconds_after("o_orderdate", "o_orderkey").alias("ingestion_timestamp"),
        F.lit("orders").alias("source_system"),
    )


ORDER_BARS_SQL = """
select lower(o_orderstatus) as ticker, strftime(o_orderdate, '%Y-%m-%d') as trade_date,
  o_totalprice * 0.99::double as open, o_totalprice * 1.02::double as high,
  o_totalprice * 0.97::double as low,
  case when o_totalprice >= 6000 then o_totalprice end as close,
  o_totalprice * 0.98::double as adj_close, cast(o_custkey as double) as volume,
  case when o_orderpriority = '1-URGENT' then 0.5::double else 0.0::double end as dividends,
  0.0::double as stock_splits,
  o_orderdate + to_seconds(o_orderkey) as ingestion_timestamp,
  'orders' as source_system
from orders"""


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series per supplier from its shipped lines, with copies on busy days."""
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    unpriced = (F.col("l_returnflag") == "R") & (F.col("l_tax") == 0)
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("ticker"),
        F.col("l_shipdate").alias("trade_date"),
        (price * 0.99).alias("open"),
        (price * (1 + F.col("l_tax"))).alias("high"),
        (price * (1 - discount)).alias("low"),
        F.when(~unpriced, price).alias("close"),
        (price * 0.98).alias("adj_close"),
        F.col("l_quantity").cast("double").alias("volume"),
        F.col("l_tax").alias("dividends"),
        F.lit(0.0).alias("stock_splits"),
        _seconds_after("l_shipdate", "l_orderkey").alias("ingestion_timestamp"),
        F.lit("lineitem").alias("source_system"),
    )


SUPPLIER_BARS_SQL = """
select 's' || cast(l_suppkey as varchar) as ticker,
  l_shipdate as trade_date,
  l_extendedprice * 0.99::double as open, l_extendedprice * (1 + l_tax) as high,
  l_extendedprice * (1 - l_discount) as low,
  case when not (l_returnflag = 'R' and l_tax = 0) then l_extendedprice end as close,
  l_extendedprice * 0.98::double as adj_close, cast(l_quantity as double) as volume,
  l_tax as dividends, 0.0::double as stock_splits,
  l_shipdate + to_seconds(l_orderkey) as ingestion_timestamp,
  'lineitem' as source_system
from lineitem"""


def event_bars(
    spark: SparkSession,
    sf_dir: str,
    interval: str = "1d",
    sequence: str | None = "event_id",
) -> DataFrame:
    """Bars of event values per event type, built from single events."""
    return bars_from_ticks(
        table(spark, sf_dir, "events"),
        interval,
        ticker="event_type",
        price="value",
        sequence=sequence,
        source_system="events",
    )


def event_bars_sql(start: str, trade_date: str, tie: str = "event_id") -> str:
    """``start`` groups events into bars; ``trade_date`` shows that start."""
    return f"""
select {trade_date} as trade_date, ticker, open, high, low, close, close as adj_close,
  volume, 0.0::double as dividends, 0.0::double as stock_splits, ingestion_timestamp,
  'events' as source_system
from (
  select event_type as ticker, {start} as bar_start,
    arg_min(value, {{o}}) as open, max(value) as high, min(value) as low,
    arg_max(value, {{o}}) as close, cast(count(*) as double) as volume,
    max(ts) as ingestion_timestamp
  from events group by event_type, {start})""".replace(
        "{o}", f"{{'ts': ts, 'tie': {tie}}}"
    )


def customer_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One short series per customer; tickers look like numbers."""
    ticks = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("ticker"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_totalprice").alias("price"),
        "o_orderkey",
    )
    return bars_from_ticks(ticks, sequence="o_orderkey", source_system="orders")


CUSTOMER_BARS_SQL = """
select cast(o_orderdate as date) as trade_date, cast(o_custkey as varchar) as ticker,
  arg_min(o_totalprice, o_orderkey) as open, max(o_totalprice) as high,
  min(o_totalprice) as low, arg_max(o_totalprice, o_orderkey) as close,
  arg_max(o_totalprice, o_orderkey) as adj_close, cast(count(*) as double) as volume,
  0.0::double as dividends, 0.0::double as stock_splits,
  max(o_orderdate) as ingestion_timestamp, 'orders' as source_system
from orders group by o_custkey, cast(o_orderdate as date)"""


def clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_raw_prices(order_bars(spark, sf_dir))


def clean_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_raw_prices(supplier_bars(spark, sf_dir))


def with_features(clean: DataFrame) -> DataFrame:
    return add_technical_features(clean, MA_WINDOWS, LAG_DAYS, RSI_WINDOW)


def supplier_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_features(clean_suppliers(spark, sf_dir))


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_features(clean_raw_prices(customer_bars(spark, sf_dir)))


def clean_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_raw_prices(event_bars(spark, sf_dir, "1h"), intraday=True)


def hourly_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_features(clean_hourly(spark, sf_dir))


def supplier_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = training_columns(MA_WINDOWS, LAG_DAYS, RSI_WINDOW)
    features = supplier_features(spark, sf_dir)
    return split_series(features, columns, "target_close", TRAIN_RATIO)


def standin_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions no model is needed for: today's close and two averages of closes.

    One row per test row and stand-in, so serving and scoring have SQL answers.
    """
    return (
        test_rows(supplier_training(spark, sf_dir))
        .select(
            "ticker",
            "trade_date",
            F.col("target_close").alias("actual_close"),
            F.col("close").alias("naive"),
            F.col("ma_10").alias("mean_10"),
            F.col("ma_20").alias("mean_20"),
        )
        .unpivot(
            ["ticker", "trade_date", "actual_close"],
            ["naive", "mean_10", "mean_20"],
            "model_name",
            "prediction",
        )
        .select(
            "ticker",
            "trade_date",
            "prediction",
            "actual_close",
            "model_name",
            F.lit(RUN_TIMESTAMP).cast("timestamp").alias("predicted_at"),
        )
    )


def naive_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standin_predictions(spark, sf_dir).filter(F.col("model_name") == "naive")
