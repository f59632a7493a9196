"""Lookups and report series over stored features and predictions."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars.functions.columns import iso_date, nan_as_null

DEFAULT_LIMIT = 200
MAX_LIMIT = 2000


def for_ticker(df: DataFrame, ticker: str) -> DataFrame:
    """Rows of one ticker, whatever case the caller typed it in."""
    return df.filter(F.col("ticker") == ticker.upper())


def latest_prediction(predictions: DataFrame, ticker: str | None = None) -> DataFrame:
    """Newest prediction of one ticker, or of every ticker."""
    rows = for_ticker(predictions, ticker) if ticker else predictions
    day = predictions.schema["trade_date"].dataType
    newest = F.max(
        F.struct("trade_date", "predicted_at", "model_name", "prediction", "actual_close")
    )
    return (
        rows.groupBy("ticker")
        .agg(newest.alias("last"))
        .select(
            "ticker",
            iso_date(F.col("last.trade_date"), day).alias("trade_date"),
            F.col("last.model_name").alias("model_name"),
            F.col("last.prediction").alias("predicted_close"),
            nan_as_null(F.col("last.actual_close")).alias("actual_close"),
            F.col("last.predicted_at").alias("predicted_at"),
        )
    )


def lookup_latest_prediction(predictions: DataFrame, ticker: str) -> dict[str, Any]:
    """The newest prediction as a record; ``KeyError`` when the ticker has none."""
    found = latest_prediction(predictions, ticker).take(1)
    if not found:
        raise KeyError(f"no predictions for ticker {ticker}")
    return found[0].asDict()


def market_data(
    features: DataFrame,
    ticker: str | None = None,
    limit: int = DEFAULT_LIMIT,
    indicators: Sequence[str] = ("ma_10", "ma_20", "rsi_14"),
    max_limit: int = MAX_LIMIT,
) -> DataFrame:
    """The last ``limit`` rows in ticker and day order, of one ticker or of all.

    The limit is what is asked for here, and it is bounded, so a top-k per task
    replaces the global sort.
    """
    if not 0 <= limit <= max_limit:
        raise ValueError(f"limit must be between 0 and {max_limit}, not {limit}")
    day = features.schema["trade_date"].dataType
    rows = for_ticker(features, ticker) if ticker else features
    return (
        rows.select("ticker", "trade_date", "close", *indicators)
        .orderBy(F.desc("ticker"), F.desc("trade_date"))
        .limit(limit)
        .orderBy("ticker", "trade_date")
        .withColumn("trade_date", iso_date(F.col("trade_date"), day))
    )


def actual_vs_predicted(predictions: DataFrame, ticker: str) -> DataFrame:
    """Both price lines of one ticker in long form, one row per day and line."""
    return (
        predictions.filter(F.col("ticker") == ticker)
        .select(
            "ticker",
            "trade_date",
            F.col("actual_close").alias("Actual Close"),
            F.col("prediction").alias("Predicted Close"),
        )
        .unpivot(
            ["ticker", "trade_date"], ["Actual Close", "Predicted Close"], "series", "price"
        )
    )


def multistock_lookback(features: DataFrame, lookback_days: int) -> DataFrame:
    """Closes of all tickers from ``lookback_days`` before the newest day on.

    The newest day is a scalar subquery: one value, known before the scan starts.
    """
    newest = features.select(F.max("trade_date")).scalar()
    return features.filter(
        F.col("trade_date") >= F.date_sub(newest.cast("date"), lookback_days)
    ).select("ticker", "trade_date", "close")


def available_tickers(df: DataFrame) -> DataFrame:
    return df.select("ticker").distinct().orderBy("ticker")


def default_ticker(df: DataFrame) -> DataFrame:
    """First ticker in sort order: the one a report opens with."""
    return df.agg(F.min("ticker").alias("ticker"))


def rmse(predictions: DataFrame, *by: str) -> DataFrame:
    """Root mean squared error of predictions, overall or per group."""
    squared = F.pow(F.col("prediction") - F.col("actual_close"), F.lit(2.0))
    return predictions.groupBy(*by).agg(F.sqrt(F.avg(squared)).alias("rmse"))


def leaderboard(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("rmse")


def date_summary(df: DataFrame) -> DataFrame:
    """Row count with first and last day: the record a job reports."""
    return df.agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min("trade_date").alias("min_trade_date"),
        F.max("trade_date").alias("max_trade_date"),
    )
