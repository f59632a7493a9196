"""Technical features per ticker, ordered by day.

The input holds one row per ticker and day (see ``clean_raw_prices``), so the
longest series a window task can meet is bounded by the calendar: about 36,500
rows for a century of daily bars, however many raw copies a ticker had. All
windows below share one shuffle on ticker and one sort. Bars shorter than a day are
bounded likewise: one-minute bars of a century of six-hour sessions are 9 million
rows of a ticker, sorted outside memory and passed through the windows as a stream. ``slices`` cuts longer ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marketbars.functions.columns import (
    calendar_parts,
    gain,
    loss,
    relative_change,
    relative_strength,
)


# What the windows of a series are computed within.
BY = ("ticker",)


def series(by: Sequence[str] = BY) -> WindowSpec:
    """A ticker's bars in day order."""
    return Window.partitionBy(*by).orderBy("trade_date")


def trailing(rows: int, by: Sequence[str] = BY) -> WindowSpec:
    """The current row and the ``rows - 1`` rows before it; shorter at the start."""
    return series(by).rowsBetween(1 - rows, Window.currentRow)


def with_price_change(df: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Add the previous close and the change since then (both null on the first row)."""
    return df.withColumn("previous_close", F.lag("close").over(series(by))).withColumn(
        "price_change", F.col("close") - F.col("previous_close")
    )


def daily_return() -> Column:
    return relative_change(F.col("close"), F.col("previous_close")).alias("daily_return")


def average_moves(window: int, by: Sequence[str] = BY) -> list[Column]:
    """Plain means of gains and losses over ``window`` rows.

    The first row counts as neither gain nor loss but does count as a row.
    """
    change = F.col("price_change")
    return [
        F.avg(gain(change)).over(trailing(window, by)).alias("avg_gain"),
        F.avg(loss(change)).over(trailing(window, by)).alias("avg_loss"),
    ]


def rsi(window: int) -> Column:
    """RSI from ``average_moves`` of the same window."""
    return relative_strength(F.col("avg_gain"), F.col("avg_loss")).alias(f"rsi_{window}")


def moving_averages(windows: Sequence[int], by: Sequence[str] = BY) -> list[Column]:
    return [F.avg("close").over(trailing(rows, by)).alias(f"ma_{rows}") for rows in windows]


def lags(days: Sequence[int], by: Sequence[str] = BY) -> list[Column]:
    return [F.lag("close", k).over(series(by)).alias(f"lag_{k}") for k in days]


def target_close(by: Sequence[str] = BY) -> Column:
    """Close of the ticker's next bar: the value to predict."""
    return F.lead("close").over(series(by)).alias("target_close")


def look_back(ma_windows: Sequence[int], lag_days: Sequence[int], rsi_window: int) -> int:
    """How many rows before a row its features depend on.

    The RSI's changes reach one row further back than its window.
    """
    return max([0, rsi_window, *(rows - 1 for rows in ma_windows), *lag_days])


def add_technical_features(
    df: DataFrame, ma_windows: Sequence[int], lag_days: Sequence[int], rsi_window: int
) -> DataFrame:
    """Clean bars to feature rows; each ticker's last bar has no target and goes."""
    return feature_windows(df, ma_windows, lag_days, rsi_window, BY)


def feature_windows(
    df: DataFrame,
    ma_windows: Sequence[int],
    lag_days: Sequence[int],
    rsi_window: int,
    by: Sequence[str],
) -> DataFrame:
    """Feature rows within ``by``; the last row of each has no target and goes.

    Every window column comes from one select, so they are computed in one pass.
    """
    indicators = [*moving_averages(ma_windows, by), *lags(lag_days, by), target_close(by)]
    windowed = with_price_change(df, by).select(
        "*", *average_moves(rsi_window, by), *indicators
    )
    return windowed.filter(F.col("target_close").isNotNull()).select(
        *df.columns,
        daily_return(),
        rsi(rsi_window),
        *calendar_parts(F.col("trade_date")),
        *(f"ma_{rows}" for rows in ma_windows),
        *(f"lag_{k}" for k in lag_days),
        "target_close",
    )


def in_series_order(df: DataFrame) -> DataFrame:
    """Global order by ticker and day, for output that is read as a sequence."""
    return df.orderBy("ticker", "trade_date")
