"""Column names and Spark types of the tables that jobs exchange."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

KEY_COLUMNS = ("ticker", "trade_date")
PRICE_COLUMNS = (
    "open",
    "high",
    "low",
    "close",
    "adj_close",
    "volume",
    "dividends",
    "stock_splits",
)
PROVENANCE_COLUMNS = ("ingestion_timestamp", "source_system")
CALENDAR_COLUMNS = ("day_of_week", "month_of_year", "year")


def _bar_schema(trade_date_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("trade_date", trade_date_type),
            T.StructField("ticker", T.StringType()),
            *(T.StructField(name, T.DoubleType()) for name in PRICE_COLUMNS),
            T.StructField("ingestion_timestamp", T.TimestampType()),
            T.StructField("source_system", T.StringType()),
        ]
    )


def bar_time(intraday: bool) -> T.DataType:
    """Type of ``trade_date``: a day, or the start of a bar within one."""
    return T.TimestampNTZType() if intraday else T.DateType()


# Raw bars keep the time of day of the source; the clean step reduces it to a date
# unless the bars are shorter than a day.
RAW_BAR = _bar_schema(T.TimestampNTZType())
CLEAN_BAR = _bar_schema(bar_time(intraday=False))
CLEAN_INTRADAY_BAR = _bar_schema(bar_time(intraday=True))


def prediction_schema(intraday: bool = False) -> T.StructType:
    return T.StructType(
        [
            T.StructField("ticker", T.StringType()),
            T.StructField("trade_date", bar_time(intraday)),
            T.StructField("prediction", T.DoubleType()),
            T.StructField("actual_close", T.DoubleType()),
            T.StructField("model_name", T.StringType()),
            T.StructField("predicted_at", T.TimestampType()),
        ]
    )


PREDICTION = prediction_schema()

METRICS = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("rmse", T.DoubleType()),
    ]
)


def feature_schema(
    ma_windows: Sequence[int],
    lag_days: Sequence[int],
    rsi_window: int,
    intraday: bool = False,
) -> T.StructType:
    """Schema of the feature table; indicator names follow the configured windows."""
    return T.StructType(
        [
            *_bar_schema(bar_time(intraday)).fields,
            T.StructField("daily_return", T.DoubleType()),
            T.StructField(f"rsi_{rsi_window}", T.DoubleType()),
            *(T.StructField(name, T.IntegerType()) for name in CALENDAR_COLUMNS),
            *(T.StructField(f"ma_{w}", T.DoubleType()) for w in ma_windows),
            *(T.StructField(f"lag_{k}", T.DoubleType()) for k in lag_days),
            T.StructField("target_close", T.DoubleType()),
        ]
    )


def training_columns(
    ma_windows: Sequence[int], lag_days: Sequence[int], rsi_window: int
) -> list[str]:
    """Model inputs in assembly order: bar columns, calendar, then indicators."""
    return [
        *PRICE_COLUMNS,
        "daily_return",
        *CALENDAR_COLUMNS,
        *(f"ma_{w}" for w in ma_windows),
        *(f"lag_{k}" for k in lag_days),
        f"rsi_{rsi_window}",
    ]
