"""Scalar expressions. Bad input becomes null, never an error, also in ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_date(column: Column, dtype: T.DataType) -> Column:
    """Calendar date of a string, date or timestamp; unreadable strings give null."""
    if isinstance(dtype, T.StringType):
        return F.try_to_date(column)
    return F.to_date(column)


def as_bar_time(column: Column, dtype: T.DataType) -> Column:
    """Start of a bar within its day, as it reads where the session is; no zone."""
    if isinstance(dtype, T.StringType):
        column = F.try_to_timestamp(column)
    return column.cast("timestamp_ntz")


def as_timestamp(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(column)
    return column.cast("timestamp")


def as_double(column: Column) -> Column:
    """Double value; unreadable text and NaN give null."""
    value = column.try_cast("double")
    return F.when(~F.isnan(value), value)


def relative_change(value: Column, base: Column) -> Column:
    """``(value - base) / base``; null without a base or with a zero base."""
    return F.try_divide(value - base, base)


def gain(change: Column) -> Column:
    """Upward part of a change; zero when there is none or nothing to compare."""
    return F.when(change > 0, change).otherwise(F.lit(0.0))


def loss(change: Column) -> Column:
    """Downward part of a change as a positive number; zero otherwise."""
    return F.when(change < 0, -change).otherwise(F.lit(0.0))


def relative_strength(average_gain: Column, average_loss: Column) -> Column:
    """Relative strength index on 0..100; 100 when there was no loss at all."""
    strength = average_gain / average_loss
    return F.when(average_loss == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + strength))


def calendar_parts(day: Column) -> list[Column]:
    """Day of week with Sunday as 1, month of year, and year."""
    return [
        F.dayofweek(day).alias("day_of_week"),
        F.month(day).alias("month_of_year"),
        F.year(day).alias("year"),
    ]


def nan_as_null(column: Column) -> Column:
    return F.when(~F.isnan(column), column)


def iso_date(column: Column, dtype: T.DataType | None = None) -> Column:
    """Text of a date; of a time of day as well where the type has one."""
    daily = dtype is None or isinstance(dtype, T.DateType)
    return F.date_format(column, "yyyy-MM-dd" if daily else "yyyy-MM-dd HH:mm:ss")
