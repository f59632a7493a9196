"""Typed, de-duplicated bars: one row per ticker and day, or per ticker and bar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars.functions.columns import as_bar_time, as_date, as_double, as_timestamp
from marketbars.schema import CLEAN_BAR, CLEAN_INTRADAY_BAR, KEY_COLUMNS, PRICE_COLUMNS


def clean_projection(df: DataFrame, intraday: bool = False) -> DataFrame:
    """Cast raw bars of any source typing to the clean schema, row by row.

    Bars shorter than a day keep their start as ``trade_date``; others their day.
    """
    as_key = as_bar_time if intraday else as_date
    dtype = {field.name: field.dataType for field in df.schema}
    return df.select(
        as_key(F.col("trade_date"), dtype["trade_date"]).alias("trade_date"),
        F.upper("ticker").alias("ticker"),
        *(as_double(F.col(name)).alias(name) for name in PRICE_COLUMNS),
        as_timestamp(
            F.col("ingestion_timestamp"), dtype["ingestion_timestamp"]
        ).alias("ingestion_timestamp"),
        F.col("source_system"),
    )


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Keep bars that have both a date and a close."""
    return df.filter(F.col("trade_date").isNotNull() & F.col("close").isNotNull())


def dedup_bars(df: DataFrame) -> DataFrame:
    """Keep the latest ingested row per ticker and day.

    The largest ``(ingestion_timestamp, other columns)`` struct wins, so ties and
    missing timestamps also give one fixed answer. Copies shrink on the map side,
    and the shuffle is on ticker *and* day: a ticker or a day with very many
    copies never meets in one task.
    """
    rest = [name for name in df.columns if name not in KEY_COLUMNS]
    ranking = sorted(rest, key=lambda name: name != "ingestion_timestamp")
    latest = df.groupBy(*KEY_COLUMNS).agg(F.max(F.struct(*ranking)).alias("bar"))
    return latest.select(
        *(F.col(name) if name in KEY_COLUMNS else F.col(f"bar.{name}").alias(name)
          for name in df.columns)
    )


def clean_raw_prices(df: DataFrame, intraday: bool = False) -> DataFrame:
    """Raw bars to clean bars.

    Incomplete rows go before de-duplication, so a row without a close never
    displaces a valid one of the same day. Order is left to the caller.
    """
    schema = CLEAN_INTRADAY_BAR if intraday else CLEAN_BAR
    return dedup_bars(drop_incomplete(clean_projection(df, intraday))).to(schema)
