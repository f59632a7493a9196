"""Lookups over what the jobs stored."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.config import Config
from marketbars.operators import serve
from marketbars.schema import feature_schema
from marketbars.sources import sinks
from marketbars.sources.bars import is_intraday
from marketbars.workspace import children


def stored_features(spark: SparkSession, config: Config) -> DataFrame:
    features = config.features
    schema = feature_schema(
        features.ma_windows,
        features.lag_days,
        features.rsi_window,
        is_intraday(config.stocks.interval),
    )
    return sinks.read_features(spark, config.path("processed_parquet_path"), schema)


def stored_predictions(spark: SparkSession, config: Config) -> DataFrame:
    return sinks.read_predictions(
        spark, config.path("predictions_export_path"), is_intraday(config.stocks.interval)
    )


def latest_prediction(spark: SparkSession, config: Config, ticker: str) -> dict[str, Any]:
    """Newest stored prediction of a ticker; ``KeyError`` when there is none."""
    return serve.lookup_latest_prediction(stored_predictions(spark, config), ticker)


def footer_summary(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Row count and first and last day of stored rows, from the files' footers.

    Only the newer Parquet reader answers from footers; a session of its own has it
    switched on. Times of day are not kept in footers in a form it takes, and are read.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return serve.date_summary(session.read.schema(schema).parquet(path))


def stored_summary(spark: SparkSession, path: str, schema: T.StructType) -> Row:
    return footer_summary(spark, path, schema).first()


def last_tickers(spark: SparkSession, path: str, rows: DataFrame, limit: int) -> list[str] | None:
    """The last tickers in order that together have ``limit`` rows, or all tickers.

    Walks the directories of a store by ticker from the last one, a few more at each
    step, so what is read grows with the limit and not with the store. None if the
    store has no such directories, or one of rows without a ticker.
    """
    unescape = (
        spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    )
    names = [name for name in children(spark, path) if name.startswith("ticker=")]
    left = [unescape(name.removeprefix("ticker=")) for name in names]
    if not left or "__HIVE_DEFAULT_PARTITION__" in left:
        return None
    left.sort(reverse=True)
    taken, found, step = [], 0, 1
    while left and found < limit:
        part, left = left[:step], left[step:]
        found += rows.where(F.col("ticker").isin(part)).count()
        taken += part
        step *= 2
    return taken


def market_data(
    spark: SparkSession, config: Config, ticker: str | None = None, limit: int | None = None
) -> DataFrame:
    """Last stored feature rows with the configured indicators."""
    features, api = config.features, config.api
    indicators = [*(f"ma_{w}" for w in features.ma_windows), f"rsi_{features.rsi_window}"]
    limit = api.default_limit if limit is None else limit
    rows = stored_features(spark, config)
    if ticker is None:
        last = last_tickers(spark, config.path("processed_parquet_path"), rows, limit)
        if last is not None:
            rows = rows.where(F.col("ticker").isin(last))
    return serve.market_data(rows, ticker, limit, indicators, api.max_limit)
