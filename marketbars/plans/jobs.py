"""The batch jobs: ingest, build features, train, report."""

from __future__ import annotations

from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.config import Config
from marketbars.functions.names import normalize_columns
from marketbars.models.regressors import evaluate_models, prediction_export
from marketbars.operators import slices
from marketbars.operators.changes import changed_features, changed_keys
from marketbars.operators.clean import clean_raw_prices
from marketbars.operators.features import add_technical_features
from marketbars.operators.serve import (
    actual_vs_predicted,
    default_ticker,
    multistock_lookback,
)
from marketbars.plans.lookups import stored_features, stored_predictions, stored_summary
from marketbars.schema import RAW_BAR, feature_schema
from marketbars.sources import sinks
from marketbars.sources.bars import (
    bars_between,
    bars_from_ticks,
    conform_raw,
    is_intraday,
    read_bars,
    require_tickers,
    spellings,
    stamp_provenance,
)
from marketbars.workspace import (
    ensure_checkpoint_dir,
    exists,
    new_folder,
    remove,
    shuffles_removed,
)


def run_timestamp() -> str:
    """One timestamp per run, zone included, so that every row carries the same."""
    return datetime.now(UTC).isoformat(timespec="microseconds")


def source_bars(spark: SparkSession, config: Config) -> DataFrame:
    """The configured tickers' bars in the configured date range, from the source.

    The range is applied to the source's own time column, so it reaches the scan,
    and ticks are upper-cased and filtered before they are grouped into bars.
    """
    return bars_of_source(wanted_rows(spark, config), config)


def wanted_rows(spark: SparkSession, config: Config) -> DataFrame:
    """The source's rows of the configured tickers and range, before any grouping."""
    stocks = config.stocks
    columns = {"bars": "trade_date", "ticks": "ts"}
    if stocks.source_kind not in columns:
        raise ValueError(f"unknown source kind {stocks.source_kind}")
    source = read_bars(
        spark,
        config.under_base(stocks.source_path),
        stocks.source_format,
        schema=None,
        options=stocks.source_options,
    )
    named = normalize_columns(source)
    # The stored spellings reach the files; the filter below stays the exact one.
    stored = bars_between(
        named,
        spellings(named, config.tickers),
        stocks.start_date,
        stocks.end_date,
        column=columns[stocks.source_kind],
    )
    return bars_between(stored.withColumn("ticker", F.upper("ticker")), config.tickers)


def bars_of_source(wanted: DataFrame, config: Config) -> DataFrame:
    """Ticks are made into bars of the interval; bars stay."""
    stocks = config.stocks
    if stocks.source_kind == "bars":
        return wanted
    sequence = "sequence" if "sequence" in wanted.columns else None
    return bars_from_ticks(wanted, stocks.interval, sequence=sequence)


def ingest(spark: SparkSession, config: Config, at: str | None = None) -> dict[str, Any]:
    """Bring the configured tickers' bars into the raw store and write a manifest."""
    stocks, path = config.stocks, config.path("raw_parquet_path")
    wanted = wanted_rows(spark, config)
    # Reads one column of the source, and nothing is grouped for it.
    require_tickers(wanted, config.tickers)
    stamped = stamp_provenance(
        bars_of_source(wanted, config), at or run_timestamp(), stocks.source_system
    )
    bars = conform_raw(stamped)
    if config.storage.partition_by_ticker:
        sinks.write_raw(bars, path)
    else:
        sinks.write_raw_bucketed(bars, path, config.storage.raw_buckets)

    written = read_bars(spark, path, tickers=config.tickers)
    record = sinks.manifest(written, config.project.name, config.tickers, path)
    sinks.write_record(record, config.path("ingestion_manifest_path"))
    count = spark.read.json(config.path("ingestion_manifest_path")).first().record_count
    return {
        "tickers": config.tickers,
        "record_count": count,
        "raw_output_path": path,
        "manifest_path": config.path("ingestion_manifest_path"),
    }


def _windows(config: Config) -> tuple[Any, ...]:
    features = config.features
    return features.ma_windows, features.lag_days, features.rsi_window


def feature_frame(raw: DataFrame, config: Config) -> DataFrame:
    """Raw bars to feature rows under the configured windows."""
    return features_of(clean_raw_prices(raw, is_intraday(config.stocks.interval)), config)


def features_of(bars: DataFrame, config: Config) -> DataFrame:
    """Clean bars to feature rows under the configured windows."""
    rows = config.features.rows_per_slice
    if rows is not None:
        return slices.add_technical_features(bars, *_windows(config), rows)
    return add_technical_features(bars, *_windows(config))


def update_features(spark: SparkSession, config: Config) -> dict[str, Any]:
    """Bring the stored bars and features up to date with the raw bars.

    Compares the clean bars with those of the last run, and recomputes and replaces
    only what changes. The bars are stored last, so a run that failed is repeated in
    full by the next. The first run computes everything.
    """
    staged = new_folder(spark, "clean")
    try:
        with shuffles_removed(spark):
            return _updated(spark, config, staged)
    finally:
        remove(spark, staged)


def _updated(spark: SparkSession, config: Config, staged: str) -> dict[str, Any]:
    """What ``update_features`` does, with the clean bars kept in ``staged``."""
    bars_path, features_path = config.path("clean_store_path"), config.path("feature_store_path")
    intraday = is_intraday(config.stocks.interval)
    raw = read_bars(spark, config.path("raw_parquet_path"), schema=RAW_BAR)
    cleaned = clean_raw_prices(raw, intraday).withColumn("year", F.year("trade_date"))
    cleaned.write.option("compression", "zstd").parquet(staged)
    dated = spark.read.parquet(staged)
    bars = dated.drop("year")
    layout = sinks.parts_layout(spark, bars_path, dated)
    if not exists(spark, bars_path):
        sinks.write_parts(features_of(bars, config), features_path, layout)
        sinks.write_parts(dated, bars_path, layout)
        return {"changed_bars": bars.count(), "affected_rows": None}
    ensure_checkpoint_dir(spark, config.path("checkpoint_path"))
    old = spark.read.schema(dated.schema).parquet(bars_path).select(*bars.columns)
    changed = changed_keys(old, bars).checkpoint()
    stale, fresh = changed_features(bars, changed, *_windows(config))
    stale = sinks.in_parts(stale.withColumn("year", F.year("trade_date")), layout).checkpoint()
    if not stale.isEmpty():
        kind = feature_schema(*_windows(config), intraday)
        stored = sinks.read_features(spark, features_path, kind)
        touched = stale.select(*layout).distinct().checkpoint()
        staying = (
            sinks.in_parts(stored, layout)
            # A row for each directory, which are listed on the driver as well.
            .join(F.broadcast(touched), list(layout), "left_semi")
            .join(stale, ["ticker", "trade_date"], "left_anti")
            .select(*stored.columns)
        )
        sinks.replace_parts([staying.to(kind), fresh.to(kind)], features_path, touched, layout)
        parts = changed.withColumn("year", F.year("trade_date"))
        parts = sinks.in_parts(parts, layout).select(*layout).distinct().checkpoint()
        renewed = sinks.in_parts(dated, layout).join(F.broadcast(parts), list(layout), "left_semi")
        sinks.replace_parts([renewed.select(*dated.columns)], bars_path, parts, layout)
    return {"changed_bars": changed.count(), "affected_rows": stale.count()}


def updated_features(spark: SparkSession, config: Config) -> DataFrame:
    """The features that ``update_features`` keeps."""
    kind = feature_schema(*_windows(config), is_intraday(config.stocks.interval))
    return sinks.read_features(spark, config.path("feature_store_path"), kind)


def build_features(spark: SparkSession, config: Config) -> dict[str, Any]:
    """Clean raw bars, write features once, and derive table and summary from that."""
    storage = config.storage
    processed, table = config.path("processed_parquet_path"), config.table("delta_feature_table")
    sinks.create_database(spark, storage.delta_database)

    raw = read_bars(spark, config.path("raw_parquet_path"), schema=RAW_BAR)
    sinks.write_features(feature_frame(raw, config), processed, storage.partition_by_ticker)

    written = stored_features(spark, config)
    buckets = storage.feature_buckets
    sinks.save_table(
        written,
        table,
        config.path("delta_feature_path"),
        storage.table_format,
        bucket_by=(buckets, "ticker") if buckets else None,
    )
    summary = stored_summary(spark, processed, written.schema)
    return {
        "feature_table": table,
        "record_count": summary.record_count,
        "processed_parquet_path": processed,
        "delta_feature_path": config.path("delta_feature_path"),
        "min_trade_date": str(summary.min_trade_date),
        "max_trade_date": str(summary.max_trade_date),
    }


def train(spark: SparkSession, config: Config, at: str | None = None) -> dict[str, Any]:
    """Compare the models on the feature table and store the best one's output."""
    storage = config.storage
    result = evaluate_models(config, spark.table(config.table("delta_feature_table")))
    result.best_model.write().overwrite().save(config.path("model_path"))

    metrics = sinks.metrics_frame(spark, result.metrics)
    sinks.write_metrics_json(
        spark, result.metrics, result.best_name, config.path("metrics_json_path")
    )
    sinks.write_metrics_parquet(metrics, config.path("metrics_parquet_path"))

    export_path = config.path("predictions_export_path")
    export = prediction_export(
        result.predictions, config.model.label_col, result.best_name, at or run_timestamp()
    )
    sinks.write_predictions(export, export_path)
    sinks.create_database(spark, storage.delta_database)
    table = config.table("delta_prediction_table")
    sinks.save_table(
        stored_predictions(spark, config),
        table,
        config.path("delta_prediction_path"),
        storage.table_format,
    )
    return {
        "best_model": result.best_name,
        "metrics": result.metrics,
        "model_path": config.path("model_path"),
        "metrics_json_path": config.path("metrics_json_path"),
        "metrics_parquet_path": config.path("metrics_parquet_path"),
        "prediction_table_name": table,
        "predictions_export_path": export_path,
    }


def report(spark: SparkSession, config: Config) -> dict[str, Any]:
    """Write the two chart series of the report as parquet."""
    features = stored_features(spark, config)
    predictions = stored_predictions(spark, config)
    ticker = default_ticker(predictions).first().ticker
    if ticker is None:
        raise ValueError("there are no predictions to report on")
    folder = config.path("dashboard_path")
    series = {
        "actual_vs_predicted": actual_vs_predicted(predictions, ticker),
        "multistock": multistock_lookback(features, config.dashboard.lookback_days),
    }
    for name, rows in series.items():
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")
    return {"ticker": ticker, **{name: f"{folder}/{name}" for name in series}}


STEPS = {"ingest": ingest, "features": build_features, "train": train, "report": report}


def run_all(spark: SparkSession, config: Config) -> dict[str, dict[str, Any]]:
    """All steps in order; each hands over through files and tables only."""
    return {name: step(spark, config) for name, step in STEPS.items()}
