"""Writers of bars, features, predictions, metrics and manifests, with their readers."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.operators.serve import leaderboard
from marketbars.schema import METRICS, prediction_schema
from marketbars.workspace import children, exists, new_folder, remove, shuffles_removed

# A store that begins with more directories by ticker than this is kept in buckets of tickers.
MOST_DIRECTORIES = 1_000
BUCKETS = 64


def bucket_of(buckets: int) -> Column:
    """The bucket of a ticker."""
    return F.pmod(F.xxhash64("ticker"), F.lit(buckets)).cast("int")


def in_buckets(spark: SparkSession, path: str, directories: DataFrame) -> bool:
    """Whether a store is one of buckets; a new one is if it had too many ``directories``.

    Files and directories of a store by ticker grow with the tickers, each for a few
    rows; those of buckets do not. A store keeps the form it began with.
    """
    kept_by = {name.partition("=")[0] for name in children(spark, path)} & {"bucket", "ticker"}
    if kept_by:
        return "bucket" in kept_by
    return directories.distinct().limit(MOST_DIRECTORIES + 1).count() > MOST_DIRECTORIES


def write_raw(df: DataFrame, path: str) -> None:
    """Replace the bars of the tickers in ``df``, a directory each; the others stay.

    Rebalancing on ticker gives each directory few files, and adaptive execution
    splits a ticker that is too large for one task. Very many tickers share buckets.
    """
    if in_buckets(df.sparkSession, path, df.select("ticker")):
        write_raw_bucketed(df, path, BUCKETS)
        return
    (
        df.hint("rebalance", "ticker")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ticker")
        .parquet(path)
    )


def write_raw_bucketed(df: DataFrame, path: str, buckets: int) -> None:
    """Replace the bars of the tickers in ``df`` in a store of ``buckets`` directories.

    For very many tickers. Only buckets that hold one of the tickers are rewritten,
    with the bars of their other tickers merged in; those are written beside the
    store first, as a store cannot be overwritten while it is read.
    """
    spark = df.sparkSession
    staged = new_folder(spark, "raw-staging")
    with shuffles_removed(spark):
        rows = df.withColumn("bucket", bucket_of(buckets))
        rows.write.option("compression", "zstd").parquet(f"{staged}/new")
        new = spark.read.parquet(f"{staged}/new")
        if exists(spark, path):
            touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]
            stored = spark.read.schema(new.schema).parquet(path)
            stored = stored.where(F.col("bucket").isin(touched))
            renewed = new.select(F.col("ticker").alias("renewed")).distinct()
            same = F.col("ticker").eqNullSafe(F.col("renewed"))
            others = stored.join(renewed, same, "left_anti")
            others.write.option("compression", "zstd").parquet(f"{staged}/others")
            new = spark.read.schema(new.schema).parquet(f"{staged}/new", f"{staged}/others")
        (
            new.hint("rebalance", "bucket")
            .sortWithinPartitions("bucket", "ticker", "trade_date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("bucket")
            .parquet(path)
        )
    remove(spark, staged)


def write_features(df: DataFrame, path: str, partition_by_ticker: bool = True) -> None:
    """Overwrite the feature files.

    Feature rows leave their windows grouped by ticker and sorted, so they are
    written as they come, without another shuffle.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by_ticker:
        writer = writer.partitionBy("ticker")
    writer.parquet(path)


def read_features(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Stored features; the schema keeps numeric-looking tickers strings."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


BY_TICKER, BY_BUCKET = ("ticker", "year"), ("bucket", "year")


def parts_layout(spark: SparkSession, path: str, rows: DataFrame) -> tuple[str, ...]:
    """What a store of parts has a directory for; ``rows`` decide where there is none yet."""
    return BY_BUCKET if in_buckets(spark, path, rows.select(*BY_TICKER)) else BY_TICKER


def in_parts(df: DataFrame, layout: Sequence[str]) -> DataFrame:
    """``df`` with every column of the layout."""
    return df.withColumn("bucket", bucket_of(BUCKETS)) if "bucket" in layout else df


def _write_parts(df: DataFrame, path: str, layout: Sequence[str], overwrite: str) -> None:
    rows = in_parts(df, layout).hint("rebalance", *layout)
    in_order = rows.sortWithinPartitions(*dict.fromkeys([*layout, "ticker", "trade_date"]))
    writer = in_order.write.mode("overwrite").option("partitionOverwriteMode", overwrite)
    writer.partitionBy(*layout).parquet(path)


def write_parts(df: DataFrame, path: str, layout: Sequence[str] = BY_TICKER) -> None:
    """Overwrite a store of one directory for each part of the layout."""
    _write_parts(df, path, layout, "static")


def replace_parts(
    pieces: Sequence[DataFrame],
    path: str,
    touched: DataFrame,
    layout: Sequence[str] = BY_TICKER,
) -> None:
    """Replace the ``touched`` directories of a store of parts by the rows of ``pieces``.

    They may read the store: they are written beside it first, one after the other, so
    that the shuffles of one are gone when the next is made. Touched directories
    that get no rows are removed; their number is that of emptied years, and only their
    names come to the driver.
    """
    spark = touched.sparkSession
    staged = new_folder(spark, "parts")
    for piece in pieces:
        piece.write.mode("append").option("compression", "zstd").parquet(staged)
    rows = spark.read.schema(pieces[0].schema).parquet(staged)
    filled = in_parts(rows, layout).select(*layout).distinct()
    empty = touched.join(filled, list(layout), "left_anti").collect()
    _write_parts(rows, path, layout, "dynamic")
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for row in empty:
        remove(spark, "/".join([path, *(f"{name}={escape(str(row[name]))}" for name in layout)]))
    remove(spark, staged)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def save_table(
    df: DataFrame,
    name: str,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    bucket_by: tuple[int, str] | None = None,
) -> None:
    """Write an external catalog table; an overwrite may change its schema.

    With ``bucket_by=(n, "ticker")`` later per-ticker windows and joins read the
    table without a shuffle. Rows are grouped first, so each bucket is one file.
    """
    if bucket_by:
        count, column = bucket_by
        df = df.repartition(count, column)
    writer = df.write.format(fmt).mode(mode).option("path", path)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    elif bucket_by:
        writer = writer.bucketBy(count, column).sortBy(column, "trade_date")
    writer.saveAsTable(name)


# Tickers that a bloom filter of one file is sized for; a file with more answers "maybe" more often.
TICKERS_PER_FILE = 50_000


def write_predictions(df: DataFrame, path: str) -> None:
    """Overwrite the prediction files, grouped and sorted for lookups by ticker.

    Tickers are dealt to files by hash, so a file's least and largest ticker say
    little; a bloom filter of its tickers lets a lookup skip the file.
    """
    (
        df.hint("rebalance", "ticker")
        .sortWithinPartitions("ticker", "trade_date")
        .write.mode("overwrite")
        .option("parquet.bloom.filter.enabled#ticker", "true")
        .option("parquet.bloom.filter.expected.ndv#ticker", str(TICKERS_PER_FILE))
        .parquet(path)
    )


def read_predictions(spark: SparkSession, path: str, intraday: bool = False) -> DataFrame:
    return spark.read.schema(prediction_schema(intraday)).parquet(path)


def metrics_frame(spark: SparkSession, metrics: Sequence[dict[str, Any]]) -> DataFrame:
    return spark.createDataFrame([(m["model_name"], m["rmse"]) for m in metrics], METRICS)


def write_metrics_parquet(metrics: DataFrame, path: str) -> None:
    """One row per model, best first."""
    leaderboard(metrics.coalesce(1)).write.mode("overwrite").parquet(path)


def write_metrics_json(
    spark: SparkSession, metrics: Sequence[dict[str, Any]], best_model: str, path: str
) -> None:
    """One record: the scores in the order of training, and the name of the best model."""
    scores = [(m["model_name"], m["rmse"]) for m in metrics]
    kind = "metrics array<struct<model_name: string, rmse: double>>, best_model string"
    write_record(spark.createDataFrame([(scores, best_model)], kind), path)


def manifest(
    bars: DataFrame, project: str, tickers: Sequence[str], raw_output_path: str
) -> DataFrame:
    """One record on a run's raw bars; the ticker list is the configured one."""
    return bars.agg(
        F.lit(project).alias("project"),
        F.array(*(F.lit(t) for t in tickers)).alias("tickers"),
        F.count(F.lit(1)).alias("record_count"),
        F.struct(
            F.min("trade_date").alias("min_trade_date"),
            F.max("trade_date").alias("max_trade_date"),
        ).alias("date_range"),
        F.lit(raw_output_path).alias("raw_output_path"),
    )


def write_record(record: DataFrame, path: str) -> None:
    """Write a one-row frame as a JSON file."""
    record.coalesce(1).write.mode("overwrite").json(path)
