"""Registered queries: each runs one operator over whole tables."""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Callable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketbars.checks import inputs
from marketbars.config import Config, Gbt, Model, RandomForest, Stocks, Storage
from marketbars.functions.columns import calendar_parts, gain, loss
from marketbars.functions.names import normalize_columns
from marketbars.models import regressors
from marketbars.operators import clean, dataset, features, serve, slices
from marketbars.plans import jobs, lookups
from marketbars.schema import feature_schema, training_columns
from marketbars.sources import bars, sinks, tick_store
from marketbars.workspace import new_folder

ORTHOGONAL = 1e-3  # cosine

Query = Callable[[SparkSession, str], DataFrame]

FEATURE_SCHEMA = feature_schema(inputs.MA_WINDOWS, inputs.LAG_DAYS, inputs.RSI_WINDOW)
# Small trees keep most checks short; ``job_train`` fits the configured sizes.
SMALL = Config(
    model=Model(
        random_forest=RandomForest(num_trees=20, max_depth=5),
        gbt=Gbt(max_iter=10, max_depth=3),
    )
)


def shown(df: DataFrame) -> DataFrame:
    """The result in a form that compares equal to SQL.

    Doubles are rounded to six places, as sums may run in another order, and
    timestamps are shown as the session reads them.
    """

    def plain(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            return F.round(column, 6).alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return column.cast("timestamp_ntz").alias(field.name)
        return column

    return df.select(*(plain(field) for field in df.schema))


# Sources


def _stored_raw(spark: SparkSession, sf_dir: str) -> str:
    """Raw order bars, stored by ticker."""
    path = new_folder(spark, "raw")
    raw = inputs.order_bars(spark, sf_dir).withColumn("ticker", F.upper("ticker"))
    sinks.write_raw(bars.conform_raw(raw), path)
    return path


def read_bars_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _stored_raw(spark, sf_dir)
    wanted = bars.read_bars(
        spark, path, tickers=["F", "O"], start="1996-01-01", end="1999-01-01"
    )
    return clean.clean_projection(wanted)


def missing_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = clean.clean_projection(inputs.order_bars(spark, sf_dir))
    return bars.missing_tickers(typed, ["F", "O", "P", "X"])


def header_normalization(spark: SparkSession, sf_dir: str) -> DataFrame:
    vendor = inputs.table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("Ticker"),
        F.to_date("o_orderdate").alias("Date"),
        F.col("o_totalprice").alias(" Close "),
        (F.col("o_totalprice") * 0.98).alias("Adj Close"),
        F.col("o_custkey").alias("Stock Splits"),
    )
    return normalize_columns(vendor)


def stamp_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    fetched = inputs.order_bars(spark, sf_dir).select("ticker", "trade_date", "close")
    return bars.stamp_provenance(fetched, inputs.RUN_TIMESTAMP, "vendor")


def sql_select_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "sql")
    name = "features_" + folder.rsplit("-", 1)[1]
    rows = inputs.with_features(inputs.clean_orders(spark, sf_dir))
    sinks.save_table(rows, name, folder)
    stored = spark.sql(f"SELECT * FROM {name}")
    stored.schema  # resolved now: the catalog entry goes, the files stay
    spark.sql(f"DROP TABLE {name}")
    return stored


def bars_from_merged_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks in four batches, in no order of time, one of them sent twice."""
    path = new_folder(spark, "ticks")
    ticks = inputs.table(spark, sf_dir, "events")
    batch = F.pmod(F.hash("event_id"), F.lit(4))
    for k in (2, 0, 2, 3, 1):
        part = bars.partial_bars(
            ticks.where(batch == k), ticker="event_type", price="value", sequence="event_id"
        )
        tick_store.add_batch(part, path, f"batch-{k}")
        if k == 3:
            tick_store.compact(spark, path)
    return bars.finished_bars(tick_store.stored_partials(spark, path), "events")


# Sinks: write to a folder of their own, then read back


def roundtrip_raw_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_projection(bars.read_bars(spark, _stored_raw(spark, sf_dir)))


def roundtrip_raw_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tickers, then some of them again: the others have to stay."""
    path = new_folder(spark, "raw")
    raw = inputs.order_bars(spark, sf_dir).withColumn("ticker", F.upper("ticker"))
    raw = bars.conform_raw(raw)
    sinks.write_raw_bucketed(raw, path, buckets=2)
    sinks.write_raw_bucketed(raw.where("ticker = 'F'"), path, buckets=2)
    return clean.clean_projection(bars.read_bars(spark, path))


def roundtrip_features_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "features")
    sinks.write_features(inputs.with_features(inputs.clean_orders(spark, sf_dir)), path)
    return sinks.read_features(spark, path, FEATURE_SCHEMA)


def roundtrip_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "catalog")
    database = "marketbars_" + folder.rsplit("-", 1)[1]
    sinks.create_database(spark, database, f"{folder}/database")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sinks.save_table(
        inputs.supplier_features(spark, sf_dir),
        f"{database}.stock_features",
        f"{folder}/stock_features",
        bucket_by=(buckets, "ticker"),
    )
    stored = spark.table(f"{database}.stock_features")
    # The table is external: its files outlive the catalog entry.
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return stored


def roundtrip_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "predictions")
    sinks.write_predictions(inputs.naive_predictions(spark, sf_dir), path)
    return sinks.read_predictions(spark, path)


def roundtrip_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "metrics")
    sinks.write_metrics_parquet(rmse_overall(spark, sf_dir), f"{folder}/parquet")
    stored = spark.read.parquet(f"{folder}/parquet")
    scores = [row.asDict() for row in stored.collect()]  # one for each model
    sinks.write_metrics_json(spark, scores, "naive", f"{folder}/json")
    record = spark.read.json(f"{folder}/json")
    return record.select(F.inline("metrics"))


def roundtrip_metrics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored record: how many scores it has, and which model it calls the best."""
    path = new_folder(spark, "metrics")
    scores = [row.asDict() for row in rmse_overall(spark, sf_dir).collect()]  # a row per model
    best = regressors.pick_best({score["model_name"]: score["rmse"] for score in scores})
    sinks.write_metrics_json(spark, scores, best, path)
    return spark.read.json(path).select(F.size("metrics").alias("models"), "best_model")


def _shown_manifest(record: DataFrame) -> DataFrame:
    return record.select(
        "project",
        F.array_join("tickers", ",").alias("tickers"),
        "record_count",
        F.to_date("date_range.min_trade_date").alias("min_trade_date"),
        F.to_date("date_range.max_trade_date").alias("max_trade_date"),
    )


def ingest_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = clean.clean_projection(inputs.order_bars(spark, sf_dir))
    tickers = ["F", "O", "P"]
    run = bars.bars_between(typed, tickers)
    return _shown_manifest(sinks.manifest(run, "market_bars", tickers, sf_dir))


def roundtrip_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "manifest")
    typed = clean.clean_projection(inputs.order_bars(spark, sf_dir))
    tickers = ["F", "O", "P"]
    run = bars.bars_between(typed, tickers)
    sinks.write_record(sinks.manifest(run, "market_bars", tickers, sf_dir), path)
    return _shown_manifest(spark.read.json(path))


# Cleaning


def clean_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_projection(inputs.order_bars(spark, sf_dir))


def dedup_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.dedup_bars(clean.clean_projection(inputs.order_bars(spark, sf_dir)))


# Features


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.with_price_change(inputs.clean_suppliers(spark, sf_dir))


def price_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(spark, sf_dir).select(
        "ticker", "trade_date", "close", "previous_close", "price_change"
    )


def gain_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    change = F.col("price_change")
    return _changes(spark, sf_dir).select(
        "ticker", "trade_date", gain(change).alias("gain"), loss(change).alias("loss")
    )


def daily_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(spark, sf_dir).select("ticker", "trade_date", features.daily_return())


def rsi_14(spark: SparkSession, sf_dir: str) -> DataFrame:
    moves = _changes(spark, sf_dir).select("*", *features.average_moves(14))
    return moves.select("ticker", "trade_date", features.rsi(14))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.clean_suppliers(spark, sf_dir).select(
        "ticker", "trade_date", *calendar_parts(F.col("trade_date"))
    )


def moving_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.clean_suppliers(spark, sf_dir).select(
        "ticker", "trade_date", *features.moving_averages(inputs.MA_WINDOWS)
    )


def lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.clean_suppliers(spark, sf_dir).select(
        "ticker", "trade_date", *features.lags(inputs.LAG_DAYS)
    )


def target_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        inputs.clean_suppliers(spark, sf_dir)
        .select("ticker", "trade_date", "close", features.target_close())
        .filter(F.col("target_close").isNotNull())
    )


def technical_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.with_features(inputs.clean_orders(spark, sf_dir))


def ordered_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.in_series_order(technical_features(spark, sf_dir))


def _sliced(bars_of: Query, rows: int, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features by slices of so many rows, instead of by whole series."""
    return slices.add_technical_features(
        bars_of(spark, sf_dir), inputs.MA_WINDOWS, inputs.LAG_DAYS, inputs.RSI_WINDOW, rows
    )


def features_after_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of older bars, brought up to date: bars come, change and go."""
    config = Config(storage=Storage(base_path=new_folder(spark, "update")))
    current = inputs.supplier_bars(spark, sf_dir).withColumn("ticker", F.upper("ticker"))
    told = F.crc32(F.concat_ws(":", "ticker", F.col("trade_date").cast("string"))) % 40
    lines = current.withColumn("told", told)
    older = lines.where("told > 1").withColumn(
        "close", F.when(F.col("told") == 2, F.col("close") * 2).otherwise(F.col("close"))
    )
    gone = lines.where("told = 3").withColumn("trade_date", F.expr("trade_date + INTERVAL 9 YEAR"))
    for stored in (older.unionByName(gone).drop("told"), current):
        sinks.write_raw(bars.conform_raw(stored), config.path("raw_parquet_path"))
        jobs.update_features(spark, config)
    return jobs.updated_features(spark, config)


def ordered_features_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's place in the ordered output, from its partition and its place there."""
    part, at = F.spark_partition_id(), F.monotonically_increasing_id()
    rows = ordered_features(spark, sf_dir).select("ticker", "trade_date")
    rows = rows.select("*", part.alias("part"), at.alias("at"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row per partition
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("part").orderBy("at"))
    return rows.join(starts, "part").select(
        "ticker", "trade_date", (F.col("start") + within).alias("place")
    )


# Aggregates and set operations


def etl_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.date_summary(inputs.supplier_features(spark, sf_dir))


def etl_summary_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of stored rows, from the footers of their files."""
    path = new_folder(spark, "features")
    sinks.write_features(inputs.supplier_features(spark, sf_dir), path, False)
    return lookups.footer_summary(spark, path, FEATURE_SCHEMA)


def _supplier_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_projection(inputs.supplier_bars(spark, sf_dir))


def available_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.available_tickers(_supplier_tickers(spark, sf_dir))


def default_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.default_ticker(_supplier_tickers(spark, sf_dir))


def union_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    common = ["ticker", "trade_date", "close", "source_system"]
    both = bars.union_frames(
        [
            inputs.order_bars(spark, sf_dir).select(*common, "adj_close"),
            inputs.supplier_bars(spark, sf_dir).select(*common),
        ]
    )
    return both.withColumn("trade_date", F.to_date("trade_date"))


# Training rows


def split_flag_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places and lengths from counts per slice."""
    columns = training_columns(inputs.MA_WINDOWS, inputs.LAG_DAYS, inputs.RSI_WINDOW)
    frame = slices.split_series(
        inputs.supplier_features(spark, sf_dir), columns, "target_close", inputs.TRAIN_RATIO, 100
    )
    return frame.select(
        "ticker", "trade_date", "row_num", "row_count", "split_boundary", "dataset_split"
    )


def training_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.supplier_training(spark, sf_dir).drop("split_boundary", "dataset_split")


def split_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.supplier_training(spark, sf_dir).select(
        "ticker", "trade_date", "row_num", "row_count", "split_boundary", "dataset_split"
    )


def _side(
    keep: Callable[[DataFrame], DataFrame], spark: SparkSession, sf_dir: str
) -> DataFrame:
    return keep(inputs.supplier_training(spark, sf_dir)).select(
        "ticker", "trade_date", "close", "target_close", "row_num"
    )


# Models


def _layout(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Training rows as the models read them, with the ``columns`` that are read or with all."""
    rows = inputs.supplier_training(spark, sf_dir).select(*columns or "*")
    return regressors.fixed_layout(rows, SMALL.model.fit_partitions)


def ticker_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = _layout(spark, sf_dir, "ticker", "trade_date", "dataset_split")
    train = dataset.train_rows(frame)
    stage, _ = regressors.ticker_stage(train, SMALL.model)
    indexed = Pipeline(stages=[stage]).fit(train).transform(frame)
    return indexed.select("ticker", "trade_date", "dataset_split", "ticker_index")


def ticker_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many different numbers as tickers."""
    frame = inputs.supplier_training(spark, sf_dir)
    stage, _ = regressors.ticker_stage(frame, Model(ticker_encoding="hash"))
    return stage.transform(frame).agg(
        F.count_distinct("ticker").alias("tickers"),
        F.count_distinct("ticker_index").alias("numbers"),
    )


def sparse_ticker_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model over many tickers whose inputs and bins do not grow with their number."""
    config = dataclasses.replace(SMALL, model=Model(ticker_encoding="sparse"))
    features_of = inputs.customer_features(spark, sf_dir)
    frame = regressors.fixed_layout(
        regressors.training_frame(features_of, config), config.model.fit_partitions
    )
    train = dataset.train_rows(frame)
    model = regressors.fit_pipeline("linear_regression", train, config)
    _, bins = regressors.ticker_stage(train, config.model)
    scored = model.transform(frame)
    return scored.agg(
        F.count_distinct("ticker").alias("tickers"),
        F.count_if(F.col("dataset_split") == dataset.TEST).alias("test_rows"),
        F.count("prediction").alias("predicted"),
        F.lit(model.stages[-1].numFeatures).alias("inputs"),
        F.lit(bins).alias("bins"),
    )


def _predict(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = _layout(spark, sf_dir)
    model = regressors.fit_pipeline(name, dataset.train_rows(frame), SMALL)
    return _exported(model, dataset.test_rows(frame), name)


def _exported(model: PipelineModel, rows: DataFrame, name: str) -> DataFrame:
    return regressors.prediction_export(
        model.transform(rows), "target_close", name, inputs.RUN_TIMESTAMP
    )


def model_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = regressors.evaluate_models(SMALL, inputs.supplier_features(spark, sf_dir))
    return serve.leaderboard(sinks.metrics_frame(spark, result.metrics))


def best_model_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = regressors.evaluate_models(SMALL, inputs.supplier_features(spark, sf_dir))
    return regressors.prediction_export(
        result.predictions, "target_close", result.best_name, inputs.RUN_TIMESTAMP
    )


def score_saved_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, path = _layout(spark, sf_dir), new_folder(spark, "model")
    model = regressors.fit_pipeline("linear_regression", dataset.train_rows(frame), SMALL)
    model.write().overwrite().save(path)
    scored = regressors.score_saved_model(path, dataset.test_rows(frame))
    return regressors.prediction_export(
        scored, "target_close", "linear_regression", inputs.RUN_TIMESTAMP
    )


def _fitted_on_train(
    name: str, spark: SparkSession, sf_dir: str
) -> tuple[PipelineModel, DataFrame]:
    frame = _layout(spark, sf_dir)
    return regressors.fit_pipeline(name, dataset.train_rows(frame), SMALL), frame


def linear_fit_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least squares leaves residuals that are orthogonal to each input and to one.

    The solver is iterative and the inputs are collinear, so the cosine of the
    angle is held against a tolerance.
    """
    model, frame = _fitted_on_train("linear_regression", spark, sf_dir)
    columns = [*regressors.feature_columns(SMALL), "ticker_index"]
    scored = model.transform(dataset.train_rows(frame)).withColumn("one", F.lit(1.0))
    residual = F.col("prediction") - F.col("target_close")

    def cosine(name: str) -> Column:
        value = F.col(name).cast("double")
        sizes = F.sqrt(F.sum(residual * residual) * F.sum(value * value))
        return F.coalesce(F.try_divide(F.sum(residual * value), sizes), F.lit(0.0))

    sums = scored.agg(
        F.count(F.lit(1)).alias("train_rows"),
        *(cosine(name).alias(name) for name in ["one", *columns]),
    )
    return sums.unpivot(["train_rows"], ["one", *columns], "input", "cosine").select(
        "input", "train_rows", (F.abs("cosine") < ORTHOGONAL).alias("orthogonal")
    )


def forest_fit_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of leaves stay within the labels they are means of."""
    model, frame = _fitted_on_train("random_forest", spark, sf_dir)
    label = F.col("target_close")
    low, high = dataset.train_rows(frame).agg(F.min(label), F.max(label)).first()
    slack = 1e-9 * (abs(low) + abs(high))
    return model.transform(dataset.test_rows(frame)).agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.count_if(F.col("prediction").between(low - slack, high + slack)).alias("inside"),
    )


def gbt_fit_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosting explains the rows it was fitted on better than their mean does."""
    model, frame = _fitted_on_train("gbt_regressor", spark, sf_dir)
    error = F.avg((F.col("prediction") - F.col("target_close")) ** 2)
    return model.transform(dataset.train_rows(frame)).agg(
        F.count(F.lit(1)).alias("train_rows"),
        (error < F.var_pop("target_close")).alias("beats_mean"),
    )


def leaderboard_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models by score, the best one first, its score that of its own predictions."""
    result = regressors.evaluate_models(SMALL, inputs.supplier_features(spark, sf_dir))
    board = serve.leaderboard(sinks.metrics_frame(spark, result.metrics)).collect()
    scores = [row.rmse for row in board]
    exported = regressors.prediction_export(
        result.predictions, "target_close", result.best_name, inputs.RUN_TIMESTAMP
    )
    return exported.agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.lit(len(board)).alias("models"),
        F.lit(scores == sorted(scores)).alias("in_order"),
        F.lit(board[0].model_name == result.best_name).alias("best_is_first"),
        (
            F.abs(F.sqrt(F.avg((F.col("prediction") - F.col("actual_close")) ** 2)) - scores[0])
            < 1e-6 * scores[0]
        ).alias("score_is_its_own"),
    )


def saved_model_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model that was saved and loaded predicts what it did before."""
    model, frame = _fitted_on_train("random_forest", spark, sf_dir)
    path = new_folder(spark, "model")
    model.write().overwrite().save(path)
    fresh = model.transform(dataset.test_rows(frame)).withColumnRenamed("prediction", "fresh")
    again = fresh.drop("ticker_index", "features")
    return regressors.score_saved_model(path, again).agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.max(F.abs(F.col("prediction") - F.col("fresh"))).alias("largest_difference"),
    )


# Jobs over the given tables, in a folder of their own


def _job_config(spark: SparkSession, sf_dir: str, model: Model = SMALL.model) -> Config:
    """Three series from the orders."""
    folder = new_folder(spark, "jobs")
    inputs.order_bars(spark, sf_dir).write.parquet(f"{folder}/source")
    return Config(
        stocks=Stocks(tickers=("f", "o", "p"), start_date=None),
        storage=Storage(
            base_path=folder, delta_database="marketbars_" + folder.rsplit("-", 1)[1]
        ),
        model=model,
    )


def _after_jobs(spark: SparkSession, config: Config, *steps: str) -> None:
    for step in steps:
        job = jobs.STEPS[step]
        if step == "features":
            job(spark, config)
        else:
            job(spark, config, inputs.RUN_TIMESTAMP)
    # Tables are external: their files outlive the catalog entries.
    spark.sql(f"DROP DATABASE IF EXISTS {config.storage.delta_database} CASCADE")


def job_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _job_config(spark, sf_dir)
    _after_jobs(spark, config, "ingest")
    return clean.clean_projection(bars.read_bars(spark, config.path("raw_parquet_path")))


def job_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _job_config(spark, sf_dir)
    _after_jobs(spark, config, "ingest", "features")
    return lookups.stored_features(spark, config)


def job_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored predictions without what the model itself says, of models in full size."""
    config = _job_config(spark, sf_dir, Model())
    _after_jobs(spark, config, "ingest", "features", "train")
    return lookups.stored_predictions(spark, config).select(
        "ticker", "trade_date", "actual_close", "predicted_at"
    )


def job_train_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored predictions are those of the stored model, which the scores call the best."""
    config = _job_config(spark, sf_dir)
    _after_jobs(spark, config, "ingest", "features", "train")
    split = regressors.training_frame(lookups.stored_features(spark, config), config)
    again = regressors.score_saved_model(
        config.path("model_path"), dataset.test_rows(split)
    ).select("ticker", "trade_date", F.col("prediction").alias("again"))
    board = spark.read.parquet(config.path("metrics_parquet_path")).orderBy("rmse").collect()
    record = spark.read.json(config.path("metrics_json_path")).first()
    stored = lookups.stored_predictions(spark, config)
    return stored.join(again, ["ticker", "trade_date"]).agg(
        F.count(F.lit(1)).alias("test_rows"),
        F.max(F.abs(F.col("prediction") - F.col("again"))).alias("largest_difference"),
        F.min(F.col("model_name") == record.best_model).alias("best_predicts"),
        F.lit(board[0].model_name == record.best_model).alias("best_is_first"),
        F.lit(len(board)).alias("models"),
    )


def job_run_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What all jobs in a row have stored, one line for each output."""
    config = _job_config(spark, sf_dir)
    jobs.run_all(spark, config)
    charts = config.path("dashboard_path")
    series = spark.read.parquet(f"{charts}/actual_vs_predicted")
    outputs = {
        "raw": (bars.read_bars(spark, config.path("raw_parquet_path")), "close"),
        "features": (lookups.stored_features(spark, config), "ma_20"),
        "feature_table": (spark.table(config.table("delta_feature_table")), "rsi_14"),
        "predictions": (lookups.stored_predictions(spark, config), "actual_close"),
        "prediction_table": (spark.table(config.table("delta_prediction_table")), "actual_close"),
        "actual": (series.where("series = 'Actual Close'"), "price"),
        "multistock": (spark.read.parquet(f"{charts}/multistock"), "close"),
    }

    def line(name: str, rows: DataFrame, value: str) -> DataFrame:
        return rows.agg(
            F.lit(name).alias("output"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("ticker").alias("tickers"),
            F.to_date(F.min("trade_date")).alias("first_day"),
            F.to_date(F.max("trade_date")).alias("last_day"),
            F.round(F.avg(value), 3).alias("mean_value"),
        )

    lines = [line(name, *output) for name, output in outputs.items()]
    # Computed here, as the catalog entries go now.
    found = functools.reduce(DataFrame.unionAll, lines).collect()
    kind = lines[0].schema
    spark.sql(f"DROP DATABASE IF EXISTS {config.storage.delta_database} CASCADE")
    return spark.createDataFrame(found, kind)


def prediction_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored form of predictions, of today's close as the prediction."""
    rows = dataset.test_rows(inputs.supplier_training(spark, sf_dir))
    predicted = rows.withColumn("prediction", F.col("close"))
    return regressors.prediction_export(
        predicted, "target_close", "naive", inputs.RUN_TIMESTAMP
    )


# Serving


def rmse_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.rmse(inputs.standin_predictions(spark, sf_dir), "model_name")


def rmse_by_ticker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.rmse(inputs.standin_predictions(spark, sf_dir), "model_name", "ticker")


def latest_prediction(
    spark: SparkSession, sf_dir: str, ticker: str | None = None
) -> DataFrame:
    return serve.latest_prediction(inputs.naive_predictions(spark, sf_dir), ticker)


def market_data(
    spark: SparkSession, sf_dir: str, ticker: str | None = None, limit: int = 200
) -> DataFrame:
    return serve.market_data(inputs.supplier_features(spark, sf_dir), ticker, limit)


def market_data_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The end of a store by ticker, of which only the last directories are read."""
    config = Config(storage=Storage(base_path=new_folder(spark, "walk")))
    rows = inputs.supplier_features(spark, sf_dir)
    sinks.write_features(rows, config.path("processed_parquet_path"))
    return lookups.market_data(spark, config)


def actual_vs_predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.actual_vs_predicted(inputs.naive_predictions(spark, sf_dir), "S1")


def multistock_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serve.multistock_lookback(inputs.supplier_features(spark, sf_dir), 180)


REGISTERED: dict[str, Query] = {
    "read_bars_range": read_bars_range,
    "missing_tickers": missing_tickers,
    "bars_from_ticks": inputs.event_bars,
    "bars_from_ticks_hourly": functools.partial(inputs.event_bars, interval="1h"),
    "bars_from_ticks_weekly": functools.partial(inputs.event_bars, interval="1wk"),
    "bars_from_ticks_no_sequence": functools.partial(inputs.event_bars, sequence=None),
    "bars_from_merged_ticks": bars_from_merged_ticks,
    "bars_by_customer": inputs.customer_bars,
    "normalize_columns": header_normalization,
    "stamp_provenance": stamp_provenance,
    "sql_select_features": sql_select_features,
    "roundtrip_raw_partitioned": roundtrip_raw_partitioned,
    "roundtrip_raw_bucketed": roundtrip_raw_bucketed,
    "roundtrip_features_parquet": roundtrip_features_parquet,
    "roundtrip_table": roundtrip_table,
    "roundtrip_predictions": roundtrip_predictions,
    "roundtrip_metrics": roundtrip_metrics,
    "roundtrip_manifest": roundtrip_manifest,
    "roundtrip_metrics_json": roundtrip_metrics_json,
    "clean_projection": clean_projection,
    "dedup_bars": dedup_bars,
    "clean_raw_prices": inputs.clean_orders,
    "clean_raw_prices_supplier": inputs.clean_suppliers,
    "price_change": price_change,
    "gain_loss": gain_loss,
    "daily_return": daily_return,
    "rsi_14": rsi_14,
    "calendar_parts": calendar,
    "moving_averages": moving_averages,
    "lags": lags,
    "target_close": target_close,
    "technical_features": technical_features,
    "technical_features_supplier": inputs.supplier_features,
    "technical_features_customer": inputs.customer_features,
    "technical_features_hourly": inputs.hourly_features,
    "technical_features_sliced": functools.partial(_sliced, inputs.clean_orders, 300),
    "technical_features_sliced_supplier": functools.partial(_sliced, inputs.clean_suppliers, 200),
    "technical_features_sliced_hourly": functools.partial(_sliced, inputs.clean_hourly, 100),
    "features_after_changes": features_after_changes,
    "ordered_features": ordered_features,
    "ordered_features_places": ordered_features_places,
    "etl_summary": etl_summary,
    "etl_summary_footers": etl_summary_footers,
    "ingest_manifest": ingest_manifest,
    "available_tickers": available_tickers,
    "default_ticker": default_ticker,
    "union_frames": union_frames,
    "training_dataset": training_dataset,
    "split_flag": split_flag,
    "split_flag_sliced": split_flag_sliced,
    "train_rows": functools.partial(_side, dataset.train_rows),
    "test_rows": functools.partial(_side, dataset.test_rows),
    "ticker_index": ticker_index,
    "ticker_hash": ticker_hash,
    "sparse_ticker_checks": sparse_ticker_checks,
    "predict_linear": functools.partial(_predict, "linear_regression"),
    "predict_forest": functools.partial(_predict, "random_forest"),
    "predict_gbt": functools.partial(_predict, "gbt_regressor"),
    "model_leaderboard": model_leaderboard,
    "best_model_predictions": best_model_predictions,
    "score_saved_model": score_saved_model,
    "linear_fit_checks": linear_fit_checks,
    "forest_fit_checks": forest_fit_checks,
    "gbt_fit_checks": gbt_fit_checks,
    "leaderboard_checks": leaderboard_checks,
    "saved_model_checks": saved_model_checks,
    "job_ingest": job_ingest,
    "job_features": job_features,
    "job_train": job_train,
    "job_train_checks": job_train_checks,
    "job_run_all": job_run_all,
    "prediction_export": prediction_export,
    "rmse_overall": rmse_overall,
    "rmse_by_ticker": rmse_by_ticker,
    "latest_prediction": latest_prediction,
    "latest_prediction_ticker": functools.partial(latest_prediction, ticker="s1"),
    "market_data_all": market_data,
    "market_data_walk": market_data_walk,
    "market_data_ticker": functools.partial(market_data, ticker="s1", limit=50),
    "actual_vs_predicted": actual_vs_predicted,
    "multistock_lookback": multistock_lookback,
}


def queries() -> dict[str, Query]:
    """Every query in the form the SQL comparison expects."""

    def comparable(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # The tables hold times without a zone; the SQL takes them as they read.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return shown(query(spark, sf_dir))

        return run

    return {name: comparable(query) for name, query in REGISTERED.items()}
