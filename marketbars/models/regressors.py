"""Fit, compare and apply next-close regressors."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any, TypeVar

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import FeatureHasher, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import (
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketbars.config import Config, Model
from marketbars.models import boosting
from marketbars.operators import slices
from marketbars.operators.dataset import split_series, test_rows, train_rows
from marketbars.schema import training_columns
from marketbars.workspace import ensure_checkpoint_dir, shuffles_removed

Result = TypeVar("Result")
TICKER_INPUT = "ticker_index"  # fixed value: the model input that stands for the ticker

# With more indexed tickers boosted trees are grown by ``boosting``; they are the same trees.
MOST_CATEGORIES = 20_000


@dataclass(frozen=True)
class Evaluation:
    """Scores of all models, and the best one with its test predictions."""

    metrics: list[dict[str, Any]]
    best_name: str
    best_model: PipelineModel
    predictions: DataFrame


def feature_columns(config: Config) -> list[str]:
    features = config.features
    return training_columns(features.ma_windows, features.lag_days, features.rsi_window)


def training_frame(features: DataFrame, config: Config) -> DataFrame:
    """Split training rows of a feature table, lazily."""
    model, rows = config.model, config.features.rows_per_slice
    columns = (feature_columns(config), model.label_col, model.train_ratio)
    if rows is not None:
        return slices.split_series(features, *columns, rows)
    return split_series(features, *columns)


def fixed_layout(
    frame: DataFrame, partitions: int, checkpoint_dir: str | None = None
) -> DataFrame:
    """Spread rows evenly in a repeatable order and cut the lineage.

    Tree models sample and bin per partition, so equal partitions in equal order
    make equal models. Hashing ticker and day spreads even a single long series.
    The checkpoint survives lost executors and spares each fit the windows; it goes
    where the session says, or else to ``checkpoint_dir``. All columns of ``frame`` are
    shuffled and kept, so it should have no others than are read later.
    """
    spark = frame.sparkSession
    ensure_checkpoint_dir(spark, checkpoint_dir)
    keys = ("ticker", "trade_date")
    with shuffles_removed(spark):
        return frame.repartition(partitions, *keys).sortWithinPartitions(*keys).checkpoint()


def ticker_stage(train: DataFrame, model: Model) -> tuple[Transformer | Estimator, int]:
    """Stage that turns the ticker into a number, and the tree bins it needs.

    The setting alone decides, never the data. ``index`` ranks the tickers of the
    train rows by frequency; ticker and rank sit on the driver, tickers never seen
    share one extra rank, and trees need a bin for each. ``hash`` reads a 64-bit
    hash as a plain number: nothing grows with the number of tickers. ``sparse``
    spreads tickers over ``ticker_buckets`` inputs of 0 or 1, so a linear model has a
    level for each bucket; it knows no label and no other row, so nothing leaks.
    """
    if model.ticker_encoding == "sparse":
        hasher = FeatureHasher(
            inputCols=["ticker"], outputCol=TICKER_INPUT, numFeatures=model.ticker_buckets
        )
        return hasher, model.max_bins
    if model.ticker_encoding == "hash":
        statement = (
            f"SELECT *, CAST(xxhash64(ticker) AS DOUBLE) AS {TICKER_INPUT} FROM __THIS__"
        )
        return SQLTransformer(statement=statement), model.max_bins
    if model.ticker_encoding != "index":
        raise ValueError(f"unknown ticker encoding {model.ticker_encoding}")
    known = train.agg(F.count_distinct("ticker")).first()[0]
    indexer = StringIndexer(
        inputCol="ticker", outputCol=TICKER_INPUT, handleInvalid="keep"
    )
    return indexer, max(model.max_bins, known + 1)


def build_estimators(model: Model, max_bins: int | None = None) -> dict[str, Estimator]:
    """The candidate regressors in training order."""
    common = {"featuresCol": "features", "labelCol": model.label_col}
    trees = {**common, "seed": model.random_seed, "maxBins": max_bins or model.max_bins}
    return {
        "linear_regression": LinearRegression(**common),
        "random_forest": RandomForestRegressor(
            numTrees=model.random_forest.num_trees,
            maxDepth=model.random_forest.max_depth,
            **trees,
        ),
        "gbt_regressor": GBTRegressor(
            maxIter=model.gbt.max_iter, maxDepth=model.gbt.max_depth, **trees
        ),
    }


def fit_pipeline(name: str, train: DataFrame, config: Config) -> PipelineModel:
    """Fit one named candidate on train rows."""
    return _fit_all({name}, train, config)[name]


def _fit_all(
    names: set[str] | None, train: DataFrame, config: Config
) -> dict[str, PipelineModel]:
    stage, max_bins = ticker_stage(train, config.model)
    assembler = VectorAssembler(
        inputCols=[*feature_columns(config), TICKER_INPUT],
        outputCol="features",
        handleInvalid="skip",
    )
    # The front stages are the same for every candidate: fit them once.
    front = Pipeline(stages=[stage, assembler]).fit(train)
    assembled = front.transform(train)
    estimators = build_estimators(config.model, max_bins)
    inputs = assembler.getInputCols()

    def fit(estimator: Estimator) -> Transformer:
        if isinstance(estimator, GBTRegressor) and max_bins > MOST_CATEGORIES:
            return boosting.fit(estimator, assembled, inputs)
        return estimator.fit(assembled)

    fits = {
        name: functools.partial(fit, estimator)
        for name, estimator in estimators.items()
        if names is None or name in names
    }
    fitted = at_once(train.sparkSession, fits, config.model.fits_at_once)
    return {name: PipelineModel(stages=[*front.stages, fitted[name]]) for name in fits}


def at_once(
    spark: SparkSession, work: Mapping[str, Callable[[], Result]], threads: int
) -> dict[str, Result]:
    """Results of independent jobs that share the cluster, by name.

    Each runs in a thread, job group and scheduler pool of its own; with the scheduler in
    FAIR mode none waits for another's tasks. The first error is raised.
    """
    if threads < 2 or len(work) < 2:
        return {name: job() for name, job in work.items()}

    def grouped(name: str, job: Callable[[], Result]) -> Callable[[], Result]:
        def run() -> Result:
            spark.sparkContext.setJobGroup(f"fit-{name}", f"fit {name}")
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
            return job()

        return inheritable_thread_target(spark)(run)

    with ThreadPoolExecutor(max_workers=threads) as pool:
        running = {name: pool.submit(grouped(name, job)) for name, job in work.items()}
        return {name: future.result() for name, future in running.items()}


def rmse_evaluator(label_col: str) -> RegressionEvaluator:
    return RegressionEvaluator(
        labelCol=label_col, predictionCol="prediction", metricName="rmse"
    )


def pick_best(scores: Mapping[str, float]) -> str:
    """Name of the lowest score; the first of equals, and never a NaN."""
    usable = {name: score for name, score in scores.items() if not math.isnan(score)}
    if not usable:
        raise RuntimeError("no model produced a usable score")
    return min(usable, key=usable.__getitem__)


def evaluate_models(config: Config, features: DataFrame) -> Evaluation:
    """Fit every candidate on train rows and compare them on test rows."""
    frame = fixed_layout(
        training_frame(features, config),
        config.model.fit_partitions,
        config.path("checkpoint_path"),
    )
    train, test = train_rows(frame), test_rows(frame)
    if train.isEmpty() or test.isEmpty():
        raise ValueError("training needs rows on both sides of the split")

    evaluator = rmse_evaluator(config.model.label_col)
    models = _fit_all(None, train, config)
    predictions = {name: model.transform(test) for name, model in models.items()}
    scores = at_once(
        features.sparkSession,
        {
            name: lambda rows=rows: float(evaluator.evaluate(rows))
            for name, rows in predictions.items()
        },
        config.model.fits_at_once,
    )
    best = pick_best(scores)
    metrics = [{"model_name": name, "rmse": score} for name, score in scores.items()]
    return Evaluation(metrics, best, models[best], predictions[best])


def prediction_export(
    predictions: DataFrame, label_col: str, model_name: str, predicted_at: str
) -> DataFrame:
    """Predictions in their stored form.

    ``actual_close`` is the label: the close of the bar *after* ``trade_date``.
    """
    return predictions.select(
        "ticker",
        "trade_date",
        "prediction",
        F.col(label_col).alias("actual_close"),
        F.lit(model_name).alias("model_name"),
        F.lit(predicted_at).cast("timestamp").alias("predicted_at"),
    )


def score_saved_model(path: str, df: DataFrame) -> DataFrame:
    """Apply a saved pipeline to feature rows."""
    return PipelineModel.load(path).transform(df)
