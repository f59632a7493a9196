from __future__ import annotations

import dataclasses
import math

import numpy as np
import pytest
from helpers import clean_bars, shuffle_bytes, shuffles_left

from marketbars.checks.inputs import supplier_features, with_features
from marketbars.checks.queries import REGISTERED, SMALL
from marketbars.config import Gbt, Model, RandomForest
from marketbars.models import regressors
from marketbars.operators.dataset import test_rows as held_out
from marketbars.operators.dataset import train_rows
from marketbars.operators.serve import rmse


def tiny(**model):
    values = {
        "random_forest": RandomForest(num_trees=3, max_depth=3),
        "gbt": Gbt(max_iter=2, max_depth=2),
        "fit_partitions": 4,
        **model,
    }
    return dataclasses.replace(SMALL, model=Model(**values))


@pytest.fixture(scope="module")
def features(spark, sf_dir):
    rows = supplier_features(spark, sf_dir).cache()
    yield rows
    rows.unpersist(blocking=True)


def test_best_model_has_the_lowest_score(features):
    result = regressors.evaluate_models(tiny(), features)
    scores = {m["model_name"]: m["rmse"] for m in result.metrics}
    assert list(scores) == ["linear_regression", "random_forest", "gbt_regressor"]
    assert all(math.isfinite(score) for score in scores.values())
    assert scores[result.best_name] == min(scores.values())
    export = regressors.prediction_export(
        result.predictions, "target_close", result.best_name, "2024-01-01"
    )
    assert rmse(export).first().rmse == pytest.approx(scores[result.best_name])


def test_fits_are_repeatable(features):
    def scores(frame):
        return [m["rmse"] for m in regressors.evaluate_models(tiny(), frame).metrics]

    shuffled = features.orderBy("volume").repartition(5)
    assert scores(features) == pytest.approx(scores(shuffled), rel=1e-9)


def test_linear_regression_against_least_squares(features):
    config = tiny()
    frame = regressors.fixed_layout(regressors.training_frame(features, config), 4)
    model = regressors.fit_pipeline("linear_regression", train_rows(frame), config)
    columns = [*regressors.feature_columns(config), "ticker_index"]
    front = type(model)(stages=model.stages[:2])

    def arrays(rows):
        pdf = front.transform(rows).select(*columns, "target_close", "ticker", "trade_date")
        pdf = pdf.orderBy("ticker", "trade_date").toPandas()
        inputs = pdf[columns].to_numpy(float)
        return np.c_[inputs, np.ones(len(pdf))], pdf["target_close"].to_numpy(float)

    inputs, label = arrays(train_rows(frame))
    weights, *_ = np.linalg.lstsq(inputs, label, rcond=None)
    held, _ = arrays(held_out(frame))
    got = model.transform(held_out(frame)).orderBy("ticker", "trade_date").toPandas()
    assert np.allclose(got["prediction"], held @ weights, rtol=1e-4)


def test_saved_model_gives_the_same_predictions(features, tmp_path):
    config, path = tiny(), str(tmp_path / "model")
    frame = regressors.fixed_layout(regressors.training_frame(features, config), 4)
    model = regressors.fit_pipeline("random_forest", train_rows(frame), config)
    model.write().overwrite().save(path)
    columns = ("ticker", "trade_date", "prediction")
    fresh = model.transform(held_out(frame)).select(*columns)
    loaded = regressors.score_saved_model(path, held_out(frame)).select(*columns)
    assert fresh.exceptAll(loaded).isEmpty() and loaded.exceptAll(fresh).isEmpty()


def many_tickers(spark, count):
    closes = [10 + (n * 7) % 5 for n in range(12)]
    series = {f"T{n:03d}": [close + n for close in closes] for n in range(count)}
    return with_features(clean_bars(spark, series))


def test_more_tickers_than_default_tree_bins(spark):
    result = regressors.evaluate_models(tiny(), many_tickers(spark, 40))
    assert all(math.isfinite(m["rmse"]) for m in result.metrics)


def test_the_setting_alone_decides_between_index_and_hash(spark):
    many = regressors.training_frame(many_tickers(spark, 1500), tiny())
    stage, bins = regressors.ticker_stage(train_rows(many), Model())
    assert bins == 1501
    indexed = stage.fit(train_rows(many)).transform(many)
    assert indexed.select("ticker_index").distinct().count() == 1500
    with pytest.raises(ValueError, match="encoding"):
        regressors.ticker_stage(many, Model(ticker_encoding="none"))


def test_a_hashed_ticker_is_a_plain_number(spark):
    config = tiny(ticker_encoding="hash")
    result = regressors.evaluate_models(config, many_tickers(spark, 40))
    assert type(result.best_model.stages[0]).__name__ == "SQLTransformer"
    scored = result.best_model.transform(many_tickers(spark, 41))
    assert scored.select("ticker_index").distinct().count() == 41


def test_ticker_seen_in_test_only_gets_the_extra_slot(spark):
    # Five bars leave one training row, and floor(0.8) puts it on the test side.
    features = with_features(clean_bars(spark, {"A": range(1, 40), "B": range(1, 6)}))
    frame = regressors.fixed_layout(regressors.training_frame(features, tiny()), 4)
    stage, bins = regressors.ticker_stage(train_rows(frame), Model())
    rows = stage.fit(train_rows(frame)).transform(held_out(frame))
    assert {(r.ticker, r.ticker_index) for r in rows.collect()} == {("A", 0.0), ("B", 1.0)}
    assert bins == 32


def test_an_empty_side_is_an_error(spark):
    features = with_features(clean_bars(spark, {"A": range(1, 6)}))
    with pytest.raises(ValueError, match="both sides"):
        regressors.evaluate_models(tiny(), features)


def test_best_is_first_of_equals_and_never_nan():
    assert regressors.pick_best({"a": 2.0, "b": 1.0, "c": 1.0}) == "b"
    assert regressors.pick_best({"a": float("nan"), "b": 1.0}) == "b"
    with pytest.raises(RuntimeError):
        regressors.pick_best({"a": float("nan")})


def test_default_model_sizes():
    forest, gbt = (
        regressors.build_estimators(Model())[name] for name in ("random_forest", "gbt_regressor")
    )
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSeed()) == (150, 8, 42)
    assert (gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getSeed()) == (120, 5, 42)


def test_a_layout_leaves_no_shuffles_on_disk(features):
    spark, frame = features.sparkSession, regressors.training_frame(features, tiny())
    assert features.count()  # in the cache now
    before = shuffle_bytes(spark)
    laid = regressors.fixed_layout(frame, 4)
    assert shuffles_left(spark, before, 1_000) < 1_000
    assert laid.rdd.getNumPartitions() == 4 and laid.count() == frame.count()


def test_the_index_keeps_no_columns_that_it_does_not_read(spark, sf_dir, monkeypatch):
    laid, kept = regressors.fixed_layout, []

    def layout(frame, *rest):
        kept.append(frame.columns)
        return laid(frame, *rest)

    monkeypatch.setattr(regressors, "fixed_layout", layout)
    rows = REGISTERED["ticker_index"](spark, sf_dir)
    assert kept == [["ticker", "trade_date", "dataset_split"]]
    assert rows.columns == [*kept[0], "ticker_index"] and not rows.isEmpty()
