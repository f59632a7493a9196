"""Tree models against a tree that is grown by trying every split."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from marketbars.checks.inputs import customer_features, supplier_features
from marketbars.checks.queries import SMALL
from marketbars.config import Config, Gbt, Model, RandomForest
from marketbars.models import regressors
from marketbars.operators.dataset import test_rows as held_out
from marketbars.operators.dataset import train_rows

RNG = np.random.default_rng(3)
X = np.column_stack([RNG.integers(0, 12, 80), RNG.integers(0, 20, 80), RNG.normal(size=80).round(1)])
Y = X[:, 0] * 3 + (X[:, 1] > 9) * 7 + RNG.normal(size=80)


def grow(x, y, depth):
    """(feature, threshold, left, right), or the mean of a leaf."""
    best = (1e-12, None, None)
    for feature in range(x.shape[1]) if depth else ():
        values = np.unique(x[:, feature])
        for threshold in (values[1:] + values[:-1]) / 2:
            left = x[:, feature] <= threshold
            gain = y.var() - (left.sum() * y[left].var() + (~left).sum() * y[~left].var()) / len(y)
            if gain > best[0] + 1e-12:
                best = (gain, feature, threshold)
    _, feature, threshold = best
    if feature is None:
        return y.mean()
    left = x[:, feature] <= threshold
    return feature, threshold, grow(x[left], y[left], depth - 1), grow(x[~left], y[~left], depth - 1)


def value(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def predictions(tree):
    return np.array([value(tree, row) for row in X])


def same_tree(node, tree):
    """An MLlib node has the split or the mean of the grown one, and so have its children."""
    if not isinstance(tree, tuple):
        return node.subtreeDepth() == 0 and node.prediction() == pytest.approx(tree)
    split = node.split()
    return (
        (split.featureIndex(), split.threshold()) == pytest.approx(tree[:2])
        and same_tree(node.leftChild(), tree[2])
        and same_tree(node.rightChild(), tree[3])
    )


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(Vectors.dense(x), float(y)) for x, y in zip(X, Y)]
    return spark.createDataFrame(rows, ["features", "target_close"])


def predicted(model, frame):
    return np.array([r.prediction for r in model.transform(frame).select("prediction").collect()])


@pytest.mark.parametrize("depth", [1, 3])
def test_forest_tree_has_the_best_splits(frame, depth):
    settings = Model(random_forest=RandomForest(num_trees=1, max_depth=depth), max_bins=128)
    forest = regressors.build_estimators(settings)["random_forest"].setBootstrap(False).fit(frame)
    tree = grow(X, Y, depth)
    assert same_tree(forest.trees[0]._java_obj.rootNode(), tree)
    assert predicted(forest, frame) == pytest.approx(predictions(tree))


@pytest.mark.parametrize("rounds", [1, 4])
def test_boosting_adds_trees_on_what_is_left(frame, rounds):
    settings = Model(gbt=Gbt(max_iter=rounds, max_depth=2), max_bins=128)
    model = regressors.build_estimators(settings)["gbt_regressor"].fit(frame)
    total = np.zeros(len(Y))
    for k, boosted in enumerate(model.trees):
        # the slope of the squared error is twice what is left; all but the first count a tenth
        tree = grow(X, Y if k == 0 else 2 * (Y - total), 2)
        # splits of equal gain may differ in their threshold, not in what they part
        assert predicted(boosted, frame) == pytest.approx(predictions(tree))
        total += predictions(tree) * (1 if k == 0 else 0.1)
    assert predicted(model, frame) == pytest.approx(total)


def test_sizes_are_the_configured_ones():
    made = regressors.build_estimators(Config().model)
    forest, boosted = made["random_forest"], made["gbt_regressor"]
    assert (forest.getNumTrees(), forest.getMaxDepth()) == (150, 8)
    assert (boosted.getMaxIter(), boosted.getMaxDepth()) == (120, 5)


def settings(**model):
    small = {"random_forest": RandomForest(3, 3), "gbt": Gbt(2, 2), "fit_partitions": 4}
    return Config(model=Model(**small | model))


def test_fits_at_once_are_the_fits_one_by_one(spark, sf_dir):
    rows = supplier_features(spark, sf_dir).checkpoint()
    one = regressors.evaluate_models(settings(fits_at_once=1), rows)
    three = regressors.evaluate_models(settings(fits_at_once=3), rows)
    assert [m["model_name"] for m in three.metrics] == [m["model_name"] for m in one.metrics]
    assert [m["rmse"] for m in three.metrics] == pytest.approx(
        [m["rmse"] for m in one.metrics], rel=1e-9
    )
    assert three.best_name == one.best_name
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_an_error_in_one_of_many_is_raised(spark):
    def broken():
        raise ValueError("no")

    with pytest.raises(ValueError):
        regressors.at_once(spark, {"a": lambda: 1, "b": broken}, 2)


def test_sparse_tickers_carry_levels_and_no_labels(spark, sf_dir):
    levels = customer_features(spark, sf_dir).selectExpr(
        "* EXCEPT (target_close)", "double(crc32(binary(ticker)) % 7) AS target_close"
    )

    def error(encoding):
        config = settings(ticker_encoding=encoding, ticker_buckets=4096)
        frame = regressors.fixed_layout(regressors.training_frame(levels, config), 4)
        model = regressors.fit_pipeline("linear_regression", train_rows(frame), config)
        scored = model.transform(train_rows(frame))
        return regressors.rmse_evaluator("target_close").evaluate(scored), model

    (sparse, model), (hashed, _) = error("sparse"), error("hash")
    assert sparse < 0.5 * hashed
    assert model.stages[-1].numFeatures == len(regressors.feature_columns(SMALL)) + 4096
    # the inputs of a row are the same whatever the labels are
    frame = regressors.training_frame(levels, settings(ticker_encoding="sparse"))
    stage, bins = regressors.ticker_stage(frame, Model(ticker_encoding="sparse"))
    flipped = held_out(frame).selectExpr("* EXCEPT (target_close)", "-target_close AS target_close")
    one, two = (stage.transform(rows).select("ticker", "trade_date", "ticker_index")
                for rows in (held_out(frame), flipped))
    assert bins == Model().max_bins and one.exceptAll(two).isEmpty() and not one.isEmpty()
