"""Boosted trees that Spark and NumPy grow are those that MLlib grows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor

from marketbars.checks.queries import SMALL
from marketbars.config import Gbt, Model
from marketbars.models import boosting, regressors
from marketbars.operators.dataset import TEST, TRAIN
from marketbars.schema import training_columns


def assembled(spark, rows, tickers, inputs=("a", "b", "c", "k")):
    frame = spark.range(0, rows, 1, 3).selectExpr(
        "double(crc32(binary(string(id))) % 997 - 300) AS a",
        "double(greatest(0, crc32(binary(string(id + 7))) % 50 - 25)) AS b",
        "3.0D AS c",
        f"string(crc32(binary(string(id * 3))) % {tickers}) AS t",
    ).selectExpr("*", "abs(a) / 10 + 7 * b + (hash(t) % 13) * 5 + (hash(a, b) % 100) / 9 AS y")
    index = StringIndexer(inputCol="t", outputCol="k", handleInvalid="keep")
    assembler = VectorAssembler(inputCols=list(inputs), outputCol="features")
    return Pipeline(stages=[index, assembler]).fit(frame).transform(frame)


def trees(model):
    """Splits and leaves from top to bottom."""

    def of(node):
        if node.subtreeDepth() == 0:
            return [round(node.prediction(), 6)]
        split = node.split()
        kind = split.getClass().getSimpleName()
        how = split.threshold() if kind == "ContinuousSplit" else sorted(split.leftCategories())
        return [split.featureIndex(), how, *of(node.leftChild()), *of(node.rightChild())]

    return [of(tree._java_obj.rootNode()) for tree in model.trees]


# all rows decide the bins; of some inputs fewer values are left than bins; a sample decides
@pytest.mark.parametrize(("rows", "tickers", "bins"), [(2_000, 30, 40), (900, 300, 1200), (14_000, 6, 8)])
def test_trees_are_those_of_mllib(spark, tmp_path, rows, tickers, bins):
    frame = assembled(spark, rows, tickers)
    estimator = GBTRegressor(labelCol="y", maxIter=3, maxDepth=3, maxBins=bins, seed=5)
    own, wanted = boosting.fit(estimator, frame, ["a", "b", "c", "k"]), estimator.fit(frame)
    assert trees(own) == trees(wanted)
    assert own.treeWeights == wanted.treeWeights and own.numFeatures == 4
    assert own.getLabelCol() == "y" and own.getMaxIter() == 3
    own.write().overwrite().save(str(tmp_path / "model"))
    again = type(own).load(str(tmp_path / "model"))
    said = [
        np.array([r.prediction for r in m.transform(frame).select("prediction").collect()])
        for m in (own, again, wanted)
    ]
    assert np.allclose(said[0], said[2]) and (said[0] == said[1]).all()


def test_labels_that_do_not_differ_give_a_leaf(spark):
    frame = assembled(spark, 50, 3).drop("y").selectExpr("*", "4.0D AS y")
    estimator = GBTRegressor(labelCol="y", maxIter=2, maxDepth=2)
    own = boosting.fit(estimator, frame, ["a", "b", "c", "k"])
    assert trees(own) == trees(estimator.fit(frame)) == [[4.0], [0.0]]


def test_very_many_tickers_are_not_searched_by_mllib(spark, monkeypatch):
    columns = training_columns((10, 20), (1, 2, 3), 14)
    frame = spark.range(400).selectExpr(
        "concat('T', id % 40) AS ticker", "date_add(DATE'2024-01-01', int(id)) AS trade_date",
        *(f"double(hash(id, {k}) % 90) AS {name}" for k, name in enumerate(columns)),
        "double(hash(id % 40) % 50 + id % 7) AS target_close",
        f"if(id < 320, '{TRAIN}', '{TEST}') AS dataset_split",
    )
    config = type(SMALL)(model=Model(gbt=Gbt(max_iter=3, max_depth=2), fit_partitions=2))
    train = regressors.train_rows(regressors.fixed_layout(frame, 2))
    wanted = regressors.fit_pipeline("gbt_regressor", train, config)
    monkeypatch.setattr(regressors, "MOST_CATEGORIES", 20)
    monkeypatch.setattr(GBTRegressor, "_fit", lambda *_: pytest.fail("searched by MLlib"))
    own = regressors.fit_pipeline("gbt_regressor", train, config)
    assert trees(own.stages[-1]) == trees(wanted.stages[-1])
