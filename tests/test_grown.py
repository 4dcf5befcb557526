"""Forests grown level by level against Spark's own trees."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import (
    DecisionTreeClassifier, RandomForestClassificationModel, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tillwork.operators import bins, grown

WEIGHTS = [1.0, 1.7]


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(3)
    found = []
    for i in range(4000):
        x, y, z = round(draw.gauss(0, 1), 3), float(draw.randrange(5)), draw.random()
        found.append((i, x, y, z, float(draw.random() < 0.2 + 0.5 * (x > 0.3) * (y < 3) + 0.2 * (z > 0.7))))
    df = spark.createDataFrame(found, "id long, x double, y double, z double, label double")
    weight = F.when(F.col("label") == 1, WEIGHTS[1]).otherwise(WEIGHTS[0])
    return VectorAssembler(inputCols=["x", "y", "z"], outputCol="features").transform(df).withColumn("w", weight).repartition(5)


@pytest.fixture(scope="module")
def cuts(rows):
    seen = bins.seen(rows, ["x", "y", "z", "w"], ["id"], 1)
    return [bins.thresholds([r[c] for r in seen], [r["w"] for r in seen]) for c in ("x", "y", "z")]


@pytest.fixture(scope="module")
def binned(rows, cuts):
    return grown.binned_rows(rows, cuts, "label")


def test_a_tree_of_all_rows_and_features_is_spark_s(rows, cuts, binned, tmp_path):
    tree = DecisionTreeClassifier(maxDepth=6, weightCol="w", seed=1).fit(rows)
    tree.write().save(str(tmp_path / "tree"))
    theirs = rows.sparkSession.read.parquet(str(tmp_path / "tree/data")).orderBy("id").collect()
    grown_tree, = grown.grow(binned, cuts, 1, 6, WEIGHTS, 1, tried=3, bootstrap=False)
    ours = grown.node_rows(grown_tree, cuts, WEIGHTS)
    assert len(ours) == tree.numNodes == len(theirs) > 20
    for a, b in zip(ours, theirs):
        assert (a[0], a[1], a[4], a[6], a[7]) == (b["id"], b["prediction"], b["rawCount"], b["leftChild"], b["rightChild"])
        assert a[3] == pytest.approx(b["impurityStats"]) and a[5] == pytest.approx(b["gain"])
        assert a[8][0] == b["split"]["featureIndex"] and a[8][1] == pytest.approx(b["split"]["leftCategoriesOrThreshold"])


def test_a_forest_does_not_depend_on_partitions(cuts, binned):
    one = grown.grow(binned, cuts, 4, 4, WEIGHTS, 7)
    other = grown.grow(binned.repartition(3), cuts, 4, 4, WEIGHTS, 7)
    trees = [[grown.node_rows(t, cuts, WEIGHTS) for t in forest] for forest in (one, other)]
    assert trees[0] == trees[1]
    assert len({str(t) for t in trees[0]}) == 4


def test_a_forest_is_as_good_as_spark_s(rows, tmp_path):
    estimator = RandomForestClassifier(numTrees=30, maxDepth=5, weightCol="w", seed=1)
    train, test = rows.where("id % 4 > 0"), rows.where("id % 4 = 0")
    ours = grown.fit_forest(estimator, train, ["id"], WEIGHTS)
    # Read back, Spark's model has no training summary, which cannot be sent from an observed session.
    estimator.fit(train).write().save(str(tmp_path / "theirs"))
    theirs = RandomForestClassificationModel.load(str(tmp_path / "theirs"))
    assert (ours.getNumTrees, ours.numFeatures, ours.numClasses) == (30, 3, 2)
    area, expected = (BinaryClassificationEvaluator().evaluate(m.transform(test)) for m in (ours, theirs))
    assert area == pytest.approx(expected, abs=0.02) and area > 0.7


def test_copies_are_a_poisson_sample():
    numbers = np.random.default_rng(1).integers(0, 2**64, 200_000, dtype="uint64")
    a, b = (grown.copies(numbers, t).astype(float) for t in (0, 1))
    assert [round(float(v), 1) for v in (a.mean(), a.var(), b.mean(), b.var())] == [1.0] * 4
    assert (a == 0).mean() == pytest.approx(np.exp(-1), abs=0.005)
    assert abs(np.corrcoef(a, b)[0, 1]) < 0.01


def test_one_class_is_one_leaf(rows, cuts):
    binned = grown.binned_rows(rows.where("label = 0"), cuts, "label")
    tree, = grown.grow(binned, cuts, 1, 3, [1.0, 1.0], 1)
    assert [(n[1], n[6]) for n in grown.node_rows(tree, cuts, [1.0, 1.0])] == [(0.0, -1)]
