"""Exact metrics against Spark's evaluators and selector, and against brute force."""

import math
import random

import pytest
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import UnivariateFeatureSelector, VectorAssembler
from pyspark.sql import functions as F

from tillwork.operators import metrics
from tillwork.plans import features, models


def test_roc_area_by_pairs(spark):
    r = random.Random(1)
    rows = [(r.randrange(20) / 10, float(r.random() < 0.3)) for _ in range(500)] + [(None, 1.0), (0.5, None)]
    pos, neg = ([s for s, y in rows if y == k and s is not None] for k in (1.0, 0.0))
    want = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / (len(pos) * len(neg))
    got = metrics.roc_area(spark.createDataFrame(rows, "s double, y double"), "s", "y").first()
    assert (got["positives"], got["negatives"]) == (len(pos), len(neg)) and got["area"] == pytest.approx(want, abs=1e-12)
    for few in ([], [(0.1, 1.0)]):
        one = metrics.roc_area(spark.createDataFrame(few, "s double, y double"), "s", "y").first()
        assert tuple(one) == (len(few), 0, None)


def test_root_mean_square(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0), (0.25, 0.25), (None, 1.0), (1.0, None)], "y double, p double")
    got = metrics.root_mean_square(df, "y", "p").first()
    assert got["n"] == 3 and got["mean_error"] == pytest.approx(-1 / 3) and got["rmse"] == pytest.approx(math.sqrt(5 / 3))
    assert tuple(metrics.root_mean_square(df.limit(0), "y", "p").first()) == (0, None, None)


def test_silhouette_equals_the_evaluator(spark):
    r = random.Random(2)
    rows = [(c, r.gauss(c, 1.0), r.gauss(-c, 0.7)) for c in range(4) for _ in range(40)] + [(9, 50.0, 50.0)]
    df = spark.createDataFrame(rows, "c int, x double, y double")
    placed = VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(df)
    want = ClusteringEvaluator(predictionCol="c").evaluate(placed)
    got = metrics.silhouette(df, "c", ["x", "y"]).first()
    assert (got["points"], got["clusters"]) == (161, 5) and got["silhouette"] == pytest.approx(want, abs=1e-4)
    assert metrics.silhouette(df.where("c = 1"), "c", ["x", "y"]).first()["silhouette"] is None


def test_feature_scores_choose_what_the_fitted_selector_chooses(star):
    table = models._training_table(star, "scores")
    scores = {x["feature"]: x for x in metrics.f_scores(table, "is_returned", models.RETURN_NUMBERS, models.LABELS, models.SELECTED).collect()}
    stages = features.vector_stages(models.LABELS, models.RETURN_NUMBERS, keep_invalid=False)
    from pyspark.ml import Pipeline
    vectors = Pipeline(stages=stages).fit(table).transform(table)
    selector = UnivariateFeatureSelector(featuresCol="features_scaled", outputCol="f", labelCol="is_returned", selectionMode="numTopFeatures")
    selector.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(models.SELECTED)
    names = features.slot_names(vectors)
    want = {names[i].replace("_ohe_", "=") for i in selector.fit(vectors).selectedFeatures}
    assert want == {n for n, x in scores.items() if x["chosen"]} and len(want) == 15
    assert set(scores) == {n.replace("_ohe_", "=") for n in names}


def test_vectors_are_explained_by_name(star, spark):
    table = features.vectors(features.return_input(features.item_features(star)), features.RETURN_LABELS, features.RETURN_NUMBERS)
    rows = features.explained(table, *features.KEYS)
    one = table.select("*").first()
    mine = {r["slot"]: r["value"] for r in rows.where(
        " AND ".join(f"{k} = {one[k]}" for k in features.KEYS) + "").collect()}
    assert {f"gender_ohe_{one['gender']}", f"category_ohe_{one['category']}", "sale_price"} <= set(mine)
    scale = table.agg(F.stddev_samp("sale_price")).first()[0]
    assert mine["sale_price"] == pytest.approx(one["sale_price"] / scale)


def test_estimates_are_judged(spark):
    df = spark.range(30000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("x"))
    df = df.withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    got = metrics.distinct_estimates(df, ["g"], "x").collect()
    assert len(got) == 3 and all(r["within_bound"] and r["relative_error"] <= 0.15 for r in got)
    strict = metrics.distinct_estimates(df, ["g"], "x", bound=0.0).collect()
    assert all(r["within_bound"] == (abs(r["estimate"] - r["exact"]) <= 1) for r in strict)


def test_labels_in_the_order_of_an_encoder(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), ("c", None), ("c", "y")], "p string, q string")
    got = [tuple(r) for r in metrics.label_order(df, ["p", "q"]).select("column", "label", "position", "count").orderBy("column", "position").collect()]
    assert got == [("p", "c", 0, 2), ("p", "a", 1, 1), ("p", "b", 2, 1), ("q", "x", 0, 2), ("q", "y", 1, 1)]
