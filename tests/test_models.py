"""Models: invariants on small, seeded fits."""

import math
import re

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tillwork.operators import bins
from tillwork.plans import features, models


def test_split_is_stable_and_complete(star):
    items = star.items("order_id", "product_id", "sale_price")
    keys = ["order_id", "product_id", "sale_price"]
    train, test = models.split(items, keys)
    again, _ = models.split(items.repartition(7), keys)
    assert train.count() + test.count() == items.count()
    assert train.count() == again.count()
    assert 0.7 < train.count() / items.count() < 0.9


def test_class_weights(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (0.0,), (0.0,)], "y double")
    got = {tuple(r) for r in df.withColumn("w", models.class_weights(df, "y")).collect()}
    assert got == {(1.0, 3.0), (0.0, 1.0)}
    none = df.filter("y = 0")
    assert {r[1] for r in none.withColumn("w", models.class_weights(none, "y")).collect()} == {1.0}


def test_roc_points_equal_brute_force(spark):
    scored = [(float(i * i % 7 < 3), (i * 37 % 1500) / 1500) for i in range(3000)]
    df = spark.createDataFrame(scored, "is_returned double, score double")
    got = [tuple(r) for r in models.roc_points(df).collect()]
    assert len(got) == 1500
    positives = sum(y for y, _ in scored)
    for threshold, fpr, tpr in got[::50]:
        above = [y for y, s in scored if s >= threshold]
        assert tpr == pytest.approx(sum(above) / positives)
        assert fpr == pytest.approx((len(above) - sum(above)) / (3000 - positives))
    assert got[-1][1:] == (1.0, 1.0)


def test_return_prediction(star):
    fitted = models.predict_returns(star, trees=5, depth=4)
    assert 0.0 <= fitted.metric <= 1.0
    points = [tuple(r)[1:] for r in models.roc_points(fitted.predictions).collect()]
    assert points == sorted(points) and points[-1] == (1.0, 1.0)
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip([(0.0, 0.0), *points], points))
    assert area == pytest.approx(fitted.metric, abs=1e-6)


def test_return_prediction_in_an_observed_session(spark, star, tmp_path):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(str(tmp_path / "observed"))
    assert seen.get["n"] == 3
    fitted = models.predict_returns(star, trees=2, depth=2)
    assert fitted.predictions.where("score between 0 and 1").count() > 0


def test_clusters(star):
    fitted = models.cluster_customers(star)
    sizes = {r["cluster"]: r["count"] for r in fitted.predictions.groupBy("cluster").count().collect()}
    assert len(sizes) == 4 and set(sizes) == {0, 1, 2, 3}
    assert sum(sizes.values()) == star.items("user_id").distinct().count()
    assert -1 <= fitted.metric <= 1


def test_prices_beat_the_mean(star):
    fitted = models.predict_prices(star, depth=3)
    spread = fitted.predictions.agg(F.stddev_pop("sale_price").cast("double")).first()[0]
    assert 0 < fitted.metric < spread


def test_boosted_trees_of_cells_are_those_of_their_rows(spark):
    rows = spark.createDataFrame([(float(i % 5), float(i * 7 % 11), float(i * 31 % 97 + i % 5 * i % 11)) for i in range(2000)],
                                 "x double, y double, price double")
    cells = bins.as_cells(rows, ["x", "y"], "price")
    assert (cells.count(), cells.agg(F.sum("weight")).first()[0]) == (55, 2000.0)
    stages = [VectorAssembler(inputCols=["x", "y"], outputCol="features"),
              GBTRegressor(labelCol="price", maxDepth=4, maxIter=5, seed=1)]
    of_rows = Pipeline(stages=stages).fit(rows)
    stages[1].setWeightCol("weight")
    of_cells = Pipeline(stages=stages).fit(cells)
    for a, b in zip(of_rows.transform(cells.orderBy("x", "y")).collect(), of_cells.transform(cells.orderBy("x", "y")).collect()):
        assert a["prediction"] == pytest.approx(b["prediction"])


@pytest.mark.parametrize("count", [7, 32, 33, 400])
def test_thresholds_are_those_of_a_tree_learner(spark, count):
    values = [math.sqrt(i * i * 37 % 1009 % count) for i in range(900)]
    rows = spark.createDataFrame([(v, v + (k % 7) ** 3) for k, v in enumerate(values)], "x double, price double")
    tree = DecisionTreeRegressor(labelCol="price", maxDepth=12, seed=1).fit(
        VectorAssembler(inputCols=["x"], outputCol="features").transform(rows))
    used = {float(t) for t in re.findall(r"feature 0 <= ([-0-9.E]+)", tree.toDebugString)}
    assert used and used <= set(bins.thresholds(values)) and len(bins.thresholds(values)) <= 31


def test_bins_put_rows_where_a_tree_does(spark):
    rows = spark.createDataFrame([(i, float(i % 3), 1.0) for i in range(30)], "id long, x double, y double")
    found = bins.tree_bins(rows, ["x", "y"], ["id"], 1)
    assert found.getOutputCols() == ["x_bin", "y_bin"]
    at = spark.createDataFrame([(v, 5.0) for v in (-9.0, 0.5, 0.5000001, 1.5, 7.0)], "x double, y double")
    assert [tuple(r) for r in found.transform(at).select("x_bin", "y_bin").collect()] == [(0, 0), (0, 0), (1, 0), (1, 0), (2, 0)]


def test_price_model_takes_new_items(star):
    fitted = models.predict_prices(star, leak_free=True, depth=2)
    again = fitted.model.transform(models._training_table(star, "again", ["order_id"]))
    joined = again.join(fitted.predictions.withColumnRenamed("prediction", "was"), [*features.KEYS, "sale_price"])
    assert joined.count() >= fitted.predictions.count() > 0
    assert joined.where("prediction <> was").count() == 0


def test_unseen_label_gets_its_own_index(spark):
    train = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "c string, x double")
    test = spark.createDataFrame([("z", 1.0)], "c string, x double")
    from pyspark.ml import Pipeline
    model = Pipeline(stages=features.vector_stages(["c"], ["x"])).fit(train)
    assert model.transform(test).first()["c_idx"] == 2.0


def test_rfm_features(spark, star):
    got = features.rfm_features(features.item_features(star))
    assert got.agg(F.min("recency")).first()[0] == 0
    assert got.filter("frequency < 1").count() == 0
