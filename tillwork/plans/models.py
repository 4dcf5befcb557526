"""Return prediction, customer clusters and price prediction."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator, ClusteringEvaluator, RegressionEvaluator)
from pyspark.ml.feature import SQLTransformer, StandardScaler, UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions.columns import RETURNED, discount_rate, flag, ratio
from tillwork.operators.bins import as_cells, tree_bins
from tillwork.operators.distribution import in_share
from tillwork.operators.grown import fit_forest
from tillwork.operators.ranking import with_running_sums
from tillwork.plans.features import KEYS, REQUIRED, item_master, rfm_features, rfm_stages, vector_stages
from tillwork.session import written, written_evenly
from tillwork.sources.shop import Shop

# --- Fixed values -------------------------------------------------------------------
SEED = 42
TRAIN_PERCENT = 80
TREES, TREE_DEPTH, SELECTED = 50, 10, 15
CLUSTERS = 4
BOOST_DEPTH = 5
LABELS = ["gender", "category", "traffic_source"]
RETURN_NUMBERS = ["sale_price", "retail_price", "cost", "age", "discount_rate", "price_gap"]
PRICE_NUMBERS = ["retail_price", "cost", "age", "discount_rate"]
# The discount rate with the retail price gives the sale price away.
PRICE_NUMBERS_LEAK_FREE = ["retail_price", "cost", "age"]
# ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Fitted:
    """A fitted pipeline, its result on held-out rows, and its quality."""
    model: PipelineModel
    predictions: DataFrame
    metric: float


def split(df: DataFrame, keys: Sequence[str], percent: int = TRAIN_PERCENT) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the row: the same on every run and every retry."""
    train = in_share(10 * percent, *keys)
    return df.filter(train), df.filter(~train)


def class_weights(train: DataFrame, label: str) -> Column:
    """Positives weigh negatives / positives, negatives 1; without positives all weigh 1."""
    positives = F.sum(F.col(label))
    balance = train.agg(ratio(F.count(F.lit(1)) - positives, positives)).scalar()
    return F.when(F.col(label) == 1, F.coalesce(balance, F.lit(1.0))).otherwise(F.lit(1.0))


def _training_table(shop: Shop, name: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Complete items, and ``in_train``: the choice that :func:`split` makes by ``keys``, made once."""
    retail, sale, cost = (F.col(c) for c in ("retail_price", "sale_price", "cost"))
    table = item_master(shop).dropna(subset=REQUIRED).withColumns({
        "is_returned": flag(F.col("order_status") == RETURNED).cast("double"),
        "discount_rate": discount_rate(retail, sale), "price_gap": retail - cost})
    table = table.withColumn("in_train", in_share(10 * TRAIN_PERCENT, *keys))
    return written_evenly(table.select(*KEYS, *REQUIRED, "is_returned", "discount_rate", "price_gap", "in_train"), name, *KEYS)


def predict_returns(shop: Shop, trees: int = TREES, depth: int = TREE_DEPTH) -> Fitted:
    """Random forest on balanced classes; the metric is the area under the ROC curve."""
    table = _training_table(shop, "returns", [*KEYS, "sale_price", "is_returned"])
    train, test = table.filter("in_train"), table.filter(~F.col("in_train"))
    train = train.withColumn("class_weight", class_weights(train, "is_returned"))
    selector = UnivariateFeatureSelector(
        featuresCol="features_scaled", outputCol="features", labelCol="is_returned",
        selectionMode="numTopFeatures")
    selector.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(SELECTED)
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="is_returned", weightCol="class_weight",
        numTrees=trees, maxDepth=depth, seed=SEED)
    stages = Pipeline(stages=[*vector_stages(LABELS, RETURN_NUMBERS, keep_invalid=False), selector]).fit(train)
    weights = dict(train.groupBy("is_returned").agg(F.max("class_weight")).collect())
    fitted = fit_forest(forest, stages.transform(train), KEYS, [weights.get(label, 1.0) for label in (0.0, 1.0)])
    model = PipelineModel([*stages.stages, fitted])
    scored = written(model.transform(test).select(
        *KEYS, "is_returned", "rawPrediction", "prediction",
        vector_to_array("probability")[1].alias("score")), "return-scores")
    area = BinaryClassificationEvaluator(labelCol="is_returned",
                                         metricName="areaUnderROC").evaluate(scored)
    return Fitted(model, scored, area)


def roc_points(scored: DataFrame, label: str = "is_returned", score: str = "score") -> DataFrame:
    """False and true positive rate when scores from ``threshold`` on count as positive.

    One point per distinct score; the running sums are spread over range partitions.
    """
    counts = scored.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(flag(F.col(label) == 1)).alias("pos"), F.sum(flag(F.col(label) != 1)).alias("neg"))
    running = with_running_sums(counts, [F.desc("threshold")], {"above_pos": "pos", "above_neg": "neg"})
    return running.select(
        "threshold", ratio(F.col("above_neg"), F.col("above_neg_all")).alias("fpr"),
        ratio(F.col("above_pos"), F.col("above_pos_all")).alias("tpr")).orderBy(F.desc("threshold"))


def cluster_customers(shop: Shop, k: int = CLUSTERS) -> Fitted:
    """K-means on standardised recency, frequency and spend; the metric is the silhouette."""
    orders = shop.items("order_id", "user_id", "sale_price", "ordered_at")
    table = written_evenly(rfm_features(orders, cap=False), "rfm", "user_id")
    model = Pipeline(stages=[*rfm_stages(), KMeans(
        featuresCol="features", predictionCol="cluster", k=k, seed=SEED)]).fit(table)
    placed = model.transform(table)
    quality = ClusteringEvaluator(featuresCol="features", predictionCol="cluster",
                                  metricName="silhouette").evaluate(placed)
    return Fitted(model, placed.select("user_id", "recency", "frequency", "monetary", "cluster"),
                  quality)


def predict_prices(shop: Shop, leak_free: bool = False, depth: int = BOOST_DEPTH) -> Fitted:
    """Boosted trees for the sale price; the metric is the root mean squared error.

    Trees see bins only, so rows of the same bins and labels are fitted as one row with its weight:
    the fit costs by the combinations that occur, and the rows are read for bins, labels, scale and groups.
    """
    numbers = PRICE_NUMBERS_LEAK_FREE if leak_free else PRICE_NUMBERS
    table = _training_table(shop, "prices", [*KEYS, "sale_price"]).filter(F.col("sale_price") > 0)
    train, test = table.filter("in_train"), table.filter(~F.col("in_train"))
    stages = Pipeline(stages=vector_stages(LABELS, numbers, keep_invalid=False)).fit(train).stages
    scaled = SQLTransformer(statement="SELECT *, {} FROM __THIS__".format(", ".join(
        f"{c} * {1 / s if s else 0.0!r}D AS {c}_scaled" for c, s in zip(numbers, map(float, stages[-1].std)))))
    bins = tree_bins(scaled.transform(train), [f"{c}_scaled" for c in numbers], KEYS, SEED)
    names = [*bins.getOutputCols(), *stages[1].getOutputCols()]
    cells = written_evenly(as_cells(bins.transform(scaled.transform(train)), [*LABELS, *bins.getOutputCols()], "sale_price"),
                           "price-cells", *LABELS, *bins.getOutputCols())
    learned = [VectorAssembler(inputCols=names, outputCol="features_binned"),
               # Changes no value, but drops the attributes: bins would be taken for categories without order.
               StandardScaler(inputCol="features_binned", outputCol="features", withMean=False, withStd=False),
               GBTRegressor(featuresCol="features", labelCol="sale_price", weightCol="weight",
                            predictionCol="prediction", maxDepth=depth, seed=SEED)]
    fitted = Pipeline(stages=learned).fit(PipelineModel(stages[:2]).transform(cells))
    model = PipelineModel([*stages, scaled, bins, *fitted.stages])
    predicted = written(model.transform(test).select(*KEYS, "sale_price", "prediction"), "price-scores")
    error = RegressionEvaluator(labelCol="sale_price", predictionCol="prediction",
                                metricName="rmse").evaluate(predicted)
    return Fitted(model, predicted, error)


def plot_sample(predictions: DataFrame, per_mille: int, key: str) -> DataFrame:
    """A share of the rows, chosen by their key, for a scatter plot."""
    return predictions.filter(in_share(per_mille, key))


def return_report(shop: Shop) -> DataFrame:
    """ROC points with the area under the curve."""
    fitted = predict_returns(shop)
    return roc_points(fitted.predictions).withColumn("auc", F.lit(fitted.metric))


def cluster_report(shop: Shop) -> DataFrame:
    """Each user's cluster with the silhouette of the clustering."""
    fitted = cluster_customers(shop)
    return fitted.predictions.withColumn("silhouette", F.lit(fitted.metric))


def price_report(shop: Shop, leak_free: bool = False) -> DataFrame:
    """Held-out prices and predictions with their root mean squared error."""
    fitted = predict_prices(shop, leak_free)
    return fitted.predictions.withColumn("rmse", F.lit(fitted.metric))
