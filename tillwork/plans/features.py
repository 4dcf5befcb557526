"""Feature tables for the models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions.columns import RETURNED, discount_rate, flag, is_discounted
from tillwork.operators.distribution import cap_outliers
from tillwork.session import written, written_evenly
from tillwork.sources.shop import Shop

# --- Fixed values -------------------------------------------------------------------
REQUIRED = ["sale_price", "retail_price", "cost", "gender", "category", "traffic_source", "age"]
CAPPED = ["sale_price", "retail_price", "cost", "age"]
RETURN_LABELS = ["gender", "category", "department", "traffic_source"]
RETURN_NUMBERS = ["sale_price", "retail_price", "cost", "age", "discount_rate", "price_gap",
                  "is_discounted", "profit_margin"]
PRICE_LABELS = ["gender", "category", "traffic_source"]
PRICE_NUMBERS = ["retail_price", "cost", "age", "discount_rate", "price_gap", "is_discounted",
                 "profit_margin"]
RFM = ["recency", "frequency", "monetary"]
# ------------------------------------------------------------------------------------

KEYS = ["order_id", "product_id", "user_id"]


def with_price_features(df: DataFrame) -> DataFrame:
    retail, sale, cost = (F.col(c) for c in ("retail_price", "sale_price", "cost"))
    rated = df.withColumn("discount_rate", discount_rate(retail, sale))
    return rated.withColumns({
        "price_gap": retail - cost,
        "is_discounted": is_discounted(F.col("discount_rate")),
        "profit_margin": sale - cost})


def item_master(shop: Shop) -> DataFrame:
    """Items with their order's, buyer's and product's attributes; prices as doubles."""
    items = shop.priced_items(*KEYS, "sale_price", "retail_price", "cost", "category",
                              "department", "order_status", "ordered_at", "gender", "age",
                              "traffic_source")
    return items.withColumns({c: F.col(c).cast("double") for c in CAPPED})


def item_features(shop: Shop) -> DataFrame:
    """Complete items with outliers capped and price features added.

    The joined table is written once: the quartiles take three passes over four of its
    columns, and a model takes more.
    """
    complete = written(item_master(shop).dropna(subset=REQUIRED), "item-master")
    return with_price_features(cap_outliers(complete, CAPPED))


def return_input(features: DataFrame) -> DataFrame:
    """Input of the return model: the label, and rows without missing inputs."""
    label = flag(F.col("order_status") == RETURNED).cast("double")
    return features.withColumn("is_returned", label).dropna(
        subset=["sale_price", "retail_price", "cost", "age", *RETURN_LABELS])


def price_input(features: DataFrame) -> DataFrame:
    """Input of the price model: items with a price above zero."""
    return features.filter(F.col("sale_price") > 0).dropna(subset=REQUIRED)


def vector_stages(labels: Sequence[str], numbers: Sequence[str], output: str = "features_scaled",
                  keep_invalid: bool = True) -> list:
    """Index and one-hot encode the labels, assemble, and scale without centering.

    Each stage handles all its columns in one pass over the data.
    """
    index, hot = [f"{c}_idx" for c in labels], [f"{c}_ohe" for c in labels]
    return [
        StringIndexer(inputCols=list(labels), outputCols=index, handleInvalid="keep"),
        OneHotEncoder(inputCols=index, outputCols=hot),
        VectorAssembler(inputCols=[*numbers, *hot], outputCol="features_raw",
                        handleInvalid="keep" if keep_invalid else "error"),
        StandardScaler(inputCol="features_raw", outputCol=output, withMean=False, withStd=True),
    ]


def vectors(df: DataFrame, labels: Sequence[str], numbers: Sequence[str]) -> DataFrame:
    """``df`` with the scaled feature vector of its own fit.

    The input is written first: labels, encoder and scaler are fitted in passes of their own.
    """
    table = written_evenly(df, "vector-input", *([k for k in KEYS if k in df.columns] or df.columns))
    return Pipeline(stages=vector_stages(labels, numbers)).fit(table).transform(table)


def slot_names(table: DataFrame, column: str = "features_raw") -> list[str]:
    """The names of a vector column's slots, as the stages that built it recorded them."""
    kinds = table.schema[column].metadata["ml_attr"]["attrs"].values()
    return [a["name"] for a in sorted((a for kind in kinds for a in kind), key=lambda a: a["idx"])]


def explained(table: DataFrame, *keys: str, column: str = "features_scaled") -> DataFrame:
    """Columns keys, slot, value: a row for each slot of a vector that is not zero, by its name."""
    names = F.array(*map(F.lit, slot_names(table)))
    slots = F.filter(F.arrays_zip(names.alias("slot"), vector_to_array(column).alias("value")), lambda x: x["value"] != 0)
    return table.select(*keys, F.inline(slots).alias("slot", "value"))


def rfm_features(features: DataFrame, cap: bool = True) -> DataFrame:
    """Days since the last order (seen from the newest one), orders, and spend per user."""
    newest = features.agg(F.max("ordered_at")).scalar()
    per_order = features.groupBy("order_id", "user_id").agg(
        F.max("ordered_at").alias("last"),
        F.sum(F.col("sale_price").cast("decimal(28,8)")).alias("spent"))
    rfm = per_order.groupBy("user_id").agg(
        F.datediff(newest, F.max("last")).alias("recency"),
        F.count(F.lit(1)).alias("frequency"),
        F.sum("spent").cast("double").alias("monetary")).dropna(subset=RFM)
    return cap_outliers(written(rfm, "rfm"), ["monetary", "frequency"]) if cap else rfm


def rfm_stages(output: str = "features") -> list:
    return [VectorAssembler(inputCols=RFM, outputCol="features_raw"),
            StandardScaler(inputCol="features_raw", outputCol=output, withMean=True, withStd=True)]
