"""Data-quality checks. Each scans a table once, whatever the number of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions.columns import STATUSES, flag, mean, rounded
from tillwork.operators.distribution import column_quantiles, share_of_total
from tillwork.operators.profile import describe, domain_difference, duplicate_keys, null_report, shapes
from tillwork.sources.shop import Shop

PERCENTILES = {"p1": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}


def table_shapes(shop: Shop, tables: Sequence[str]) -> DataFrame:
    """Rows, columns and types of the stored tables."""
    return shapes({name: shop.table(name) for name in tables})


def descriptive_statistics(shop: Shop) -> DataFrame:
    """count, mean, deviation and range of item price, user age, product cost and price."""
    parts = [("items", shop.items("sale_price"), ["sale_price"]),
             ("users", shop.users("age"), ["age"]),
             ("products", shop.products("cost", "retail_price"), ["cost", "retail_price"])]
    stats = [describe(df, columns).select(F.lit(name).alias("table"), "*")
             for name, df, columns in parts]
    return stats[0].unionByName(stats[1]).unionByName(stats[2])


def nulls(shop: Shop) -> DataFrame:
    """Columns with nulls in every relation, most first."""
    return null_report({name: getattr(shop, name)() for name in
                        ("orders", "items", "users", "products", "stock", "centers", "web_events")})


def nulls_by_status(shop: Shop) -> DataFrame:
    """Missing shipping, delivery and return times by item status."""
    times = ("shipped_at", "delivered_at", "returned_at")
    return shop.items("status", *times).groupBy("status").agg(
        F.count(F.lit(1)).alias("total"),
        *(F.sum(flag(F.col(c).isNull())).alias(f"null_{c}") for c in times)).orderBy("status")


def key_duplicates(shop: Shop) -> DataFrame:
    return duplicate_keys({
        "orders": (shop.orders("order_id"), "order_id"),
        "items": (shop.items(*shop.item_key), shop.item_key),
        "users": (shop.users("user_id"), "user_id"),
        "products": (shop.products("product_id"), "product_id")})


def items_per_order(shop: Shop) -> DataFrame:
    counts = shop.items("order_id").groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.min("n").alias("min_items"), F.max("n").alias("max_items"),
                      rounded(mean(F.sum("n"), F.count("n"))).alias("avg_items"))


def _range(df: DataFrame, name: str, column: str, suspicious, with_percentiles: bool) -> DataFrame:
    value = F.col(column)
    stats = df.agg(F.min(value).cast("double").alias("min"),
                   F.max(value).cast("double").alias("max"),
                   F.sum(flag(suspicious)).alias("suspicious"),
                   F.sum(flag(value.isNull())).alias("nulls"))
    if with_percentiles:
        cuts = column_quantiles(df, [column], list(PERCENTILES.values()))[column]
        stats = stats.withColumn("cuts", cuts)
        points = [F.col("cuts")[i].alias(p) for i, p in enumerate(PERCENTILES)]
    else:
        points = [F.lit(None).cast("double").alias(p) for p in PERCENTILES]
    return stats.select(F.lit(name).alias("check"), "min", "max", "suspicious", "nulls", *points)


def ranges(shop: Shop) -> DataFrame:
    """Range, doubtful values and percentiles of price, cost and age.

    A price or cost is doubtful at zero or below, an age outside 10 to 100.
    """
    age = F.col("age")
    return (_range(shop.items("sale_price"), "sale_price", "sale_price",
                   F.col("sale_price") <= 0, True)
            .unionByName(_range(shop.products("cost"), "cost", "cost", F.col("cost") <= 0, False))
            .unionByName(_range(shop.users("age"), "age", "age", (age < 10) | (age > 100), True)))


def time_order(shop: Shop) -> DataFrame:
    """Items delivered before they were created: one row."""
    times = shop.items("created_at", "delivered_at").filter(
        F.col("created_at").isNotNull() & F.col("delivered_at").isNotNull())
    return times.filter(F.col("delivered_at") < F.col("created_at")).agg(
        F.count(F.lit(1)).alias("delivered_before_created"))


def status_distribution(shop: Shop) -> DataFrame:
    counts = shop.items("status").groupBy("status").agg(F.count(F.lit(1)).alias("count"))
    return counts.select("status", "count", rounded(share_of_total("count")).alias("pct"),
                         F.coalesce(F.col("status").isin(STATUSES), F.lit(False)).alias("expected")
                         ).orderBy(F.desc("count"), "status")


def status_domain(shop: Shop, expected: Sequence[str] = STATUSES) -> DataFrame:
    """Expected statuses that never occur, and statuses that were not expected."""
    return domain_difference(shop.items("status"), "status", expected)


def orders_and_items_by_status(shop: Shop) -> DataFrame:
    """Orders next to items for every status either of them has."""
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("status").agg(F.count(F.lit(1)).alias(name))
    both = counted(shop.orders("status"), "orders_count").join(
        counted(shop.items("status"), "items_count"), "status", "full_outer")
    return both.fillna(0, ["orders_count", "items_count"]).orderBy("status")

