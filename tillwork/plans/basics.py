"""Single operators over whole tables, as small queries of their own."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions.columns import (
    COMPLETE, RETURNED, age_band, clean_timestamp, days_between, flag, margin_pct, profit, rounded)
from tillwork.operators.distribution import column_quantiles
from tillwork.session import shared_folder
from tillwork.sources.quoted_csv import read_quoted_csv
from tillwork.sources.shop import Shop
from tillwork.sources.streams import EVENT_FIELDS, decode_json, star_web_events


def quoted_csv(shop: Shop) -> DataFrame:
    """Users written as CSV with quotes, commas and line breaks in a field, and read back."""
    path = f"{shared_folder(shop.spark)}/csv/users-{uuid.uuid4().hex}"
    note = F.concat(F.lit('"'), F.col("full_name"), F.lit('", of\n'), F.col("country"))
    people = shop.users("user_id", "full_name", "country").select("user_id", note.alias("note"))
    people.write.options(header=True, escape='"', quote='"').csv(path)
    return read_quoted_csv(shop.spark, path, "user_id long, note string")


def sql_views(shop: Shop) -> DataFrame:
    """SQL text over the registered relations."""
    shop.register()
    return shop.spark.sql("""
        SELECT p.category, i.status, count(*) AS items,
               CAST(sum(i.sale_price) AS DOUBLE) AS revenue
        FROM shop_items i JOIN shop_products p ON i.product_id = p.product_id
        GROUP BY p.category, i.status""")


def json_decode(shop: Shop) -> DataFrame:
    """Web events as JSON messages and back."""
    events = star_web_events(shop.table("events"))
    messages = events.select(F.to_json(F.struct("*")).cast("binary").alias("value"))
    return decode_json(messages, EVENT_FIELDS).select(
        "event_id", "user_id", "session_id", "event_type", "traffic_source", "created_at")


def clean_timestamps(shop: Shop) -> DataFrame:
    """Text with a fraction and a zone name to whole seconds."""
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(" UTC"))
    return shop.table("events").select(
        "event_id", F.date_format(clean_timestamp(text), "yyyy-MM-dd HH:mm:ss").alias("cleaned"))


def delivery_days(shop: Shop) -> DataFrame:
    """Items by status and fractional days from shipping to delivery."""
    items = shop.items("status", "shipped_at", "delivered_at").select(
        "status", days_between(F.col("shipped_at"), F.col("delivered_at")).alias("delivery_days"))
    return items.groupBy("status", "delivery_days").agg(F.count(F.lit(1)).alias("items"))


def status_flags(shop: Shop) -> DataFrame:
    status = F.col("status")
    return shop.items("status").groupBy("status").agg(
        F.sum(flag(status == RETURNED)).alias("is_returned"),
        F.sum(flag(status.isin(COMPLETE))).alias("is_complete"))


def age_bands(shop: Shop) -> DataFrame:
    return shop.users("user_id", "age").select(
        "user_id", age_band(F.col("age")).alias("age_group"))


def item_margins(shop: Shop) -> DataFrame:
    sale, cost = F.col("sale_price"), F.col("cost")
    return shop.priced_items("order_id", "product_id", "sale_price", "cost").select(
        "order_id", "product_id", profit(sale, cost).cast("double").alias("profit"),
        rounded(margin_pct(sale, cost), 6).alias("margin_pct"))


def quartiles(shop: Shop) -> DataFrame:
    """Exact quartiles of two columns in three aggregations."""
    cuts = column_quantiles(shop.items("sale_price", "quantity"), ["sale_price", "quantity"],
                            [0.25, 0.75])
    row = shop.spark.range(1).withColumn("cuts", cuts)
    return row.select(*(F.col("cuts")[c][i].alias(f"{c}_{q}")
                        for c in ("sale_price", "quantity") for i, q in enumerate(("q1", "q3"))))


def approximate_buyers(shop: Shop) -> DataFrame:
    return shop.items("status", "user_id").groupBy("status").agg(
        F.approx_count_distinct("user_id").alias("buyers"))


def scalar_functions(shop: Shop) -> DataFrame:
    """String, date, number and null functions on every order."""
    created, key = F.col("created_at"), F.col("order_id")
    return shop.orders("order_id", "user_id", "status", "created_at").select(
        "order_id",
        F.concat(F.col("status"), F.lit(" "), key.cast("string")).alias("label"),
        F.regexp_replace("status", "e+", "_").alias("replaced"),
        F.substring("status", 1, 9).alias("prefix"),
        F.date_format(created, "yyyy-MM").alias("month"),
        F.datediff(F.to_date(F.lit("2024-01-01")), F.to_date(created)).alias("days_ago"),
        F.unix_timestamp(created.cast("timestamp")).alias("epoch"),
        F.abs(key - F.col("user_id")).alias("distance"),
        F.floor(key / F.lit(7)).alias("sevenths"),
        F.coalesce(F.nullif(F.col("status"), F.lit("Complete")), F.lit("-")).alias("open_status"),
        F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd").alias("parity"))
