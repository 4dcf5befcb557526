"""The four event-time jobs.

A job maps decoded messages to its result and knows neither source nor sink: it runs on a
stream and, for backfills and tests, on a stored table. Distinct counts are HyperLogLog
estimates on a stream (``distinct="approx"``) and may be exact on a table; the funnel's may on both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.functions.columns import (
    ALERT_TIERS, flag, iso_instant, lost_revenue, margin_status, mean, percent, rounded, stock_tier)
from tillwork.session import written

# --- Fixed values -------------------------------------------------------------------
FUNNEL_STAGES = ["home", "department", "product", "cart", "purchase"]
MARGIN_TARGETS = {
    "Intimates": 35.0,
    "Jeans": 30.0,
    "Swim": 40.0,
    "Pants & Capris": 28.0,
    "Shorts": 32.0,
    "Tops & Tees": 25.0,
    "Blazers & Jackets": 38.0,
    "Dresses": 35.0,
    "Accessories": 50.0,
    "Socks & Hosiery": 20.0,
    "Suits & Sport Coats": 42.0,
    "Sweaters": 30.0,
    "Active": 33.0,
    "Outerwear & Coats": 40.0,
    "Skirts": 35.0,
}
OUTLIER_ITEMS = 15
OUTLIER_DEVIATIONS = 3
# ------------------------------------------------------------------------------------


def with_event_time(messages: DataFrame, column: str, late: str | None) -> DataFrame:
    """Event time from the ISO text, and how long late messages are waited for."""
    timed = messages.withColumn("event_time", iso_instant(F.col(column)))
    return timed if late is None else timed.withWatermark("event_time", late)


def _window(length: str, slide: str | None) -> Column:
    window = F.window("event_time", length, slide) if slide else F.window("event_time", length)
    return window.alias("w")


def _distinct(how: str):
    return F.approx_count_distinct if how == "approx" else F.countDistinct


def _labelled(df: DataFrame, stream: str, *columns) -> DataFrame:
    """Unpack the window, and say which stream wrote the row and when."""
    return df.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                     *columns, F.lit(stream).alias("stream_name"),
                     F.current_timestamp().alias("processed_at"))


def order_anomaly(messages: DataFrame, length: str = "1 minute", late: str = "2 minutes",
                  distinct: str = "approx") -> DataFrame:
    """Orders, flagged anomalies and order value per tumbling window and status."""
    timed = with_event_time(messages, "created_at", late)
    price, items = F.col("sale_price"), F.col("num_of_item")
    counted = timed.groupBy(_window(length, None), "status").agg(
        F.count("order_id").alias("total_orders"),
        F.sum(flag(F.col("is_anomaly"))).alias("anomaly_count"),
        mean(F.sum(price), F.count(price)).alias("avg_sale_price"),
        F.max(price).cast("double").alias("max_sale_price"),
        mean(F.sum(items), F.count(items)).alias("avg_items"),
        F.max(items).alias("max_items"),
        F.sum(price).cast("double").alias("total_gmv"),
        _distinct(distinct)("user_id").alias("unique_buyers"))
    return _labelled(
        counted, "order_anomaly", "status", "total_orders", "anomaly_count", "avg_sale_price",
        "max_sale_price", "avg_items", "max_items", "total_gmv", "unique_buyers",
        rounded(percent(F.col("anomaly_count"), F.col("total_orders"))).alias("anomaly_rate_pct"))


def _funnel_rates() -> list[Column]:
    home, cart, purchase = (F.col(f"stage_{s}") for s in ("home", "cart", "purchase"))
    none = F.lit(0.0)
    return [
        rounded(F.when(home > 0, percent(purchase, home)).otherwise(none))
        .alias("funnel_conversion_pct"),
        rounded(F.when(cart > 0, percent(cart - purchase, cart)).otherwise(none))
        .alias("cart_abandon_pct")]


def traffic_funnel(messages: DataFrame, length: str = "2 minutes", slide: str | None = "30 seconds",
                   late: str = "3 minutes", distinct: str = "approx") -> DataFrame:
    """Sessions per funnel stage, conversion and cart abandonment by source and window.

    A session counts for the stages it has an event of. ``distinct="exact"`` holds a row per session and
    one per user of each open window; on a stream it needs the append mode.
    """
    timed = with_event_time(messages, "created_at", late)
    stages = [f"stage_{s}" for s in FUNNEL_STAGES]
    kind = F.col("event_type")
    if distinct == "approx":
        counted = timed.groupBy(_window(length, slide), "traffic_source").agg(
            F.count("event_id").alias("total_events"),
            F.approx_count_distinct("session_id").alias("total_sessions"),
            *(F.approx_count_distinct(F.when(kind == s, F.col("session_id"))).alias(f"stage_{s}")
              for s in FUNNEL_STAGES),
            F.approx_count_distinct("user_id").alias("unique_users"))
    else:
        counted = _exact_funnel(timed, _window(length, slide))
    return _labelled(counted, "traffic_funnel", "traffic_source", "total_events", "total_sessions",
                     *stages, "unique_users", *_funnel_rates())


def _exact_funnel(timed: DataFrame, window: Column) -> DataFrame:
    """Exact counts with one large shuffle: a row per session, with a bit for each stage it
    reached, and a row per user. What is left are plain counts and sums."""
    stage = F.array_position(F.array(*map(F.lit, FUNNEL_STAGES)), F.col("event_type")).cast("int")
    seen = timed.select(window, "traffic_source", "event_id", "session_id", "user_id", stage.alias("stage")).selectExpr(
        "w", "traffic_source", """stack(2,
            true, CAST(session_id AS STRING), CAST(event_id IS NOT NULL AS INT), CASE WHEN stage > 0 THEN shiftleft(1, stage - 1) ELSE 0 END,
            false, CAST(user_id AS STRING), 0, 0) AS (is_session, id, events, bits)""")
    each = seen.groupBy("w", "traffic_source", "is_session", "id").agg(F.sum("events").alias("events"), F.bit_or("bits").alias("bits"))
    known, session = F.col("id").isNotNull(), F.col("is_session")
    return each.groupBy("w", "traffic_source").agg(
        F.sum("events").alias("total_events"), F.count_if(session & known).alias("total_sessions"),
        *(F.count_if(session & known & (F.col("bits").bitwiseAND(1 << i) > 0)).alias(f"stage_{s}") for i, s in enumerate(FUNNEL_STAGES)),
        F.count_if(~session & known).alias("unique_users"))


def funnel_reached(messages: DataFrame, length: str) -> DataFrame:
    """Sessions that reached each stage or a later one, by source and tumbling window."""
    timed = with_event_time(messages, "created_at", None)
    depth = F.array_position(F.array(*map(F.lit, FUNNEL_STAGES)), F.col("event_type"))
    per_session = timed.groupBy(_window(length, None), "traffic_source", "session_id").agg(
        F.max(depth).alias("depth"))
    reached = per_session.groupBy("w", "traffic_source").agg(*(
        F.sum(flag(F.col("depth") >= i + 1)).alias(f"reached_{s}")
        for i, s in enumerate(FUNNEL_STAGES)))
    return reached.select(F.col("w.start").alias("window_start"), "traffic_source",
                          *(f"reached_{s}" for s in FUNNEL_STAGES))


def visitor_sketches(messages: DataFrame, length: str = "1 minute",
                     late: str = "3 minutes") -> DataFrame:
    """One mergeable sketch of the users per source and tumbling window.

    Counts of distinct users cannot be added up over windows; sketches can.
    """
    timed = with_event_time(messages, "created_at", late)
    return timed.groupBy(_window(length, None), "traffic_source").agg(
        F.hll_sketch_agg("user_id").alias("users")).select(
        F.col("w.start").alias("window_start"), "traffic_source", "users")


# --- inventory --------------------------------------------------------------------------

STATE_KEYS = ["product_id", "category", "brand", "distribution_center"]
#: Column of the messages to its name in the state.
STATE_VALUES = {"product_name": "product_name", "available_quantity": "available_quantity",
                "stock_quantity": "stock_quantity", "sold_quantity": "sold_quantity",
                "product_retail_price": "retail_price", "cost": "cost",
                "is_low_stock": "is_low_stock", "is_out_of_stock": "is_out_of_stock"}


def inventory_state(messages: DataFrame) -> DataFrame:
    """The newest known values of each product in its center, and its alert tier.

    Newest means by event time, not by arrival; a null never replaces a value. On a stream the state
    never ends; :func:`tillwork.streaming.keyed.inventory_changes` lets silent keys go.
    """
    timed = with_event_time(messages, "updated_at", None)
    moment = F.struct("event_time", "inventory_item_id")

    def newest(column: str) -> Column:
        return F.max_by(column, F.when(F.col(column).isNotNull(), moment))

    state = timed.groupBy(*STATE_KEYS).agg(
        *(newest(column).alias(name) for column, name in STATE_VALUES.items()),
        F.max("event_time").alias("last_updated"),
        F.count("inventory_item_id").alias("update_count"))
    return described_state(state)


def described_state(state: DataFrame) -> DataFrame:
    """Alert tier, lost revenue and lineage of each key's values."""
    available = F.col("available_quantity")
    return state.select(
        "*", stock_tier(available).alias("alert_tier"),
        lost_revenue(available, F.col("retail_price")).alias("potential_lost_revenue"),
        F.lit("inventory_alert").alias("stream_name"),
        F.current_timestamp().alias("processed_at"))


def inventory_alerts(state: DataFrame) -> DataFrame:
    return state.filter(F.col("alert_tier").isin(ALERT_TIERS))


# --- revenue ----------------------------------------------------------------------------

def margin_targets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(MARGIN_TARGETS.items()),
                                 "category string, margin_target_pct double")


def revenue_dashboard(messages: DataFrame, length: str = "2 minutes",
                      slide: str | None = "30 seconds", late: str = "3 minutes",
                      distinct: str = "approx", targets: DataFrame | None = None) -> DataFrame:
    """Revenue, cost and margin against target by category, source and window."""
    timed = with_event_time(messages, "created_at", late)

    def total(column: str) -> Column:
        return F.sum(column).cast("double")

    def average(column: str) -> Column:
        return mean(F.sum(column), F.count(column))

    sums = timed.groupBy(_window(length, slide), "category", "traffic_source").agg(
        F.count("order_id").alias("order_count"),
        total("total_revenue").alias("gross_revenue"), total("total_cost").alias("total_cost"),
        average("gross_margin").alias("avg_margin_per_order"),
        F.sum("num_of_item").alias("units_sold"),
        _distinct(distinct)("user_id").alias("unique_buyers"),
        average("sale_price").alias("avg_order_value"),
        total("total_margin").alias("gross_margin"))
    revenue = F.col("gross_revenue")
    margin = F.when(revenue > 0, percent(F.col("gross_margin"), revenue)).otherwise(F.lit(0.0))
    # The target list has a fixed number of rows, so the stream is not shuffled for it.
    known = margin_targets(messages.sparkSession) if targets is None else targets
    joined = sums.withColumn("margin_pct", rounded(margin)).join(
        F.broadcast(known) if targets is None else known, "category", "left")
    target = F.coalesce("margin_target_pct", F.lit(0.0))
    gap = rounded(F.col("margin_pct") - target)
    return _labelled(
        joined, "revenue_dashboard", "category", "traffic_source", "order_count", "gross_revenue",
        "total_cost", "gross_margin", "avg_margin_per_order", "units_sold", "unique_buyers",
        "avg_order_value", "margin_pct", target.alias("margin_target_pct"),
        gap.alias("vs_margin_target"), margin_status(gap).alias("margin_status"))


# --- outliers ---------------------------------------------------------------------------

def price_statistics(history: DataFrame) -> DataFrame:
    """Number, mean and deviation of past prices: one row, stored and refreshed on its own schedule."""
    price = F.col("sale_price").cast("double")
    return written(history.agg(F.count(price).alias("n"), F.avg(price).alias("mean"),
                               F.stddev_samp(price).alias("deviation")), "price-statistics")


def price_limit(statistics: DataFrame) -> Column:
    """Mean plus three deviations, as a scalar over the stored row."""
    return statistics.select(F.col("mean") + OUTLIER_DEVIATIONS * F.col("deviation")).scalar()


def outlier_orders(messages: DataFrame, statistics: DataFrame) -> DataFrame:
    """Orders priced far above the history, or with too many items.

    The limit comes from the row that :func:`price_statistics` stored: a micro-batch of a stream
    reads that row, not the history.
    """
    price, items = F.col("sale_price"), F.col("num_of_item")
    judged = messages.withColumn("_limit", price_limit(statistics)).withColumns({
        "high_price": F.coalesce(price.cast("double") > F.col("_limit"), F.lit(False)),
        "many_items": F.coalesce(items > OUTLIER_ITEMS, F.lit(False))})
    return judged.filter("high_price OR many_items").select(
        "order_id", "status", price.cast("double").alias("sale_price"), "num_of_item",
        "high_price", "many_items")
