"""Seven business reports and the summaries drawn from them.

A percentage is rounded where the report publishes it; everything before is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.functions.columns import (
    RETURNED, SEGMENTS, SOLD, against_average, flag, mean, month_index, month_key, percent, ratio,
    rfm_segment, rounded)
from tillwork.operators.distribution import box_plot
from tillwork.operators.ranking import top_groups, top_per_group, with_approximate_tiles, with_tiles
from tillwork.operators.shape import in_order
from tillwork.sources.shop import Shop

RECENCY_DATE = "2024-01-01"


def _is_in(values: Sequence[str]) -> Column:
    return F.col("status").isin(list(values))


def _average(column: str) -> Column:
    """Aggregate: mean of published (rounded) figures, added up exactly."""
    return mean(F.sum(F.col(column).cast("decimal(28,8)")), F.count(column))


# --- monthly growth ---------------------------------------------------------------------

def monthly_growth(shop: Shop, statuses: Sequence[str] = SOLD, every_month: bool = False) -> DataFrame:
    """Revenue per category and month, growth on the month before, and running total.

    Growth compares with the previous month that has sales. ``every_month`` adds the months
    without sales (revenue 0), so that growth always compares with the calendar month before.
    """
    sold = shop.items("product_id", "sale_price", "created_at", statuses=statuses)
    monthly = (
        sold.join(shop.products("product_id", "category"), "product_id")
        .groupBy("category", month_key(F.col("created_at")).alias("order_month"))
        .agg(F.round(F.sum(F.col("sale_price").cast("decimal(18,4)")), 2).alias("exact")))
    if every_month:
        monthly = _fill_months(monthly)
    by_month = Window.partitionBy("category").orderBy("order_month")
    before = F.lag("exact").over(by_month)
    so_far = F.sum("exact").over(by_month.rowsBetween(Window.unboundedPreceding, 0))
    return (
        monthly.withColumns({"before": before, "so_far": so_far})
        .select("category", "order_month",
                F.col("exact").cast("double").alias("monthly_revenue"),
                F.col("before").cast("double").alias("prev_month_revenue"),
                rounded(percent(F.col("exact").cast("double") - F.col("before").cast("double"),
                                F.col("before"))).alias("mom_growth_pct"),
                F.col("so_far").cast("double").alias("cumulative_revenue"))
        .orderBy("category", "order_month"))


def _fill_months(monthly: DataFrame) -> DataFrame:
    month = F.to_date("order_month", "yyyy-MM")
    calendar = monthly.groupBy("category").agg(F.explode(F.sequence(
        F.min(month), F.max(month), F.expr("interval 1 month"))).alias("day"))
    calendar = calendar.select("category", month_key(F.col("day")).alias("order_month"))
    return (calendar.join(monthly, ["category", "order_month"], "left")
            .withColumn("exact", F.coalesce("exact", F.lit(0).cast("decimal(18,2)"))))


def growth_lines(growth: DataFrame, n: int = 5) -> DataFrame:
    """Monthly revenue of the ``n`` categories with the highest revenue."""
    return (top_groups(growth, "category", "monthly_revenue", n)
            .select("category", "order_month", "monthly_revenue")
            .orderBy("category", "order_month"))


def average_growth(growth: DataFrame) -> DataFrame:
    """Mean monthly growth of each category, best first."""
    return (growth.filter(F.col("mom_growth_pct").isNotNull())
            .groupBy("category").agg(_average("mom_growth_pct").alias("avg_growth_pct"))
            .orderBy(F.desc("avg_growth_pct"), "category"))


# --- best customers ---------------------------------------------------------------------

def top_customers(shop: Shop, k: int = 5, statuses: Sequence[str] = SOLD) -> DataFrame:
    """The ``k`` customers with the highest spend in each country (ties share a rank).

    Items are added up per order before they meet the orders, and per customer before they
    meet the customers. An order is one row by then, so orders are counted, not deduplicated.
    """
    per_order = shop.order_totals(known_orders=True, metrics=
        [F.count(F.lit(1)).alias("n_items"),
         F.sum(F.col("sale_price").cast("decimal(18,4)")).alias("spent")], statuses=statuses)
    per_user = per_order.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum("n_items").alias("total_items"),
        F.sum("spent").alias("spent"))
    people = shop.users("user_id", "full_name", "gender", "country", "traffic_source")
    ranked = top_per_group(per_user.join(people, "user_id"), "country", [F.desc("spent")], k,
                           "rank_in_country")
    return ranked.select(
        "country", "user_id", "full_name", "gender", "traffic_source", "total_orders",
        "total_items", F.round("spent", 2).cast("double").alias("total_spent"),
        rounded(mean(F.col("spent"), F.col("total_items"))).alias("avg_item_price"),
        "rank_in_country").orderBy("country", "rank_in_country", "user_id")


def best_customers(top: DataFrame, n: int = 6) -> DataFrame:
    """The first customer of each of the ``n`` countries whose top customers spend most."""
    return (top_groups(top, "country", "total_spent", n).filter("rank_in_country = 1")
            .select("country", "full_name", "total_spent").orderBy(F.desc("total_spent"), "country"))


# --- returns by brand -------------------------------------------------------------------

def brand_returns(shop: Shop) -> DataFrame:
    """Return rate of each brand in a category against the mean of the category's brands.

    Items are counted per product first: the same shuffle serves the join with products.
    The category mean is unweighted: each brand counts once.
    """
    per_product = shop.items("product_id", "status").groupBy("product_id").agg(
        F.count(F.lit(1)).alias("sold"),
        F.sum(flag(F.col("status") == RETURNED)).alias("returned"))
    brands = shop.products("product_id", "brand", "category").filter(F.col("brand").isNotNull())
    per_brand = per_product.join(brands, "product_id").groupBy("brand", "category").agg(
        F.sum("sold").alias("total_sold"), F.sum("returned").alias("total_returned"))
    rates = per_brand.withColumn(
        "return_rate_pct", rounded(percent(F.col("total_returned"), F.col("total_sold"))))
    # One row per brand by now, so a category's rows are few.
    in_category = Window.partitionBy("category")
    average = mean(F.sum(F.col("return_rate_pct").cast("decimal(28,8)")).over(in_category),
                   F.count("return_rate_pct").over(in_category))
    return rates.withColumn("category_avg_return_rate", rounded(average)).select(
        "brand", "category", "total_sold", "total_returned", "return_rate_pct",
        "category_avg_return_rate",
        rounded(F.col("return_rate_pct") - F.col("category_avg_return_rate"))
        .alias("diff_from_avg"),
        against_average(F.col("return_rate_pct"), F.col("category_avg_return_rate"))
        .alias("performance_flag"),
    ).orderBy("category", F.desc("return_rate_pct"), "brand")


def brand_return_spread(returns: DataFrame, n: int = 5) -> DataFrame:
    """Spread of the brands' deviations, and brands above, at and below the mean, in the
    ``n`` best-selling categories."""
    flags = {"above_average": "Above Average", "at_average": "At Average",
             "below_average": "Below Average"}
    return top_groups(returns, "category", "total_sold", n).groupBy("category").agg(
        *box_plot("diff_from_avg"),
        *(F.sum(flag(F.col("performance_flag") == label)).alias(name)
          for name, label in flags.items())).orderBy("category")


# --- cohorts ----------------------------------------------------------------------------

def cohort_retention(shop: Shop, statuses: Sequence[str] = SOLD) -> DataFrame:
    """Buyers and spend per sign-up month and order month.

    ``cohort_size`` is the number of buyers in the cohort's first month with a sale, not the
    number of sign-ups.
    """
    per_order = shop.order_totals(
        [F.sum(F.col("sale_price").cast("decimal(18,4)")).alias("spend")],
        statuses=statuses, fields=("user_id", "month"))
    spend = per_order.groupBy("user_id", "month").agg(F.sum("spend").alias("spend"))
    cohorts = shop.users("user_id", "created_at").select(
        "user_id", month_key(F.col("created_at")).alias("cohort_month"))
    active = (spend.join(cohorts, "user_id")
              .groupBy("cohort_month", F.col("month").alias("order_month"))
              .agg(F.count(F.lit(1)).alias("active_users"), F.sum("spend").alias("revenue"),
                   F.count("spend").alias("spenders")))
    first = F.first("active_users").over(
        Window.partitionBy("cohort_month").orderBy("order_month"))
    return active.withColumn("cohort_size", first).select(
        "cohort_month", "order_month", "active_users",
        F.round("revenue", 2).cast("double").alias("cohort_revenue"),
        rounded(mean(F.col("revenue"), F.col("spenders"))).alias("avg_spend_per_user"),
        "cohort_size",
        rounded(percent(F.col("active_users"), F.col("cohort_size"))).alias("retention_rate_pct"),
    ).orderBy("cohort_month", "order_month")


def cohort_matrix(cohorts: DataFrame, months: int = 7, spend_months: int = 6) -> DataFrame:
    """Mean retention and spend by cohort and number of 30-day months since its first sale."""
    start = F.min("order_month").over(Window.partitionBy("cohort_month"))
    indexed = cohorts.withColumn("month_index", month_index(F.col("order_month"), start))

    def at(index: int, column: str) -> Column:
        value = F.when(F.col("month_index") == index, F.col(column).cast("decimal(28,8)"))
        return mean(F.sum(value), F.count(value))

    return indexed.groupBy("cohort_month").agg(
        *(at(i, "retention_rate_pct").alias(f"retention_m{i}") for i in range(months)),
        *(at(i, "avg_spend_per_user").alias(f"spend_m{i}") for i in range(spend_months)),
    ).orderBy("cohort_month")


# --- traffic funnel ---------------------------------------------------------------------

def traffic_funnel(shop: Shop, statuses: Sequence[str] = SOLD) -> DataFrame:
    """From users to completed orders by traffic source; users without an order count.

    Distinct users and orders become plain counts of rows: items are added up per order,
    orders per user, and users per source, so no row is multiplied for several distincts.
    """
    revenue = shop.items("order_id", "sale_price", statuses=statuses).groupBy("order_id").agg(
        F.sum(F.col("sale_price").cast("decimal(18,4)")).alias("revenue"))
    per_user = (
        shop.orders("order_id", "user_id", "status").join(revenue, "order_id", "left")
        .groupBy("user_id").agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum(flag(_is_in(statuses))).alias("completed"),
            F.sum(flag(F.col("status") == RETURNED)).alias("returned"),
            F.sum("revenue").alias("revenue")))
    nothing = F.lit(0)
    per_source = (
        shop.users("user_id", "traffic_source").join(per_user, "user_id", "left")
        .groupBy("traffic_source").agg(
            F.count(F.lit(1)).alias("total_users"),
            F.coalesce(F.sum("orders"), nothing).alias("total_orders"),
            F.coalesce(F.sum("completed"), nothing).alias("completed_orders"),
            F.coalesce(F.sum("returned"), nothing).alias("returned_orders"),
            F.round(F.coalesce(F.sum("revenue"), nothing), 2).alias("revenue")))
    users, orders = F.col("total_users"), F.col("total_orders")
    return per_source.select(
        "traffic_source", "total_users", "total_orders", "completed_orders", "returned_orders",
        F.col("revenue").cast("double").alias("total_revenue"),
        rounded(percent(orders, users)).alias("order_conversion_rate_pct"),
        rounded(percent(F.col("completed_orders"), orders)).alias("completion_rate_pct"),
        rounded(percent(F.col("returned_orders"), orders)).alias("return_rate_pct"),
        rounded(ratio(F.col("revenue"), users)).alias("revenue_per_user"),
        F.rank().over(Window.orderBy(F.desc("revenue"))).alias("revenue_rank"),
    ).orderBy(F.desc("total_revenue"), "traffic_source")


# --- delivery ---------------------------------------------------------------------------

def delivery_by_center(shop: Shop) -> DataFrame:
    """Days from order to delivery, and return rate, per distribution center and category.

    Items are first counted by whole days; mean, exact median and deviation all follow from
    those counts.
    """
    items = shop.items("product_id", "inventory_item_id", "status", "created_at", "delivered_at")
    delivered = items.filter(F.col("delivered_at").isNotNull()).select(
        "product_id", "inventory_item_id",
        F.datediff("delivered_at", "created_at").alias("days"),
        flag(F.col("status") == RETURNED).alias("returned"))
    placed = (delivered.join(shop.inventory("inventory_item_id", "center_id"), "inventory_item_id")
              .join(shop.centers(), "center_id")
              .join(shop.products("product_id", "category"), "product_id"))
    group = ["center_name", "center_id", "category"]
    counts = placed.groupBy(*group, "days").agg(
        F.count(F.lit(1)).alias("n"), F.sum("returned").alias("returned"))
    same = Window.partitionBy(*group)
    counts = counts.withColumns({
        "upto": F.sum("n").over(same.orderBy("days")), "total": F.sum("n").over(same)})
    n, days = F.col("n"), F.col("days").cast("long")
    reached = F.col("upto") >= F.ceil(F.col("total") / F.lit(2))
    stats = counts.groupBy(*group).agg(
        F.sum("n").alias("total_items"), F.sum("returned").alias("returns"),
        F.sum(n * days).alias("s1"), F.sum(n * days * days).alias("s2"),
        F.sum(F.when(F.col("days").isNotNull(), n)).alias("known"),
        F.min(F.when(reached, F.col("days"))).alias("median"))
    s1, s2, known = (F.col(c).cast("double") for c in ("s1", "s2", "known"))
    variance = F.try_divide(s2 - s1 * s1 / known, known - 1)
    rated = stats.select(
        F.col("center_name").alias("distribution_center"), "category", "total_items",
        rounded(ratio(F.col("s1"), F.col("known"))).alias("avg_delivery_days"),
        F.col("median").cast("double").alias("median_delivery_days"),
        rounded(F.sqrt(F.greatest(variance, F.lit(0.0)))).alias("stddev_delivery_days"),
        rounded(percent(F.col("returns"), F.col("total_items"))).alias("return_rate_pct"))
    center = Window.partitionBy("distribution_center")

    def center_average(column: str) -> Column:
        exact = F.sum(F.col(column).cast("decimal(28,8)")).over(center)
        return mean(exact, F.count(column).over(center))

    return rated.withColumns({
        "dc_avg_delivery": center_average("avg_delivery_days"),
        "dc_avg_return_rate": center_average("return_rate_pct"),
        "return_rank_in_dc": F.rank().over(center.orderBy(F.desc("return_rate_pct"))),
    }).orderBy("distribution_center", F.desc("return_rate_pct"), "category")


def center_summary(delivery: DataFrame) -> DataFrame:
    """Unweighted means over a center's categories, and its items."""
    return delivery.groupBy("distribution_center").agg(
        _average("avg_delivery_days").alias("avg_delivery"),
        _average("return_rate_pct").alias("avg_return"),
        F.sum("total_items").alias("total_items")).orderBy("distribution_center")


def center_matrix(delivery: DataFrame) -> DataFrame:
    """Mean return rate by center and category: a row per pair, pivoted only for display."""
    return delivery.groupBy("distribution_center", "category").agg(
        _average("return_rate_pct").alias("avg_return_rate")).orderBy("distribution_center", "category")


# --- recency, frequency, monetary value ---------------------------------------------------

def rfm_raw(shop: Shop, statuses: Sequence[str] = SOLD, as_of: str = RECENCY_DATE) -> DataFrame:
    """Days since the last order, number of orders and spend of each buyer."""
    per_order = shop.order_totals(known_orders=True, metrics=
        [F.sum(F.col("sale_price").cast("decimal(18,4)")).alias("spent")],
        statuses=statuses, fields=("user_id", "last_at"))
    per_user = per_order.groupBy("user_id").agg(
        F.datediff(F.to_date(F.lit(as_of)), F.max("last_at")).alias("recency_days"),
        F.count(F.lit(1)).alias("frequency"),
        F.round(F.sum("spent"), 2).alias("monetary"))
    return per_user.join(shop.users("user_id", "full_name", "country", "gender"), "user_id")


def rfm_segments(shop: Shop, statuses: Sequence[str] = SOLD, as_of: str = RECENCY_DATE,
                 scoring: str = "inverted", tiles: str = "exact") -> DataFrame:
    """Score each buyer 1 to 5 on recency, frequency and spend, and name the segment.

    ``scoring="inverted"`` gives the most recent, frequent and generous buyers a 1, as the
    published report does; ``"standard"`` gives them a 5, which is what the segment names
    suggest. ``tiles="exact"`` is NTILE with the user as tie-break, computed without a
    single-task sort; ``"approximate"`` uses percentile cut points and lets ties share a score.
    """
    raw = rfm_raw(shop, statuses, as_of)
    best_first = scoring == "inverted"
    falling = {"r_score": not best_first, "f_score": best_first, "m_score": best_first}
    measures = {"r_score": "recency_days", "f_score": "frequency", "m_score": "monetary"}
    if tiles == "exact":
        scored = with_tiles(raw, {
            name: [F.desc(column) if falling[name] else F.asc(column), F.asc("user_id")]
            for name, column in measures.items()}, 5)
    else:
        scored = with_approximate_tiles(
            raw, {name: (column, falling[name]) for name, column in measures.items()}, 5)
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return scored.select(
        "user_id", "full_name", "country", "gender", "recency_days", "frequency",
        F.col("monetary").cast("double").alias("monetary"), r, f, m,
        (r + f + m).alias("rfm_total"), rfm_segment(r, f, m).alias("rfm_segment"),
    ).orderBy(F.desc("rfm_total"), "user_id")


def segment_summary(segments: DataFrame) -> DataFrame:
    """Customers and mean spend per segment, in fixed order; an empty segment has nulls."""
    stats = segments.groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        mean(F.sum(F.col("monetary").cast("decimal(18,2)")), F.count("monetary"))
        .alias("avg_monetary"))
    return in_order(stats, "rfm_segment", SEGMENTS, keep_absent=True)
