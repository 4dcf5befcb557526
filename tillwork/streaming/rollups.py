"""Roll-ups of the streams' results for a dashboard.

Sums over windows need windows that do not overlap: feed these from tumbling windows
(``slide=None``). Distinct visitors over several windows come from merged sketches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwork.functions.columns import STOCK_TIERS, mean, percent, position_in, rounded
from tillwork.operators.distribution import share_of_max
from tillwork.operators.ranking import members_of_top
from tillwork.streaming.jobs import FUNNEL_STAGES

LAST_WINDOWS = 30
DIGITS = 6


def _latest(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy(F.desc("window_start")).limit(n)


def _sum(column: str):
    """Sum of published doubles as exact decimals."""
    return F.sum(F.col(column).cast("decimal(28,8)"))


def value_by_status(orders: DataFrame) -> DataFrame:
    return orders.groupBy("status").agg(_sum("total_gmv").cast("double").alias("total_gmv")).orderBy(
        F.desc("total_gmv"), "status")


def anomaly_trend(orders: DataFrame, last: int = LAST_WINDOWS) -> DataFrame:
    """Mean anomaly rate over the statuses, in the newest windows."""
    trend = orders.groupBy("window_start").agg(
        mean(_sum("anomaly_rate_pct"), F.count("anomaly_rate_pct")).alias("anomaly_rate_pct"))
    return _latest(trend, last).orderBy("window_start")


def funnel_totals(funnel: DataFrame) -> DataFrame:
    """Total per stage, its share of the largest, and its share of the stage before."""
    sums = funnel.agg(*(F.coalesce(F.sum(f"stage_{s}"), F.lit(0)).alias(s) for s in FUNNEL_STAGES))
    rows = F.array(*(F.struct(F.lit(i + 1).alias("position"), F.lit(s).alias("stage"),
                              F.col(s).alias("sessions")) for i, s in enumerate(FUNNEL_STAGES)))
    stages = sums.select(F.inline(rows))
    before = F.lag("sessions").over(Window.orderBy("position"))
    step = F.when(before > 0, percent(F.col("sessions"), before))
    return stages.select("position", "stage", "sessions",
                         share_of_max("sessions").alias("share_of_largest"),
                         step.alias("step_conversion_pct")).orderBy("position")


def visitors_by_source(funnel: DataFrame, n: int = 6) -> DataFrame:
    return (funnel.groupBy("traffic_source").agg(F.sum("unique_users").alias("unique_users"))
            .orderBy(F.desc("unique_users"), "traffic_source").limit(n))


def distinct_visitors_by_source(sketches: DataFrame, n: int = 6) -> DataFrame:
    """Distinct users over all windows, from merged sketches."""
    merged = sketches.groupBy("traffic_source").agg(F.hll_union_agg("users").alias("users"))
    return (merged.select("traffic_source", F.hll_sketch_estimate("users").alias("unique_users"))
            .orderBy(F.desc("unique_users"), "traffic_source").limit(n))


def stock_matrix(state: DataFrame, top_brands: int = 5, top_categories: int = 7) -> DataFrame:
    """Smallest stock by category and brand, of the best-selling of both: a row per pair.

    A pair without stock records has no row, so it cannot be taken for an empty shelf.
    """
    def sold(key: str) -> DataFrame:
        return state.groupBy(key).agg(F.sum("sold_quantity").alias("sold"))
    kept = members_of_top(state, "brand", sold("brand"), "sold", top_brands)
    kept = members_of_top(kept, "category", sold("category"), "sold", top_categories)
    return (kept.groupBy("category", "brand").agg(F.min("stock_quantity").alias("smallest_stock"))
            .orderBy("category", "brand"))


def alert_counts(state: DataFrame) -> DataFrame:
    """Products per alert tier, most severe first."""
    counts = state.groupBy("alert_tier").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.coalesce(position_in(F.col("alert_tier"), STOCK_TIERS), F.lit(99)))


def category_revenue(revenue: DataFrame, n: int = 7) -> DataFrame:
    """Revenue, cost and margin of the categories with the highest revenue."""
    sums = revenue.groupBy("category").agg(_sum("gross_revenue").alias("revenue"),
                                           _sum("gross_margin").alias("margin"))
    best = sums.orderBy(F.desc("revenue"), "category").limit(n)
    money = F.col("revenue").cast("double")
    return best.select(
        "category", F.substring("category", 1, 9).alias("label"), money.alias("gross_revenue"),
        (F.col("revenue") - F.col("margin")).cast("double").alias("cost"),
        F.col("margin").cast("double").alias("gross_margin"),
        F.when(F.col("revenue") > 0, percent(F.col("margin"), F.col("revenue")))
        .otherwise(F.lit(0.0)).alias("margin_pct")).orderBy(F.desc("gross_revenue"), "category")


def margin_trend(revenue: DataFrame, last: int = LAST_WINDOWS) -> DataFrame:
    """Margin of all sales per window in the newest windows, and its mean."""
    sums = revenue.groupBy("window_start").agg(_sum("gross_revenue").alias("revenue"),
                                               _sum("gross_margin").alias("margin"))
    base = F.greatest(F.col("revenue"), F.lit(1).cast("decimal(28,8)"))
    trend = _latest(sums.select("window_start",
                                percent(F.col("margin"), base).alias("margin_pct")), last)
    return trend.withColumn("avg_margin_pct", rounded(
        F.avg("margin_pct").over(Window.partitionBy()), DIGITS)).orderBy("window_start")


def key_figures(orders: DataFrame, funnel: DataFrame, state: DataFrame,
                revenue: DataFrame) -> DataFrame:
    """Revenue, profit, orders, products out of stock, visitors and conversion: one row."""
    zero = F.lit(0)
    money = revenue.agg(F.struct(
        F.coalesce(_sum("gross_revenue").cast("double"), F.lit(0.0)).alias("revenue"),
        F.coalesce(_sum("gross_margin").cast("double"), F.lit(0.0)).alias("profit")).alias("m")).scalar()
    placed = orders.agg(F.coalesce(F.sum("total_orders"), zero)).scalar()
    missing = state.agg(F.count(F.when(F.col("is_out_of_stock"), 1))).scalar()
    return funnel.agg(
        F.coalesce(F.sum("unique_users"), zero).alias("visitors"),
        percent(F.coalesce(F.sum("stage_purchase"), zero),
                F.greatest(F.coalesce(F.sum("stage_home"), zero), F.lit(1))).alias("conversion_pct"),
    ).select(money["revenue"].alias("revenue"), money["profit"].alias("profit"),
             placed.alias("orders"), missing.alias("out_of_stock"), "visitors", "conversion_pct")
