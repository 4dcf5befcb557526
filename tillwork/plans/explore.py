"""Exploratory analyses: business overview, customers, products, channels and delivery.

The customer analyses share :func:`customer_totals`: items are added up per order, orders per
customer. Distinct orders and buyers are then sums and counts of rows, no attribute value with
most of the rows reaches one task, and Spark prunes the totals an analysis does not use.
Revenue means completed items here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.functions.columns import (
    AGE_LABELS, AGE_TOP_FOR_DISTRIBUTION, COMPLETE, RETURNED, UNKNOWN_AGE, age_band,
    correlation_verdict, flag, margin_pct, mean, percent, position_in, profit, ratio,
    risk_quadrant, rounded, seconds_between)
from tillwork.operators.distribution import (
    column_quantiles, counted_values, histogram, in_share, moments_of_counts, share_of_max,
    share_of_total)
from tillwork.operators.ranking import average_rank, with_running_sums
from tillwork.operators.shape import in_order, spread
from tillwork.sources.shop import Shop

DAY = 86400
DETAIL = 6  # digits kept of figures that come from float sums


def _complete() -> Column:
    return F.col("status").isin(COMPLETE)


def _money(column: str = "sale_price") -> Column:
    return F.col(column).cast("decimal(18,4)")


def _everywhere() -> Window:
    return Window.partitionBy()


# --- business overview ------------------------------------------------------------------

def _monthly(shop: Shop) -> DataFrame:
    per_order = shop.order_totals([F.sum(_money()).alias("revenue")], statuses=COMPLETE,
                                  fields=("user_id", "month"))
    return per_order.groupBy("month").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("revenue").alias("exact"))


def monthly_revenue(shop: Shop) -> DataFrame:
    """Revenue by month, with total, peak month and average monthly growth alongside."""
    by_time = Window.orderBy("month")
    revenue = F.col("exact").cast("double")
    before = F.lag(revenue).over(by_time)
    lines = _monthly(shop).select("month", revenue.alias("revenue"), "exact",
                                  ((revenue / before) - 1).alias("growth"))
    peak = F.max_by(F.struct("month", "revenue"), "exact").over(_everywhere())
    return lines.select(
        "month", "revenue", F.sum("exact").over(_everywhere()).cast("double").alias("total_revenue"),
        peak["month"].alias("peak_month"), peak["revenue"].alias("peak_revenue"),
        rounded(F.avg("growth").over(_everywhere()) * 100, DETAIL).alias("avg_growth_pct"),
    ).orderBy("month")


def monthly_orders(shop: Shop) -> DataFrame:
    """Orders and average order value by month, and the means of both."""
    lines = _monthly(shop).select("month", "orders", F.col("exact").cast("double").alias("revenue"),
                                  ratio(F.col("exact"), F.col("orders")).alias("aov"))
    return lines.select(
        "*", ratio(F.sum("orders").over(_everywhere()), F.count("orders").over(_everywhere()))
        .alias("avg_monthly_orders"),
        rounded(F.avg("aov").over(_everywhere()), DETAIL).alias("avg_aov")).orderBy("month")


def status_shares(shop: Shop) -> DataFrame:
    counts = shop.items("status").groupBy("status").agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("pct", rounded(share_of_total("count"))).orderBy(
        F.desc("count"), "status")


def price_profile(shop: Shop) -> DataFrame:
    """Range, mean and exact percentiles of the item price: one row."""
    prices = shop.items("sale_price")
    cuts = column_quantiles(prices, ["sale_price"], [0.5, 0.75, 0.9, 0.95, 0.99])["sale_price"]
    return prices.agg(
        F.min("sale_price").cast("double").alias("min"),
        F.max("sale_price").cast("double").alias("max"),
        mean(F.sum(_money()), F.count("sale_price")).alias("mean"),
    ).withColumn("cuts", cuts).select(
        "min", "max", "mean", *(F.col("cuts")[i].alias(name) for i, name in enumerate(
            ("p50", "p75", "p90", "p95", "p99"))))


def price_histogram(shop: Shop, bins: int = 60, cap: float | None = 0.99) -> DataFrame:
    """Bars over the prices up to the ``cap`` quantile, or over all prices without one."""
    prices = shop.items("sale_price")
    upper = None if cap is None else column_quantiles(prices, ["sale_price"], [cap])["sale_price"][0]
    return histogram(prices, "sale_price", bins, upper)


def price_sample(shop: Shop, per_mille: int = 100) -> DataFrame:
    """The prices of a share of the items, chosen by their key, for a plot of single points."""
    priced = shop.items("order_id", "item_no", "sale_price").filter("sale_price IS NOT NULL")
    return priced.filter(in_share(per_mille, "order_id", "item_no")).select("sale_price")


def age_distribution(shop: Shop) -> DataFrame:
    """Users per age band, with mean, median and deviation of the age over all bands.

    The bands end at 120 here; ages outside are left out of the bands, not of the statistics.
    """
    ages = counted_values(shop.users("age").filter(F.col("age").isNotNull()), [], "age")
    stats = moments_of_counts("age")
    overall = ages.agg(F.struct(
        rounded(stats["mean"], DETAIL).alias("mean"), rounded(stats["std"], DETAIL).alias("std"),
        F.percentile("age", 0.5, F.col("n")).alias("median")).alias("o")).scalar()
    label = age_band(F.col("age"), AGE_TOP_FOR_DISTRIBUTION)
    bands = (ages.filter("age >= 0").withColumn("age_group", label)
             .filter(F.col("age_group") != UNKNOWN_AGE)
             .groupBy("age_group").agg(F.sum("n").alias("count")))
    return bands.select(
        "age_group", "count", share_of_total("count").alias("pct"),
        overall["mean"].alias("mean_age"), overall["median"].alias("median_age"),
        overall["std"].alias("std_age")).orderBy(position_in(F.col("age_group"), AGE_LABELS))


def age_histogram(shop: Shop, bins: int = 50) -> DataFrame:
    return histogram(shop.users("age"), "age", bins)


# --- customers --------------------------------------------------------------------------

def customer_totals(shop: Shop) -> DataFrame:
    """Orders, items and revenue of each customer."""
    done = _complete()
    per_order = shop.order_totals([
        F.count("status").alias("items"),
        F.sum(flag(F.col("status") == RETURNED)).alias("returned"),
        F.sum(flag(done)).alias("done"),
        F.count(F.when(done, F.col("sale_price"))).alias("priced"),
        F.sum(F.when(done, _money())).alias("revenue"),
        F.sum(_money()).alias("value"),
    ])
    return per_order.groupBy("user_id").agg(
        F.sum("items").alias("items"), F.sum("returned").alias("returned"),
        F.sum(flag(F.col("done") > 0)).alias("done_orders"), F.sum("priced").alias("priced"),
        F.sum("revenue").alias("revenue"), F.sum("value").alias("value"))


def market(shop: Shop, column: str, value: Column | None = None) -> DataFrame:
    """:func:`customer_totals` added up by a user attribute (``value`` derives it)."""
    attribute = F.col(column) if value is None else value
    people = shop.users("user_id", "age" if value is not None else column)
    named = customer_totals(shop).join(
        people.select("user_id", attribute.alias(column)), "user_id", "left")
    return named.groupBy(column).agg(
        F.count(F.lit(1)).alias("users"), F.sum(flag(F.col("done_orders") > 0)).alias("buyers"),
        F.sum("done_orders").alias("orders"), F.sum("items").alias("items"),
        F.sum("returned").alias("returned"), F.sum("priced").alias("priced"),
        F.sum("revenue").alias("revenue"), F.sum("value").alias("value"))


def _figure(column: str) -> Column:
    return F.col(column).cast("double")


def gender_revenue(shop: Shop) -> DataFrame:
    totals = market(shop, "gender").filter(F.col("gender").isin("M", "F")).filter("buyers > 0")
    return totals.select(
        "gender", _figure("revenue").alias("total_revenue"), F.col("buyers").alias("unique_buyers"),
        F.col("orders").alias("total_orders"),
        ratio(F.col("revenue"), F.col("priced")).alias("avg_item_price"),
        ratio(F.col("revenue"), F.col("buyers")).alias("revenue_per_buyer"),
        ratio(F.col("orders"), F.col("buyers")).alias("orders_per_buyer")).orderBy("gender")


def age_behaviour(shop: Shop) -> DataFrame:
    """Buyers, frequency and basket by age band, in band order."""
    totals = market(shop, "age_group", age_band(F.col("age")))
    known = totals.filter(F.col("age_group") != UNKNOWN_AGE).filter("buyers > 0")
    figures = known.select(
        "age_group", F.col("buyers").alias("unique_buyers"), F.col("orders").alias("total_orders"),
        _figure("revenue").alias("total_revenue"),
        ratio(F.col("revenue"), F.col("priced")).alias("avg_item_price"),
        ratio(F.col("orders"), F.col("buyers")).alias("orders_per_buyer"),
        ratio(F.col("revenue"), F.col("buyers")).alias("revenue_per_buyer"))
    overall = rounded(F.avg("orders_per_buyer").over(_everywhere()), DETAIL)
    return in_order(figures.withColumn("avg_orders_per_buyer", overall), "age_group", AGE_LABELS,
                    keep_absent=False)


def source_conversion(shop: Shop) -> DataFrame:
    """Share of each source's ordering users that completed an order.

    Users without any item are not counted (the traffic funnel counts them).
    """
    totals = market(shop, "traffic_source").filter(F.col("traffic_source").isNotNull())
    figures = totals.select(
        "traffic_source", F.col("users").alias("total_users"),
        F.col("buyers").alias("converted_users"), _figure("value").alias("total_revenue"),
        percent(F.col("buyers"), F.col("users")).alias("conversion_rate"),
        ratio(F.col("value"), F.col("users")).alias("revenue_per_user"))
    middle = F.median("conversion_rate").over(_everywhere())
    return figures.withColumns({
        "median_conversion": rounded(middle, DETAIL),
        "above_median": F.col("conversion_rate") >= middle,
        "size_share": share_of_max("total_users"),
    }).orderBy(F.desc("conversion_rate"), "traffic_source")


def country_revenue(shop: Shop, n: int = 20) -> DataFrame:
    totals = market(shop, "country").filter(F.col("country").isNotNull()).filter("buyers > 0")
    return (totals.orderBy(F.desc("revenue"), "country").limit(n).select(
        "country", _figure("revenue").alias("revenue"), "buyers",
        ratio(F.col("revenue"), F.col("priced")).alias("avg_item_price"),
        ratio(F.col("revenue"), F.col("buyers")).alias("revenue_per_buyer"))
        .orderBy(F.desc("revenue"), "country"))


def country_returns(shop: Shop, n: int = 20, at_least: int = 100) -> DataFrame:
    """The ``n`` countries with the highest return rate among those with enough items.

    ``revenue`` is given for the ``n`` countries of :func:`country_revenue` only; both rankings
    come from the same totals, so the facts are read once.
    """
    totals = market(shop, "country").filter(F.col("country").isNotNull())
    place = F.rank().over(Window.orderBy(F.desc_nulls_last("revenue"), "country"))
    rated = totals.withColumn("_place", place).filter(F.col("items") >= at_least).select(
        "country", F.col("items").alias("total_items"), F.col("returned").alias("returned_items"),
        percent(F.col("returned"), F.col("items")).alias("return_rate"),
        F.when(F.col("_place") <= n, _figure("revenue")).alias("revenue"))
    middle = rounded(F.median("return_rate").over(_everywhere()), DETAIL)
    return (rated.withColumn("median_return_rate", middle)
            .orderBy(F.desc("return_rate"), "country").limit(n)
            .withColumn("plotted", F.when(F.col("revenue").isNotNull(), F.col("total_items")))
            .withColumn("size_share", share_of_max("plotted")).drop("plotted")
            .orderBy(F.desc("return_rate"), "country"))


# --- products ---------------------------------------------------------------------------

def _per_category(shop: Shop, *metrics: Column, totals: Sequence[Column]) -> DataFrame:
    """Items per product first: that shuffle also serves the join, and evens out hot products."""
    per_product = shop.items("product_id", "status", "sale_price").groupBy("product_id").agg(*metrics)
    return (per_product.join(shop.products("product_id", "category"), "product_id", "left")
            .groupBy("category").agg(*totals))


def revenue_and_quantity(shop: Shop) -> DataFrame:
    """Categories ranked by revenue and by quantity; ties get the mean of their places."""
    done = _complete()
    sold = _per_category(
        shop, F.sum(F.when(done, _money())).alias("revenue"),
        F.count(F.when(done, F.col("sale_price"))).alias("quantity"),
        F.sum(flag(done)).alias("done"),
        totals=[F.sum("revenue").alias("revenue"), F.sum("quantity").alias("quantity"),
                F.sum("done").alias("done")]).filter("done > 0")
    ranked = sold.select("category", _figure("revenue").alias("revenue"), "quantity",
                         average_rank("revenue").alias("rev_rank"),
                         average_rank("quantity").alias("qty_rank"))
    gap = F.abs(F.col("qty_rank") - F.col("rev_rank"))
    return ranked.withColumn("rank_diff", gap).orderBy(F.desc("rank_diff"), "category")


def _category_margins(shop: Shop) -> DataFrame:
    """Margins of completed items and return rates of all items, in one pass."""
    done = _complete()
    sale, cost = F.col("sale_price"), F.col("cost")
    return shop.priced_items("category", "status", "sale_price", "cost").groupBy("category").agg(
        rounded(F.avg(F.when(done, margin_pct(sale, cost))), DETAIL).alias("avg_margin"),
        F.sum(F.when(done, profit(_money(), _money("cost")))).cast("double").alias("total_profit"),
        mean(F.sum(F.when(done, _money())), F.count(F.when(done, sale))).alias("avg_sale_price"),
        mean(F.sum(F.when(done, _money("cost"))), F.count(F.when(done, cost))).alias("avg_cost"),
        F.count("status").alias("total_items"),
        F.sum(flag(F.col("status") == RETURNED)).alias("returned_items"),
        F.sum(flag(done)).alias("done"))


def category_margin(shop: Shop) -> DataFrame:
    figures = _category_margins(shop).filter("done > 0").select(
        "category", "avg_margin", "total_profit", "avg_sale_price", "avg_cost")
    middle = rounded(F.median("avg_margin").over(_everywhere()), DETAIL)
    return figures.withColumn("median_margin", middle).orderBy(F.desc("avg_margin"), "category")


def category_returns(shop: Shop) -> DataFrame:
    counts = _per_category(
        shop, F.count("status").alias("items"),
        F.sum(flag(F.col("status") == RETURNED)).alias("returned"),
        totals=[F.sum("items").alias("total_items"), F.sum("returned").alias("returned_items")])
    rated = counts.withColumn("return_rate", percent(F.col("returned_items"), F.col("total_items")))
    middle = rounded(F.median("return_rate").over(_everywhere()), DETAIL)
    return rated.withColumn("median_return_rate", middle).orderBy(F.desc("return_rate"), "category")


def double_risk(shop: Shop) -> DataFrame:
    """Categories by return rate and margin against the medians of both."""
    rated = _category_margins(shop).filter("done > 0").filter(F.col("category").isNotNull()).select(
        "category", "avg_margin", "total_profit", "total_items",
        percent(F.col("returned_items"), F.col("total_items")).alias("return_rate"))
    return rated.withColumns({
        "quadrant": risk_quadrant(
            F.col("return_rate"), F.median("return_rate").over(_everywhere()),
            F.col("avg_margin"), F.median("avg_margin").over(_everywhere())),
        "size_share": share_of_max("total_items"),
    }).orderBy(F.desc("return_rate"), "category")


def category_by_gender(shop: Shop) -> DataFrame:
    """Revenue by gender for each category, and its split in percent."""
    sold = shop.items("product_id", "sale_price", "gender", statuses=COMPLETE)
    cells = sold.filter(F.col("gender").isin("F", "M")).join(
        shop.products("product_id", "category"), "product_id", "left")
    wide = spread(cells, "category", "gender", ["F", "M"], F.sum(_money()), fill=0)
    women, men = F.col("F").cast("double"), F.col("M").cast("double")
    total = (F.col("F") + F.col("M")).cast("double")
    return wide.select("category", women.alias("revenue_f"), men.alias("revenue_m"),
                       percent(women, total).alias("pct_f"), percent(men, total).alias("pct_m"),
                       total.alias("total")).orderBy(F.desc("total"), "category").drop("total")


# --- channels ---------------------------------------------------------------------------

def source_order_value(shop: Shop) -> DataFrame:
    totals = market(shop, "traffic_source").filter("buyers > 0")
    return totals.select(
        "traffic_source", _figure("revenue").alias("total_revenue"),
        F.col("orders").alias("total_orders"), F.col("buyers").alias("total_users"),
        ratio(F.col("revenue"), F.col("orders")).alias("aov"),
        ratio(F.col("revenue"), F.col("buyers")).alias("revenue_per_user"),
    ).orderBy(F.desc("aov"), "traffic_source")


def source_returns(shop: Shop) -> DataFrame:
    """Return rate next to order value by source."""
    totals = market(shop, "traffic_source").filter(
        F.col("traffic_source").isNotNull() & (F.col("buyers") > 0))
    rated = totals.select(
        "traffic_source", F.col("items").alias("total_items"), "returned",
        percent(F.col("returned"), F.col("items")).alias("return_rate"),
        ratio(F.col("revenue"), F.col("orders")).alias("aov"))
    middle = rounded(F.median("return_rate").over(_everywhere()), DETAIL)
    return rated.withColumn("median_return_rate", middle).orderBy(
        F.desc("return_rate"), "traffic_source")


# --- delivery ---------------------------------------------------------------------------

def _delivery_counts(shop: Shop, most_days: int) -> DataFrame:
    """Per country and seconds from shipping to delivery: deliveries, items and returns.

    Only spans inside the open range of days count as deliveries (``n``); everything else is
    one row per country. The range bounds the number of rows, so all delivery statistics are
    exact and read the facts once.
    """
    span = seconds_between(F.col("shipped_at"), F.col("delivered_at"))
    timed = shop.items("status", "shipped_at", "delivered_at", "country").select(
        "country", "status", F.when((span > 0) & (span < most_days * DAY), span).alias("seconds"))
    return timed.groupBy("country", "seconds").agg(
        F.count("seconds").alias("n"), F.count("status").alias("items"),
        F.sum(flag(F.col("status") == RETURNED)).alias("returned"))


def _in_days(seconds: Column) -> Column:
    return seconds.cast("double") / DAY


def _delivery_statistics(shop: Shop, most_days: int, top: int) -> DataFrame:
    """Exact statistics of the countries with most deliveries.

    They are computed for every country; the few rows of the result are then cut to the top.
    """
    counts = _delivery_counts(shop, most_days)
    window = Window.partitionBy("country")
    ranked = counts.withColumns({
        "upto": F.sum("n").over(window.orderBy("seconds")), "all": F.sum("n").over(window)})
    stats = moments_of_counts("seconds")
    reached = F.col("upto") >= F.ceil(F.col("all") / F.lit(2))
    per_country = ranked.groupBy("country").agg(
        _in_days(F.min(F.when(reached, F.col("seconds")))).alias("median_days"),
        (stats["mean"] / DAY).alias("mean_days"), (stats["std"] / DAY).alias("std_days"),
        stats["count"].alias("count"), F.sum("items").alias("total_items"),
        percent(F.sum("returned"), F.sum("items")).alias("return_rate"))
    busiest = per_country.filter("count > 0").orderBy(F.desc("count"), "country").limit(top)
    return busiest.filter(F.col("country").isNotNull())


def delivery_overview(shop: Shop, most_days: int = 60) -> DataFrame:
    """Deliveries, mean and median days over all countries: one row."""
    counts = _delivery_counts(shop, most_days).groupBy("seconds").agg(F.sum("n").alias("n"))
    ranked = with_running_sums(counts.filter("seconds IS NOT NULL"), [F.asc("seconds")], {"upto": "n"})
    stats = moments_of_counts("seconds")
    reached = F.col("upto") >= F.ceil(F.col("upto_all") / F.lit(2))
    return ranked.agg(
        stats["count"].alias("n"), rounded(stats["mean"] / DAY, DETAIL).alias("mean_days"),
        rounded(_in_days(F.min(F.when(reached, F.col("seconds")))), DETAIL).alias("median_days"))


def delivery_by_country(shop: Shop, most_days: int = 60, top: int = 12) -> DataFrame:
    """Median, mean and deviation of delivery days of the countries with most deliveries."""
    return _delivery_statistics(shop, most_days, top).select(
        "country", *(rounded(F.col(c)).alias(c) for c in ("median_days", "mean_days", "std_days")),
        "count").orderBy("median_days", "country")


def delivery_boxes(shop: Shop, most_days: int = 60, top: int = 12) -> DataFrame:
    """Box-plot figures of delivery days, fastest median first."""
    counts = _delivery_counts(shop, most_days).filter("seconds IS NOT NULL")
    marks = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}
    boxes = counts.groupBy("country").agg(
        F.sum("n").alias("count"),
        F.percentile("seconds", F.array(*map(F.lit, marks.values())), F.col("n")).alias("cuts"))
    boxes = boxes.select("country", "count", *(F.col("cuts")[i].alias(name) for i, name in enumerate(marks)))
    busiest = boxes.orderBy(F.desc("count"), "country").limit(top).filter(
        F.col("country").isNotNull())
    return busiest.select("country", *(rounded(_in_days(F.col(c)), DETAIL).alias(c) for c in marks)
                          ).orderBy("median", "country")


def delivery_histogram(shop: Shop, most_days: int = 60, bins: int = 40) -> DataFrame:
    days = _in_days(seconds_between(F.col("shipped_at"), F.col("delivered_at")))
    spans = shop.items("shipped_at", "delivered_at").select(days.alias("days"))
    return histogram(spans.filter((F.col("days") > 0) & (F.col("days") < most_days)), "days", bins)


def delivery_sample(shop: Shop, most_days: int = 60, per_mille: int = 50) -> DataFrame:
    """The delivery times of a share of the items, chosen by their key, for single points."""
    days = _in_days(seconds_between(F.col("shipped_at"), F.col("delivered_at")))
    spans = shop.items("order_id", "item_no", "shipped_at", "delivered_at").filter(
        in_share(per_mille, "order_id", "item_no")).select(days.alias("days"))
    return spans.filter((F.col("days") > 0) & (F.col("days") < most_days))


def delivery_and_returns(shop: Shop, most_days: int = 60, top: int = 12) -> DataFrame:
    """Median delivery days and return rate of the countries with most deliveries."""
    return _delivery_statistics(shop, most_days, top).select(
        "country", "median_days", "total_items", "return_rate").orderBy("median_days", "country")


def delivery_correlation(shop: Shop, most_days: int = 60, top: int = 12) -> DataFrame:
    """Pearson correlation and least-squares line of return rate on median days: one row.

    Where all countries share one median (or one rate), the correlation is null and its verdict weak.
    """
    days, rate = "median_days", "return_rate"
    # Not corr(): without a spread it divides by zero, an error in ANSI mode.
    r = F.try_divide(F.covar_pop(days, rate), F.stddev_pop(days) * F.stddev_pop(rate))
    fit = _delivery_statistics(shop, most_days, top).agg(
        r.alias("r"), F.regr_slope(rate, days).alias("slope"),
        F.regr_intercept(rate, days).alias("intercept"), F.count(F.lit(1)).alias("countries"))
    return fit.select(*(rounded(F.col(c), DETAIL).alias(c) for c in ("r", "slope", "intercept")),
                      "countries", correlation_verdict(F.col("r")).alias("verdict"))


# --- inventory --------------------------------------------------------------------------

def stock_units(shop: Shop) -> DataFrame:
    """Each unit with its product, whether it is sold, and the days it took to sell."""
    units = shop.stock("product_id", "created_at", "sold_at").join(
        shop.products("product_id", "category", "name"), "product_id", "left")
    return units.withColumns({
        "days_to_sell": seconds_between(F.col("created_at"), F.col("sold_at")) / F.lit(float(DAY)),
        "is_sold": F.col("sold_at").isNotNull().cast("int")})
