"""Every query by name, as a function of a session and a folder of star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.operators import metrics
from tillwork.plans import basics, explore, features, models, quality, reports
from tillwork.session import prepare
from tillwork.sources import StarShop, streams
from tillwork.streaming import jobs, keyed, rollups, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}



def on_shop(name: str, build: Callable[[StarShop], DataFrame]) -> None:
    """Register a query that reads the star schema as a shop."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(StarShop(prepare(spark), folder))
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = run


def _reports() -> None:
    on_shop("q1_monthly_growth", reports.monthly_growth)
    on_shop("q1b_growth_lines", lambda s: reports.growth_lines(reports.monthly_growth(s)))
    on_shop("q1b_average_growth", lambda s: reports.average_growth(reports.monthly_growth(s)))
    on_shop("q2_top_customers", reports.top_customers)
    on_shop("q2b_best_customers", lambda s: reports.best_customers(reports.top_customers(s)))
    on_shop("q3_brand_returns", reports.brand_returns)
    on_shop("q3b_brand_return_spread",
            lambda s: reports.brand_return_spread(reports.brand_returns(s)))
    on_shop("q4_cohort_retention", reports.cohort_retention)
    on_shop("q4b_cohort_matrix", lambda s: reports.cohort_matrix(reports.cohort_retention(s)))
    on_shop("q5_traffic_funnel", reports.traffic_funnel)
    on_shop("q6_delivery_by_center", reports.delivery_by_center)
    on_shop("q6b_center_summary", lambda s: reports.center_summary(reports.delivery_by_center(s)))
    on_shop("q6b_center_matrix",
            lambda s: reports.center_matrix(reports.delivery_by_center(s)))
    on_shop("q7_rfm_segments", reports.rfm_segments)
    on_shop("q7_rfm_segments_standard", lambda s: reports.rfm_segments(s, scoring="standard"))
    on_shop("q7b_segment_summary", lambda s: reports.segment_summary(reports.rfm_segments(s)))


def _explore() -> None:
    on_shop("e11_monthly_revenue", explore.monthly_revenue)
    on_shop("e12_monthly_orders", explore.monthly_orders)
    on_shop("e13_status_shares", explore.status_shares)
    on_shop("e14_price_profile", explore.price_profile)
    on_shop("e14_price_histogram_p99", explore.price_histogram)
    on_shop("e14_price_histogram_full", lambda s: explore.price_histogram(s, 80, None))
    on_shop("e14_price_sample", explore.price_sample)
    on_shop("e15_age_distribution", explore.age_distribution)
    on_shop("e15_age_histogram", explore.age_histogram)
    on_shop("e21_gender_revenue", explore.gender_revenue)
    on_shop("e22_age_behaviour", explore.age_behaviour)
    on_shop("e23_source_conversion", explore.source_conversion)
    on_shop("e24_country_revenue", explore.country_revenue)
    on_shop("e25_country_returns", explore.country_returns)
    on_shop("e51_revenue_and_quantity", explore.revenue_and_quantity)
    on_shop("e52_category_margin", explore.category_margin)
    on_shop("e53_category_returns", explore.category_returns)
    on_shop("e54_double_risk", explore.double_risk)
    on_shop("e55_category_by_gender", explore.category_by_gender)
    on_shop("e61_source_order_value", explore.source_order_value)
    on_shop("e62_source_returns", explore.source_returns)
    on_shop("e63_delivery_overview", explore.delivery_overview)
    on_shop("e63_delivery_by_country", explore.delivery_by_country)
    on_shop("e63_delivery_boxes", explore.delivery_boxes)
    on_shop("e63_delivery_histogram", explore.delivery_histogram)
    on_shop("e63_delivery_sample", explore.delivery_sample)
    on_shop("e64_delivery_and_returns", explore.delivery_and_returns)
    on_shop("e64_delivery_correlation", explore.delivery_correlation)
    on_shop("join09_stock_units", explore.stock_units)


def _quality() -> None:
    tables = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
    on_shop("dq01_table_shapes", lambda s: quality.table_shapes(s, tables))
    on_shop("dq02_descriptive_statistics", quality.descriptive_statistics)
    on_shop("dq03_nulls", quality.nulls)
    on_shop("dq04_nulls_by_status", quality.nulls_by_status)
    on_shop("dq05_key_duplicates", quality.key_duplicates)
    on_shop("dq06_items_per_order", quality.items_per_order)
    on_shop("dq07_ranges", quality.ranges)
    on_shop("dq08_time_order", quality.time_order)
    on_shop("dq09_status_distribution", quality.status_distribution)
    # Pending is a status of live orders that the stored items lack; Shipped is left out to
    # show a surplus.
    on_shop("dq09_status_domain", lambda s: quality.status_domain(
        s, ["Complete", "Processing", "Cancelled", "Returned", "Pending"]))
    on_shop("dq10_orders_and_items_by_status", quality.orders_and_items_by_status)


# --- streams: the events table, replayed as the four topics -------------------------------
# An event comes every few minutes there, so the windows are hours instead of minutes.
HOUR, HOURS, HALF = "1 hour", "2 hours", "30 minutes"


def shown(df: DataFrame) -> DataFrame:
    """Times as text, and without the time of writing, which differs from run to run."""
    for name in ("window_start", "window_end", "last_updated"):
        if name in df.columns:
            df = df.withColumn(name, F.date_format(name, "yyyy-MM-dd HH:mm:ss"))
    return df.drop("processed_at")


def _orders(s: StarShop) -> DataFrame:
    return jobs.order_anomaly(streams.star_order_messages(s.table("events")), HOUR,
                              distinct="exact")


def _funnel(s: StarShop, length: str = HOUR, slide: str | None = None) -> DataFrame:
    return jobs.traffic_funnel(streams.star_web_events(s.table("events")), length, slide,
                               distinct="exact")


def _stock(s: StarShop) -> DataFrame:
    return jobs.inventory_state(streams.star_inventory_messages(s.table("events")))


def _revenue(s: StarShop, length: str = HOUR, slide: str | None = None) -> DataFrame:
    return jobs.revenue_dashboard(streams.star_revenue_messages(s.table("events")), length, slide,
                                  distinct="exact")


def _replayed(s: StarShop) -> DataFrame:
    # A pattern, since a stream of one fixed path must be a folder; the table may also be a file.
    return streams.replay(s.spark, f"{s.folder}/events.parque[t]", s.table("events").schema)


def _appended(s: StarShop, name: str, result: DataFrame) -> DataFrame:
    """Run a windowed job as a stream over the events and read its table back."""
    path = sinks.catch_up(lambda out, state: sinks.append_table(result, out, state, every=None),
                          s.spark, name)
    return streams.read_back(s.spark, path)


def _orders_stream(s: StarShop) -> DataFrame:
    result = jobs.order_anomaly(streams.star_order_messages(_replayed(s)), HOUR)
    return shown(_appended(s, "order_anomaly", result)).drop("unique_buyers")


def _funnel_stream(s: StarShop) -> DataFrame:
    result = jobs.traffic_funnel(streams.star_web_events(_replayed(s)), HOURS, HALF)
    return shown(_appended(s, "traffic_funnel", result))


def _in_five_steps(s: StarShop) -> DataFrame:
    """Events arrive in steps of six days; every tenth arrives two steps late."""
    late = F.when(F.col("event_id") % 10 == 0, 2).otherwise(0)
    step = F.least(F.lit(4), F.floor((F.dayofmonth("ts") - 1) / 6).cast("int") + late)
    return streams.replay_in_order(s.table("events"), step, 5, sinks.new_stream_folder(s.spark, "steps"))


def _late_orders_stream(s: StarShop) -> DataFrame:
    result = jobs.order_anomaly(streams.star_order_messages(_in_five_steps(s)), HOUR)
    return shown(_appended(s, "late_orders", result)).drop("unique_buyers")


def _exact_funnel_stream(s: StarShop) -> DataFrame:
    result = jobs.traffic_funnel(streams.star_web_events(_in_five_steps(s)), HOURS, None, distinct="exact")
    return shown(_appended(s, "exact_funnel", result))


def _stock_stream(s: StarShop, silence: str | None = None, late: str = "1 day") -> DataFrame:
    changes = keyed.inventory_changes(streams.star_inventory_messages(_replayed(s)), silence, late)
    path = sinks.catch_up(
        lambda out, kept: sinks.keyed_snapshots(changes, out, kept, alerts=f"{out}_alerts", every=None),
        s.spark, "inventory_alert")
    return shown(streams.latest_snapshot(s.spark, path))


def _revenue_stream(s: StarShop) -> DataFrame:
    result = jobs.revenue_dashboard(streams.star_revenue_messages(_replayed(s)), HOURS, HALF)
    return shown(_appended(s, "revenue_dashboard", result)).drop("unique_buyers")


def _streams() -> None:
    on_shop("s1_order_anomaly", lambda s: shown(_orders(s)))
    on_shop("s2_traffic_funnel", lambda s: shown(_funnel(s, HOURS, HALF)))
    on_shop("s2_funnel_reached", lambda s: shown(
        jobs.funnel_reached(streams.star_web_events(s.table("events")), "1 day")))
    on_shop("s3_inventory_state", lambda s: shown(_stock(s)))
    on_shop("s3_inventory_alerts", lambda s: shown(jobs.inventory_alerts(_stock(s))))
    on_shop("s4_revenue_dashboard", lambda s: shown(_revenue(s, HOURS, HALF)))
    on_shop("s1_order_anomaly_stream", _orders_stream)
    on_shop("s2_traffic_funnel_stream", _funnel_stream)
    on_shop("s3_inventory_snapshot_stream", _stock_stream)
    on_shop("str02_late_orders_stream", _late_orders_stream)
    on_shop("s2_exact_funnel_stream", _exact_funnel_stream)
    on_shop("s3_inventory_active_stream", lambda s: _stock_stream(s, "12 hours", "1 hour"))
    on_shop("s4_revenue_dashboard_stream", _revenue_stream)

    def outliers(s: StarShop) -> DataFrame:
        messages = streams.star_order_messages(s.table("events"))
        return jobs.outlier_orders(messages, jobs.price_statistics(messages))
    on_shop("str15_outlier_orders", outliers)

    on_shop("r1a_value_by_status", lambda s: rollups.value_by_status(_orders(s)))
    on_shop("r1b_anomaly_trend", lambda s: shown(rollups.anomaly_trend(_orders(s))))
    on_shop("r2a_funnel_totals", lambda s: rollups.funnel_totals(_funnel(s)))
    on_shop("r2b_visitors_by_source", lambda s: rollups.visitors_by_source(_funnel(s)))
    on_shop("r2b_distinct_visitors_sketch", lambda s: rollups.distinct_visitors_by_source(
        jobs.visitor_sketches(streams.star_web_events(s.table("events")), HOUR)))
    on_shop("r3a_stock_matrix", lambda s: rollups.stock_matrix(_stock(s)))
    on_shop("r3b_alert_counts", lambda s: rollups.alert_counts(_stock(s)))
    on_shop("r4a_category_revenue", lambda s: rollups.category_revenue(_revenue(s)))
    on_shop("r4b_margin_trend", lambda s: shown(rollups.margin_trend(_revenue(s))))
    on_shop("r5_key_figures", lambda s: rollups.key_figures(
        _orders(s), _funnel(s), _stock(s), _revenue(s)))


# --- features and models -----------------------------------------------------------------

def _vectors(df: DataFrame, labels: list[str], numbers: list[str], *keep: str) -> DataFrame:
    built = features.vectors(df, labels, numbers)
    return built.select(*features.KEYS, *keep, vector_to_array("features_scaled").alias("features"))


def _models() -> None:
    on_shop("p1_item_features", lambda s: features.item_features(s).drop("ordered_at"))
    on_shop("p2_return_vectors", lambda s: _vectors(
        features.return_input(features.item_features(s)), features.RETURN_LABELS,
        features.RETURN_NUMBERS, "is_returned"))
    on_shop("p3_rfm_features", lambda s: features.rfm_features(features.item_features(s)))
    on_shop("p4_price_vectors", lambda s: _vectors(
        features.price_input(features.item_features(s)), features.PRICE_LABELS,
        features.PRICE_NUMBERS, "sale_price"))
    on_shop("prj11_return_label", lambda s: features.return_input(features.item_master(s)).groupBy(
        "order_status", "is_returned").agg(F.count(F.lit(1)).alias("items")))

    def weights(s: StarShop) -> DataFrame:
        labelled = features.return_input(features.item_master(s)).select("is_returned")
        return labelled.withColumn("class_weight", models.class_weights(labelled, "is_returned")) \
            .groupBy("is_returned", "class_weight").agg(F.count(F.lit(1)).alias("items"))
    on_shop("ml07_class_weights", weights)
    on_shop("m1_return_prediction", models.return_report)
    on_shop("m2_customer_clusters", models.cluster_report)
    on_shop("m3_price_prediction", models.price_report)
    on_shop("m3_price_prediction_leak_free", lambda s: models.price_report(s, leak_free=True))
    on_shop("fil15_cluster_sample", lambda s: models.plot_sample(
        models.cluster_customers(s).predictions.select("user_id", "recency", "monetary", "cluster"), 200, "user_id"))
    on_shop("fil16_train_share", lambda s: models.split(
        s.items("order_id", "product_id", "sale_price"),
        ["order_id", "product_id", "sale_price"])[0].agg(F.count(F.lit(1)).alias("train_rows")))


def _slots(df: DataFrame, labels: list[str], numbers: list[str]) -> DataFrame:
    """What the slots of the scaled vectors hold: rows that are not zero, smallest and largest value."""
    return features.explained(features.vectors(df, labels, numbers)).groupBy("slot").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.min("value"), 6).alias("smallest"), F.round(F.max("value"), 6).alias("largest"))


def _metrics() -> None:
    def rated(s: StarShop) -> DataFrame:
        complete = features.item_master(s).dropna(subset=features.REQUIRED)
        return features.return_input(features.with_price_features(complete)).withColumn(
            "rate", F.round("discount_rate", 4))
    on_shop("ml09_roc_area", lambda s: metrics.roc_area(rated(s), "rate", "is_returned"))
    on_shop("ml10_roc_points", lambda s: models.roc_points(rated(s).select("is_returned", "rate"), score="rate"))
    on_shop("ml06_feature_scores", lambda s: metrics.f_scores(
        rated(s), "is_returned", models.RETURN_NUMBERS, models.LABELS, models.SELECTED))
    on_shop("ml13_silhouette", lambda s: metrics.silhouette(
        reports.rfm_segments(s), "rfm_segment", ["recency_days", "frequency", "monetary"]).withColumn(
        "silhouette", F.round("silhouette", 6)))

    def by_category(s: StarShop) -> DataFrame:
        items = rated(s).select("category", metrics.exact(F.col("sale_price")).alias("price"))
        means = items.groupBy("category").agg(F.round(F.sum("price").cast("double") / F.count("price"), 6).alias("mean"))
        return metrics.root_mean_square(items.join(means, "category"), "price", "mean")
    on_shop("ml15_rmse", by_category)
    on_shop("ml02_label_order", lambda s: metrics.label_order(rated(s), features.RETURN_LABELS))
    on_shop("p2_vector_slots", lambda s: _slots(
        features.return_input(features.item_features(s)), features.RETURN_LABELS, features.RETURN_NUMBERS))
    on_shop("p4_vector_slots", lambda s: _slots(
        features.price_input(features.item_features(s)), features.PRICE_LABELS, features.PRICE_NUMBERS))
    on_shop("agg16_distinct_within_bound", lambda s: metrics.distinct_estimates(
        s.items("status", "user_id"), ["status"], "user_id").select("status", "exact", "within_bound"))
    on_shop("r2b_sketches_within_bound", _sketch_check)
    on_shop("fil15_sample_members", lambda s: models.plot_sample(s.users("user_id", "country"), 200, "user_id"))


def _sketch_check(s: StarShop) -> DataFrame:
    messages = streams.star_web_events(s.table("events"))
    merged = rollups.distinct_visitors_by_source(jobs.visitor_sketches(messages, HOUR), n=100)
    exact = messages.select("traffic_source", "user_id").distinct().groupBy("traffic_source").agg(
        F.count("user_id").alias("exact"))
    return exact.join(merged, "traffic_source").select(
        "traffic_source", "exact", (F.abs(F.col("unique_users") - F.col("exact")) <= 0.05 * F.col("exact") + 1).alias("within_bound"))


# --- single operators ----------------------------------------------------------------------

def _operators() -> None:
    on_shop("src02_quoted_csv", basics.quoted_csv)
    on_shop("src03_sql_views", basics.sql_views)
    on_shop("src05_json_decode", basics.json_decode)
    on_shop("prj02_clean_timestamp", basics.clean_timestamps)
    on_shop("prj03_delivery_days", basics.delivery_days)
    on_shop("prj05_status_flags", basics.status_flags)
    on_shop("prj07_age_band", basics.age_bands)
    on_shop("prj09_item_margins", basics.item_margins)
    on_shop("agg12_quartiles", basics.quartiles)
    on_shop("agg16_approximate_distinct", basics.approximate_buyers)
    on_shop("fn_scalar_functions", basics.scalar_functions)
    on_shop("q1_monthly_growth_every_month", lambda s: reports.monthly_growth(s, every_month=True))
    on_shop("q7_rfm_segments_approximate", lambda s: reports.rfm_segments(s, tiles="approximate"))


_operators()
_reports()
_explore()
_quality()
_streams()
_models()
_metrics()
