"""Reports over the shop's own CSV files, with the odd cases that stored tables lack."""

from tillwork.plans import explore, features, quality, reports


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def test_quoted_multiline_fields(shop):
    ann = shop.table("users").filter("id = 1").first()
    assert ann["last_name"] == 'O"Neil, Jr' and ann["street_address"] == "1 Road\nFlat 2"
    assert shop.users("user_id", "full_name").filter("user_id = 1").first()[1] == 'Ann O"Neil, Jr'


def test_times_are_cleaned(shop):
    created = {r["user_id"]: r["created_at"] for r in shop.users("user_id", "created_at").collect()}
    assert created[1].isoformat() == "2023-01-05T08:00:00" and created[6] is None


def test_parquet_copy_gives_the_same(shop, tmp_path):
    copy = shop.to_parquet(str(tmp_path / "tables"))
    assert rows(reports.monthly_growth(copy)) == rows(reports.monthly_growth(shop))


def test_monthly_growth_skips_gaps_unless_filled(shop):
    got = rows(reports.monthly_growth(shop), "category", "order_month", "monthly_revenue",
               "prev_month_revenue", "mom_growth_pct", "cumulative_revenue")
    assert got == [("Jeans", "2023-03", 61.0, None, None, 61.0),
                   ("Jeans", "2023-05", 9.0, 61.0, -85.25, 70.0),
                   ("Swim", "2023-04", 25.0, None, None, 25.0)]
    filled = rows(reports.monthly_growth(shop, every_month=True).filter("category = 'Jeans'"),
                  "order_month", "monthly_revenue", "mom_growth_pct")
    # Growth on a month without revenue is unknown, not an error.
    assert filled == [("2023-03", 61.0, None), ("2023-04", 0.0, -100.0), ("2023-05", 9.0, None)]


def test_top_customers(shop):
    got = rows(reports.top_customers(shop), "country", "user_id", "total_orders", "total_items",
               "total_spent", "avg_item_price", "rank_in_country")
    assert got == [(None, 5, 1, 1, 25.0, 25.0, 1), ("France", 1, 2, 3, 59.0, 19.67, 1),
                   ("Japan", 3, 1, 1, 11.0, 11.0, 1)]


def test_brand_returns_need_a_brand(shop):
    got = rows(reports.brand_returns(shop), "brand", "total_sold", "total_returned", "return_rate_pct",
               "performance_flag")
    assert got == [("Acme", 4, 0, 0.0, "At Average"), ("Wave", 3, 1, 33.33, "At Average")]


def test_traffic_funnel_counts_users_without_orders(shop):
    got = {r["traffic_source"]: r for r in reports.traffic_funnel(shop).collect()}
    display = got["Display"]
    assert (display["total_users"], display["total_orders"], display["total_revenue"]) == (1, 0, 0.0)
    assert display["completion_rate_pct"] is None and display["order_conversion_rate_pct"] == 0.0
    assert (got["Search"]["total_orders"], got["Search"]["completed_orders"]) == (4, 4)
    assert (got["Email"]["returned_orders"], got["Email"]["total_users"]) == (1, 2)


def test_cohorts(shop):
    got = rows(reports.cohort_retention(shop), "cohort_month", "order_month", "active_users",
               "cohort_size", "retention_rate_pct")
    assert ("2023-01", "2023-03", 1, 1, 100.0) in got and ("2023-01", "2023-05", 1, 1, 100.0) in got


def test_delivery_goes_through_the_inventory(shop):
    got = rows(reports.delivery_by_center(shop), "distribution_center", "category", "total_items",
               "avg_delivery_days", "median_delivery_days", "return_rate_pct")
    assert got == [("North", "Swim", 2, 30.0, 1.0, 50.0), ("North", "Jeans", 1, 3.0, 3.0, 0.0),
                   ("South", "Jeans", 2, 29.5, -2.0, 0.0)]


def test_rfm_scores_only_buyers(shop):
    got = rows(reports.rfm_segments(shop).orderBy("user_id"), "user_id", "frequency", "monetary")
    assert got == [(1, 2, 59.0), (3, 1, 11.0), (5, 1, 25.0)]
    summary = rows(reports.segment_summary(reports.rfm_segments(shop)), "rfm_segment", "customers")
    assert [s for s, _ in summary][0] == "Champions" and sum(n or 0 for _, n in summary) == 3


def test_delivery_range_is_open(shop):
    # 2.5 and 58.9 days count; 0 days, a delivery before the shipping and 60 days do not.
    got = rows(explore.delivery_overview(shop), "n", "median_days")
    assert got == [(2, 2.5)]
    assert rows(explore.delivery_by_country(shop), "country", "count") == [("France", 1)]


def test_age_and_gender(shop):
    bands = dict(rows(explore.age_distribution(shop), "age_group", "count"))
    assert bands == {"<18": 1, "18–24": 1, "55–64": 1, "65+": 1}
    assert rows(explore.age_behaviour(shop), "age_group", "unique_buyers") == [("<18", 1), ("55–64", 1)]
    assert rows(explore.gender_revenue(shop), "gender", "total_revenue") == [("F", 50.0), ("M", 11.0)]


def test_unmatched_product_has_no_category(shop):
    got = {r["category"]: r["total_items"] for r in explore.category_returns(shop).collect()}
    assert got == {"Jeans": 4, "Swim": 3, None: 1}


def test_quality(shop):
    assert rows(quality.time_order(shop)) == [(1,)]
    assert sorted(rows(quality.status_domain(shop))) == [("Mystery", "unexpected"), ("Processing", "missing")]
    nulls = {(r["table"], r["column"]): r["null_count"] for r in quality.nulls(shop).collect()}
    assert nulls[("items", "status")] == 1 and nulls[("users", "country")] == 1
    assert nulls[("users", "created_at")] == 1
    ranges = {r["check"]: r for r in quality.ranges(shop).collect()}
    assert (ranges["sale_price"]["suspicious"], ranges["sale_price"]["nulls"]) == (2, 1)
    assert (ranges["age"]["suspicious"], ranges["age"]["nulls"]) == (1, 1)
    both = {r["status"]: (r["orders_count"], r["items_count"])
            for r in quality.orders_and_items_by_status(shop).collect()}
    assert both["Mystery"] == (0, 1) and both["Complete"] == (3, 4)


def test_stock_units(shop):
    got = {r["days_to_sell"] for r in explore.stock_units(shop).filter("is_sold = 1").collect()}
    assert got == {1.5} and explore.stock_units(shop).count() == 6


def test_features_need_all_inputs(shop):
    # Known product, priced, and a buyer with gender: the Mystery and unpriced items go.
    got = features.item_features(shop)
    assert got.count() == 6
    zero_retail = got.filter("retail_price = 0").select("discount_rate").distinct().collect()
    assert [r[0] for r in zero_retail] == [0.0]
    assert features.price_input(got).filter("sale_price <= 0").count() == 0


def test_sources_agree_on_columns(shop, star):
    for name in ("items", "orders", "users", "products", "inventory", "stock", "centers", "web_events"):
        ours, theirs = getattr(star, name)().columns, getattr(shop, name)().columns
        assert set(ours) <= set(theirs), name
