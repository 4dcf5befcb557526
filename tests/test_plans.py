"""The plans Spark makes of the queries."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tillwork.plans import explore, reports
from tillwork.registry import QUERIES

# These run jobs while they are built; what they return reads stored results.
EAGER = ("s1_order_anomaly_stream", "s2_traffic_funnel_stream", "s2_exact_funnel_stream", "str02_",
         "s3_inventory_snapshot_stream", "s3_inventory_active_stream",
         "s4_revenue_dashboard_stream", "m1_", "m2_", "m3_", "fil15", "p2_", "p4_")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plan as for tables that are too large to broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if not n.startswith(EAGER)])
def test_no_python_rows_and_no_cross_joins(spark, no_broadcast, name):
    text = plan(QUERIES[name](spark, SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text, node


def test_status_filter_and_columns_reach_the_scan(star):
    text = plan(reports.top_customers(star))
    scan = next(line for line in text.splitlines() if "l_orderkey" in line and "FileScan" in line)
    assert "EqualTo(l_returnflag,A)" in scan
    read = re.search(r"FileScan parquet \[([^\]]*)\]", scan).group(1)
    assert {c.split("#")[0] for c in read.split(",")} == {
        "l_orderkey", "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus"}


def test_columns_of_the_order_are_joined_only_when_asked_for(star):
    assert "Join" not in plan(star.items("status", "sale_price"))
    assert "o_orderkey" in plan(star.items("created_at"))
    assert "n_name" not in plan(star.users("user_id", "gender"))


def test_top_customers_limits_each_task_before_the_shuffle(star):
    assert re.search(r"WindowGroupLimit.*Partial", plan(reports.top_customers(star)))


def test_orders_are_added_up_before_they_are_joined(star, no_broadcast):
    text = plan(reports.top_customers(star))
    # lineitem by order, orders by order, per user, customers by user, nation twice, rank, sort
    assert text.count("Exchange hashpartitioning") == 7
    assert text.count("FileScan") == 4


def test_delivery_statistics_read_the_facts_once(star, no_broadcast):
    text = plan(explore.delivery_correlation(star))
    assert len(re.findall(r"FileScan parquet \[l_", text)) == 1


def test_country_report_reads_the_facts_once(star, no_broadcast):
    assert len(re.findall(r"FileScan parquet \[l_", plan(explore.country_returns(star)))) == 1


def test_small_tables_are_broadcast_by_size(star):
    assert "BroadcastHashJoin" in plan(star.users("user_id", "country"))


def test_a_hot_key_is_split_at_run_time(spark, no_broadcast):
    """A third of all rows on one key: the adaptive skew join divides it."""
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        items = spark.range(0, 90000, numPartitions=6).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("product_id"),
            F.col("id").alias("v"))
        products = spark.range(5000).select(F.col("id").alias("product_id"), (F.col("id") % 3).alias("c"))
        totals = items.join(products, "product_id").groupBy("c").agg(F.count(F.lit(1)).alias("n"))
        assert sum(r["n"] for r in totals.collect()) == 90000
        assert "skew=true" in plan(totals)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.fixture
def skewed(spark, tmp_path):
    """The small tables with a third of all items in one order, of one product."""
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "events"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    one = lines.limit(1).crossJoin(spark.range(3000)).drop("id")
    lines.unionByName(one).write.parquet(str(tmp_path / "lineitem.parquet"))
    from tillwork.sources import StarShop
    return StarShop(spark, str(tmp_path))


def test_reports_add_up_a_hot_order_before_it_moves(spark, skewed):
    for build in (reports.monthly_growth, explore.category_margin):
        df = build(skewed)
        df.collect()
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "partial_sum" in text and "CartesianProduct" not in text
        lines = skewed.items("sale_price", statuses=None)
        assert lines.count() >= 9000


def test_correlation_without_spread_is_null(shop, monkeypatch, spark):
    def fit(*rows):
        table = spark.createDataFrame(rows, "median_days double, return_rate double")
        monkeypatch.setattr(explore, "_delivery_statistics", lambda *_: table)
        return tuple(explore.delivery_correlation(shop).first())

    assert fit((30.0, 1.0), (30.0, 2.0), (30.0, 4.0)) == (None, None, None, 3, "weak")
    assert fit((1.0, 3.0), (2.0, 3.0)) == (None, 0.0, 3.0, 2, "weak")
    assert fit((1.0, 3.0), (2.0, 5.0), (3.0, 7.0)) == (1.0, 2.0, 1.0, 3, "positive")
    assert fit((1.0, 3.0)) == (None, None, None, 1, "weak")
