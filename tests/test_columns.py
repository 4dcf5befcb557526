"""Column expressions on hand-made rows."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillwork.functions import columns as c


def one(spark, ddl, rows, **exprs):
    df = spark.createDataFrame(rows, ddl)
    return [tuple(r) for r in df.select(*(e.alias(n) for n, e in exprs.items())).collect()]


def test_clean_timestamp(spark):
    rows = [("2024-01-01 10:00:00.123456 UTC",), ("2024-01-01 10:00:00 UTC",),
            ("2024-01-01 10:00:00",), ("",), ("soon",), (None,)]
    at = datetime(2024, 1, 1, 10)
    got = one(spark, "t string", rows, v=c.clean_timestamp(F.col("t")).cast("timestamp_ntz"))
    assert got == [(at,), (at,), (at,), (None,), (None,), (None,)]


def test_iso_instant_round_trip(spark):
    text = "2024-01-01T10:00:00.123Z"
    got = one(spark, "t string", [(text,), ("2024-01-01",)],
              v=c.to_iso_instant(c.iso_instant(F.col("t"))))
    assert got == [(text,), (None,)]


@pytest.mark.parametrize("age, band, narrow", [
    (None, "Unknown", "Unknown"), (17, "<18", "<18"), (18, "18–24", "18–24"),
    (64, "55–64", "55–64"), (65, "65+", "65+"), (119, "65+", "65+"), (120, "65+", "Unknown"),
    (200, "Unknown", "Unknown")])
def test_age_band(spark, age, band, narrow):
    got = one(spark, "a int", [(age,)], w=c.age_band(F.col("a")),
              n=c.age_band(F.col("a"), c.AGE_TOP_FOR_DISTRIBUTION))
    assert got == [(band, narrow)]


def test_prices(spark):
    rows = [(10.0, 4.0, 20.0), (0.0, 4.0, 0.0), (-1.0, 4.0, 10.0), (None, 4.0, 10.0)]
    sale, cost, retail = F.col("s"), F.col("k"), F.col("r")
    rate = c.discount_rate(retail, sale)
    got = one(spark, "s double, k double, r double", rows, m=c.margin_pct(sale, cost), d=rate,
              f=c.is_discounted(rate))
    assert got == [(60.0, 0.5, 1.0), (None, 0.0, 0.0), (None, 1.1, 1.0), (None, None, 0.0)]


def test_stock(spark):
    rows = [(0,), (9,), (10,), (11,), (30,), (31,), (None,)]
    got = one(spark, "a int", rows, t=c.stock_tier(F.col("a")),
              lost=c.lost_revenue(F.col("a"), F.lit(2.5)))
    assert got == [("CRITICAL", 25.0), ("WARNING", 2.5), ("WARNING", 0.0), ("NOTICE", 0.0),
                   ("NOTICE", 0.0), ("OK", 0.0), ("OK", 0.0)]


def test_segments(spark):
    rows = [(5, 4, 4), (3, 3, 1), (4, 2, 5), (1, 3, 1), (2, 2, 2), (3, 2, 5), (5, 5, 3)]
    got = one(spark, "r int, f int, m int", rows, s=c.rfm_segment(F.col("r"), F.col("f"), F.col("m")))
    assert [g[0] for g in got] == ["Champions", "Loyal Customers", "New Customers", "At Risk",
                                   "Lost", "Potential Loyalists", "Loyal Customers"]


def test_verdicts(spark):
    got = one(spark, "x double", [(0.5,), (0.4,), (-0.41,), (None,)],
              v=c.correlation_verdict(F.col("x")), m=c.margin_status(F.col("x") * 10))
    assert got == [("positive", "ABOVE_TARGET"), ("weak", "ABOVE_TARGET"),
                   ("negative", "ON_TARGET"), ("weak", "BELOW_TARGET")]


def test_empty_whole_gives_null(spark):
    got = one(spark, "n int, d int", [(1, 0), (1, 4), (None, 4)], p=c.percent(F.col("n"), F.col("d")))
    assert got == [(None,), (25.0,), (None,)]


def test_rounding_is_half_up_on_decimal_digits(spark):
    got = one(spark, "x double", [(12.345,), (-12.345,), (2.675,), (1e6 / 3,)], r=c.rounded(F.col("x")))
    assert [g[0] for g in got] == [12.35, -12.35, 2.68, 333333.33]


def test_money_from_doubles_is_exact(spark):
    cents = list(range(0, 2000)) + [10499788, 90182, 99999]
    rows = [(x / 100,) for x in cents]
    got = one(spark, "x double", rows, m=c.as_money(c.hundredths(F.col("x")), 2))
    assert [int(g[0] * 100) for g in got] == cents


def test_month_index_counts_thirty_day_steps(spark):
    rows = [("2023-01", "2023-01"), ("2023-02", "2023-01"), ("2023-03", "2023-01"), ("2023-04", "2023-01")]
    got = one(spark, "m string, f string", rows, i=c.month_index(F.col("m"), F.col("f")))
    assert [g[0] for g in got] == [0, 1, 1, 3]
