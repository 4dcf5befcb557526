"""Operators against brute force on small frames, with ties, skew, nulls and constants."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillwork.operators.distribution import (
    cap_outliers, column_quantiles, counted_values, histogram, in_share, moments_of_counts,
    share_of_total)
from tillwork.operators.profile import domain_difference, duplicate_keys, null_report
from tillwork.operators.ranking import (
    average_rank, members_of_top, top_groups, top_per_group, with_approximate_tiles, with_tiles)
from tillwork.operators.shape import in_order, spread


def skewed(spark, n=997, hot=0.4, seed=5):
    """One value holds ``hot`` of all rows."""
    rng = random.Random(seed)
    rows = [(i, 7 if rng.random() < hot else rng.randrange(-50, 400)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, v int").repartition(6)


@pytest.mark.parametrize("tiles, n", [(5, 997), (5, 3), (4, 100), (7, 1)])
def test_tiles_equal_ntile(spark, tiles, n):
    _, df = skewed(spark, n)
    tiled = with_tiles(df, {"up": [F.asc("v"), F.asc("id")], "down": [F.desc("v"), F.asc("id")]}, tiles)
    expected = df.select(
        "id", F.ntile(tiles).over(Window.orderBy("v", "id")).alias("up"),
        F.ntile(tiles).over(Window.orderBy(F.desc("v"), "id")).alias("down"))
    assert sorted(map(tuple, tiled.select("id", "up", "down").collect())) == \
        sorted(map(tuple, expected.collect()))


def test_tiles_do_not_gather_rows_in_one_task(spark):
    _, df = skewed(spark)
    plan = with_tiles(df, {"t": [F.asc("v"), F.asc("id")]}, 5)._jdf.queryExecution().executedPlan().toString()
    assert "ntile" not in plan and "row_number" not in plan


def test_approximate_tiles_keep_ties_together(spark):
    rows, df = skewed(spark)
    tiled = with_approximate_tiles(df, {"t": ("v", False)}, 5).collect()
    of_value = {}
    for r in tiled:
        of_value.setdefault(r["v"], set()).add(r["t"])
    assert all(len(tiles) == 1 for tiles in of_value.values())
    ordered = [next(iter(of_value[v])) for v in sorted(of_value)]
    assert ordered == sorted(ordered) and set(ordered) <= set(range(1, 6))


def discrete(values, p):
    values = sorted(values)
    return float(values[max(math.ceil(len(values) * p - 1e-9), 1) - 1])


def test_quantiles_equal_brute_force(spark):
    rng = random.Random(1)
    rows = [(rng.choice([3.25, rng.uniform(-10, 1000)]), None if rng.random() < .1 else rng.randrange(9), 4)
            for _ in range(2003)]
    df = spark.createDataFrame(rows, "a double, b int, c int")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    for accuracy in (8, 4096):
        got = spark.range(1).select(column_quantiles(df, ["a", "b", "c"], probs, accuracy).alias("q")).first()["q"]
        for i, name in enumerate("abc"):
            values = [r[i] for r in rows if r[i] is not None]
            assert got[name] == [discrete(values, p) for p in probs], name


def test_one_outlier_does_not_make_quantiles_costly(spark, monkeypatch):
    from tillwork.operators import distribution
    kept = []
    monkeypatch.setattr(distribution, "written", lambda df, name, real=distribution.written: kept.append(real(df, name)) or kept[-1])
    plain = spark.range(200_000).select((F.xxhash64("id") % 100_000 / 100).alias("v"))
    odd = plain.unionByName(spark.createDataFrame([(1e15,), (None,)], "v double"))
    sizes = []
    for df in (plain, odd):
        kept.clear()
        got = spark.range(1).select(column_quantiles(df, ["v"], [0.25, 0.75]).alias("q")).first()["q"]["v"]
        values = [r[0] for r in df.filter("v IS NOT NULL").collect()]
        assert got == [discrete(values, 0.25), discrete(values, 0.75)]
        sizes.append(sum(k.count() for k in kept))
    assert sizes[1] <= 2 * sizes[0] and sizes[0] < 5000


def test_quantiles_of_no_rows(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    got = spark.range(1).select(column_quantiles(df, ["a", "b"], [0.5]).alias("q")).first()["q"]
    assert got == {"a": [None], "b": [1.0]}


def test_capping_keeps_nulls_and_constants(spark):
    rows = [(float(x), 5.0) for x in range(1, 9)] + [(1000.0, 5.0), (-500.0, 9.0), (None, None)]
    df = spark.createDataFrame(rows, "x double, k double")
    got = [tuple(r) for r in cap_outliers(df, ["x", "k"]).collect()]
    values = [r[0] for r in rows if r[0] is not None]
    q1, q3 = discrete(values, .25), discrete(values, .75)
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert sorted(x for x, _ in got if x is not None) == sorted(min(max(v, low), high) for v in values)
    assert {k for _, k in got} == {5.0, None}  # no spread: every other value is an outlier
    assert sum(x is None for x, _ in got) == 1


def test_histogram(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 1, 1, 5, 10)] + [(None,)], "x double")
    bars = {r["bin"]: r["count"] for r in histogram(df, "x", 5).collect()}
    assert bars == {0: 3, 1: 0, 2: 1, 3: 0, 4: 1}
    same = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert sum(r["count"] for r in histogram(same, "x", 3).collect()) == 2
    capped = histogram(df, "x", 2, F.lit(1.0)).collect()
    assert [r["count"] for r in sorted(capped)] == [1, 2]


def test_moments_of_counts(spark):
    values = [1, 1, 1, 4, 9, 9]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    stats = counted_values(df, [], "v").agg(*(e.alias(n) for n, e in moments_of_counts("v").items())).first()
    mean = sum(values) / 6
    assert stats["count"] == 6 and stats["mean"] == pytest.approx(mean)
    assert stats["std"] == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in values) / 5))


def test_average_rank_of_ties(spark):
    df = spark.createDataFrame([("a", 5), ("b", 9), ("c", 5), ("d", 1)], "k string, v int")
    got = {r["k"]: r["r"] for r in df.select("k", average_rank("v").alias("r")).collect()}
    assert got == {"b": 1.0, "a": 2.5, "c": 2.5, "d": 4.0}


def test_top_per_group_keeps_ties(spark):
    df = spark.createDataFrame([("x", 9), ("x", 9), ("x", 8), ("x", 7), ("y", 1)], "g string, v int")
    got = sorted(map(tuple, top_per_group(df, "g", [F.desc("v")], 2, "place").collect()))
    assert got == [("x", 9, 1), ("x", 9, 1), ("y", 1, 1)]


def test_top_groups_and_members(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), ("b", 4), ("c", 6), ("d", 2)], "g string, v int")
    assert {r["g"] for r in top_groups(df, "g", "v", 2).collect()} == {"a", "c"}
    totals = df.groupBy("g").agg(F.sum("v").alias("t"))
    assert members_of_top(df, "g", totals, "t", 2).count() == 3


def test_spread_and_order(spark):
    df = spark.createDataFrame([("r", "x", 2), ("r", "x", 4), ("s", "y", 1)], "row string, col string, v int")
    wide = spread(df, "row", "col", ["x", "y"], F.avg("v"), fill=0)
    assert sorted(map(tuple, wide.collect())) == [("r", 3.0, 0.0), ("s", 0.0, 1.0)]
    labels = in_order(df.groupBy("col").agg(F.sum("v").alias("v")), "col", ["y", "z", "x"], keep_absent=True)
    assert [tuple(r) for r in labels.select("position", "col", "v").collect()] == [(1, "y", 1), (2, "z", None), (3, "x", 6)]


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (None, "b")], "k int, v string")
    assert [tuple(r) for r in null_report({"t": df}).collect()] == [("t", "k", 1, 33.33), ("t", "v", 1, 33.33)]
    assert [tuple(r) for r in duplicate_keys({"t": (df, "k")}).collect()] == [("t", "k", 3, 2, 1)]
    got = sorted(map(tuple, domain_difference(df, "v", ["a", "z"]).collect()))
    assert got == [("b", "unexpected"), ("z", "missing")]
    share = df.groupBy("k").agg(F.count(F.lit(1)).alias("n")).select("k", share_of_total("n").alias("p"))
    assert sum(r["p"] for r in share.collect()) == pytest.approx(100)


def test_a_share_depends_on_the_row_alone(spark):
    df = spark.range(4000)
    chosen = {r[0] for r in df.filter(in_share(250, "id")).collect()}
    assert 800 < len(chosen) < 1200
    part = df.filter("id < 1000").repartition(7).filter(in_share(250, "id"))
    assert {r[0] for r in part.collect()} == {i for i in chosen if i < 1000}
