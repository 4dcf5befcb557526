"""Quantiles, histograms, box plots, moments and shares."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.functions.columns import percent, rounded
from tillwork.operators.ranking import with_running_sums
from tillwork.session import written

SKETCH = 4096  # values that a rank sketch keeps per level
TREE = 256  # sketches that meet in the last step


def share_of_total(count: str) -> Column:
    """Percentage of the whole frame (for aggregated frames)."""
    whole = F.sum(count).over(Window.partitionBy())
    return percent(F.col(count), whole)


def share_of_max(value: str) -> Column:
    """Value as a fraction of the frame's largest (for aggregated frames)."""
    top = F.max(value).over(Window.partitionBy())
    return F.try_divide(F.col(value).cast("double"), top.cast("double"))


def rank_of(total: Column, p: Column) -> Column:
    """1-based place of a discrete quantile; the tolerance absorbs float noise."""
    return F.ceil(total * p - F.lit(1e-9))


def counted_values(df: DataFrame, keys: Sequence[str], value: str,
                   **extra: Column) -> DataFrame:
    """How often each value occurs per key: combined on the map side, whatever the skew.

    Moments, quantiles and box plots of values from a limited range (days, ages) follow
    exactly from this small table.
    """
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"),
                                        *(c.alias(a) for a, c in extra.items()))


def moments_of_counts(value: str, n: str = "n") -> dict[str, Column]:
    """count, mean and sample standard deviation as aggregates over counted values.

    The sums are exact decimals, so the result does not depend on task order.
    """
    x, w = F.col(value).cast("decimal(19,0)"), F.col(n).cast("decimal(19,0)")
    count = F.sum(n)
    first = F.sum(x * w).cast("double")
    second = F.sum((x * x).cast("decimal(38,0)") * w).cast("double")
    spread = second - first * first / count
    return {"count": count, "mean": first / count,
            "std": F.sqrt(F.greatest(F.try_divide(spread, count - 1), F.lit(0.0)))}


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                     accuracy: int = SKETCH) -> Column:
    """Exact discrete quantiles of several columns as one map of arrays (in the order of ``probs``).

    Two reads. The first builds a rank sketch per group of tasks, merged as a tree; it gives a
    pair of values around every quantile, whatever the range of the values. The second counts
    what lies below each pair and keeps only the values inside, combined on the map side. Their
    running sums come from a range-partitioned sort, so no task holds all of them. The driver
    sees a few numbers per column and probability. Should a pair miss its quantile, that one is
    looked for among all values.
    """
    columns, probs = list(columns), list(probs)
    reach = 4.0 / accuracy  # several times the sketch's usual rank error
    task = F.pmod(F.spark_partition_id(), F.lit(TREE))
    numbers = [F.col(c).cast("double").alias(c) for c in columns]
    sketches = df.select(*numbers).groupBy(task.alias("_task")).agg(*(
        x for i, c in enumerate(columns)
        for x in (F.kll_sketch_agg_double(c, accuracy).alias(f"s{i}"), F.count(c).alias(f"n{i}"))))
    sketches = sketches.agg(*(
        x for i in range(len(columns))
        for x in (F.kll_merge_agg_double(F.expr(f"CASE WHEN n{i} > 0 THEN s{i} END"), accuracy).alias(f"s{i}"),
                  F.sum(f"n{i}").alias(f"n{i}"))))

    def at(i: int, shift: float) -> Column:
        ranks = F.array(*(F.lit(min(max(p + shift, 0.0), 1.0)) for p in probs))
        return F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"s{i}", ranks))

    seen = sketches.select(*(F.struct(F.col(f"n{i}").alias("n"), at(i, -reach).alias("low"),
                                      at(i, reach).alias("high")).alias(f"c{i}")
                             for i in range(len(columns)))).first()
    wanted = []  # key, column, probability's place, rank, bounds
    for i, c in enumerate(columns):
        for j, p in enumerate(probs):
            if seen[i]["n"]:
                rank = max(math.ceil(seen[i]["n"] * p - 1e-9), 1)
                wanted.append((len(wanted), c, j, rank, seen[i]["low"][j], seen[i]["high"][j]))
    found = _values_at(df.select(*numbers), wanted)
    missed = [(*w[:4], -math.inf, math.inf) for w in wanted if w[0] not in found]
    if missed:
        found |= _values_at(df.select(*numbers), missed)
    cuts = {c: [None] * len(probs) for c in columns}
    for key, c, j, *_ in wanted:
        cuts[c][j] = found[key]
    return F.create_map(*(x for c in columns for x in (
        F.lit(c), F.array(*(F.lit(v).cast("double") for v in cuts[c])))))


def _values_at(df: DataFrame, wanted: list[tuple]) -> dict[int, float]:
    """The value at each wanted rank, where it lies within its bounds."""
    if not wanted:
        return {}
    # A null value stands for all rows below the bounds.
    cells = F.array(*(F.struct(F.lit(key).alias("key"), F.when(F.col(c) >= F.lit(low), F.col(c)).alias("value"),
                               (F.col(c) <= F.lit(high)).alias("near"))
                      for key, c, _, _, low, high in wanted))
    counts = written(df.select(F.inline(cells)).filter("near").groupBy("key", "value")
                     .agg(F.count(F.lit(1)).alias("n")), "quantile-counts")
    totals = {r["key"]: (r["all"], r["below"]) for r in counts.groupBy("key").agg(
        F.sum("n").alias("all"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("below")).collect()}
    places, before = {}, 0
    for key, _, _, rank, *_ in sorted(wanted):
        whole, below = totals.get(key, (0, 0))
        if below < rank <= whole:
            places[key] = before + rank
        before += whole
    if not places:
        return {}
    running = with_running_sums(counts, [F.asc("key"), F.asc_nulls_first("value")], {"upto": "n"})
    hit = F.exists(F.array(*map(F.lit, places.values())),
                   lambda x: (x <= F.col("upto")) & (x > F.col("upto") - F.col("n")))
    rows = running.filter(hit).select("key", "value").collect()  # a row per rank at most
    return {r["key"]: r["value"] for r in rows if r["key"] in places}


def cap_outliers(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> DataFrame:
    """Clamp each column to ``reach`` interquartile ranges beyond its quartiles.

    All columns share the two passes of :func:`column_quantiles`. A null stays null.
    """
    kept = df.columns
    df = df.withColumn("_cuts", column_quantiles(df, columns, [0.25, 0.75]))

    def capped(c: str) -> Column:
        low, high = F.col("_cuts")[c][0], F.col("_cuts")[c][1]
        slack = (high - low) * reach
        value = F.col(c).cast("double")
        return (F.when(value < low - slack, low - slack)
                .when(value > high + slack, high + slack).otherwise(value))

    return df.withColumns({c: capped(c) for c in columns}).select(*kept)


def histogram(df: DataFrame, value: str, bins: int, upper: Column | None = None) -> DataFrame:
    """Equal-width bars from the smallest to the largest value (up to ``upper``).

    Empty bars are kept, with a count of 0; the last bar includes its upper edge.
    """
    x = F.col(value).cast("double")
    kept = df.filter(F.col(value).isNotNull())
    if upper is not None:
        kept = kept.filter(x <= upper)
    span = kept.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi")).alias("span")).scalar()
    lo, width = F.col("span")["lo"], (F.col("span")["hi"] - F.col("span")["lo"]) / F.lit(float(bins))
    bar = F.least(F.coalesce(F.floor(F.try_divide(x - lo, width)), F.lit(0)),
                  F.lit(bins - 1)).cast("int")
    filled = kept.withColumn("span", span).groupBy(bar.alias("bin")).agg(
        F.count(F.lit(1)).alias("count"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"),
                                               span.alias("span"))
    return every.join(filled, "bin", "left").select(
        "bin", (lo + F.col("bin") * width).alias("bin_start"),
        F.coalesce("count", F.lit(0)).alias("count"))


def box_plot(value: str) -> list[Column]:
    """Minimum, quartiles and maximum as aggregates (for report-sized groups)."""
    cuts = F.percentile(value, F.array(*map(F.lit, (0.25, 0.5, 0.75))))
    return [F.min(value).alias("low"), rounded(cuts[0], 4).alias("q1"),
            rounded(cuts[1], 4).alias("median"), rounded(cuts[2], 4).alias("q3"),
            F.max(value).alias("high")]


def in_share(per_mille: int, *keys: str) -> Column:
    """A fixed share of the rows, chosen by the md5 of their keys.

    The choice depends on the row alone: not on the table's size, its partitions or a seed.
    """
    digits = F.substring(F.md5(F.concat_ws("|", *(F.col(k).cast("string") for k in keys))), 1, 8)
    return F.conv(digits, 16, 10).cast("long") % 1000 < per_mille
