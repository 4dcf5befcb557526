"""Ranks, tiles and top groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.functions.columns import flag
from tillwork.session import checkpointed

ROW_BITS = 33  # monotonically_increasing_id keeps the row in the low 33 bits


def top_per_group(df: DataFrame, group: str, order: Sequence[Column], k: int,
                  rank: str) -> DataFrame:
    """Rows ranked ``k`` or better in their group, ties sharing a rank.

    Spark keeps only each task's best ``k`` ranks before it shuffles
    (``WindowGroupLimit``), so a group with most of the rows does not reach one task whole.
    """
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn(rank, F.rank().over(window)).filter(F.col(rank) <= k)


def top_groups(df: DataFrame, group: str, measure: str, n: int) -> DataFrame:
    """All rows of the ``n`` groups with the largest total of ``measure``.

    For report-sized frames (already aggregated): the rows are ranked in one pass instead
    of computing the frame a second time for a semi join.
    """
    total = F.sum(measure).over(Window.partitionBy(group))
    ranked = df.withColumn("_total", total).withColumn(
        "_place", F.dense_rank().over(Window.orderBy(F.desc("_total"), F.asc(group))))
    return ranked.filter(F.col("_place") <= n).drop("_total", "_place")


def members_of_top(df: DataFrame, key: str, totals: DataFrame, measure: str, n: int) -> DataFrame:
    """Rows of ``df`` whose ``key`` is among the ``n`` largest of ``totals``.

    The list of keys never leaves the cluster; it has at most ``n`` rows.
    """
    best = totals.orderBy(F.desc(measure), F.asc(key)).limit(n).select(key)
    return df.join(best, key, "left_semi")


def average_rank(measure: str) -> Column:
    """Descending rank in which ties share the mean of their places."""
    ahead = F.rank().over(Window.orderBy(F.desc(measure)))
    ties = F.count(F.lit(1)).over(Window.partitionBy(measure))
    return ahead + (ties - 1) / F.lit(2.0)


def with_places(df: DataFrame, orders: dict[str, Sequence[Column]],
                total: str | None = None) -> DataFrame:
    """Add each row's exact 0-based place in one or more total orders, and the row count.

    A plain ``row_number`` without partitions would sort all rows in one task. Here every
    order is a range-partitioned sort; ``monotonically_increasing_id`` then tells partition
    and row within it. One reliable checkpoint fixes these, and the partition sizes (one
    small row each) turn into offsets. Each order must be total: end it with a key.
    """
    ids = df
    for name, order in orders.items():
        ids = ids.orderBy(*order).withColumn(f"_id_{name}", F.monotonically_increasing_id())
    ids = checkpointed(ids)
    if total:
        ids = ids.withColumn(total, ids.agg(F.count(F.lit(1))).scalar())
    for name in orders:
        part = F.shiftrightunsigned(f"_id_{name}", ROW_BITS)
        row = F.col(f"_id_{name}").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
        sizes = ids.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
        before = F.sum("_size").over(
            Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
        offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_offset"))
        # One row per partition of a sort: bounded by spark.sql.shuffle.partitions.
        ids = (ids.withColumn("_part", part)
               .join(F.broadcast(offsets), "_part")
               .withColumn(name, row + F.col("_offset"))
               .drop("_part", "_offset"))
    return ids.drop(*(f"_id_{name}" for name in orders))


def with_running_sums(df: DataFrame, order: Sequence[Column], sums: dict[str, str]) -> DataFrame:
    """Add ``name: column`` running sums in a total order, and ``name_all`` with the whole sum.

    A range-partitioned sort fixed by a reliable checkpoint; partitions add up on their own and
    start from the sums of those before, one small row each.
    """
    ids = checkpointed(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    ids = ids.withColumn("_part", F.shiftrightunsigned("_id", ROW_BITS))
    parts = ids.groupBy("_part").agg(*(F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    starts = parts.select("_part", *(F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_from_{n}") for n in sums),
                          *(F.sum(f"_sum_{n}").over(every).alias(f"{n}_all") for n in sums))
    inside = Window.partitionBy("_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, 0)
    # One row per partition of a sort: bounded by spark.sql.shuffle.partitions.
    return (ids.join(F.broadcast(starts), "_part")
            .withColumns({n: F.sum(c).over(inside) + F.col(f"_from_{n}") for n, c in sums.items()})
            .drop("_id", "_part", *(f"_from_{n}" for n in sums)))


def tile_of(place: Column, total: Column, tiles: int) -> Column:
    """NTILE from a 0-based place: the first ``total % tiles`` tiles hold one row more."""
    small = F.floor(total / tiles)
    larger = total % tiles
    in_large = larger * (small + 1)
    rest = F.try_divide(place - in_large, small)
    tile = F.when(place < in_large, F.floor(place / (small + 1))).otherwise(
        F.floor(larger + rest))
    return (tile + 1).cast("int")


def with_tiles(df: DataFrame, orders: dict[str, Sequence[Column]], tiles: int) -> DataFrame:
    """Exact NTILE columns over the whole frame, without gathering it in one task."""
    placed = with_places(df, {f"_place_{name}": order for name, order in orders.items()}, "_rows")
    tiled = placed.withColumns({
        name: tile_of(F.col(f"_place_{name}"), F.col("_rows"), tiles) for name in orders})
    return tiled.drop("_rows", *(f"_place_{name}" for name in orders))


def with_approximate_tiles(df: DataFrame, orders: dict[str, tuple[str, bool]],
                           tiles: int, accuracy: int = 10_000) -> DataFrame:
    """Tiles from percentile cut points (``name -> (column, descending)``).

    One aggregate and no sort. Equal values always share a tile, where NTILE may part them;
    tile sizes are therefore uneven under ties.
    """
    steps = [i / tiles for i in range(1, tiles)]
    cuts = df.agg(F.struct(*(F.percentile_approx(column, steps, accuracy).alias(name)
                             for name, (column, _) in orders.items())).alias("cuts")).scalar()
    df = df.withColumn("_cuts", cuts)
    for name, (column, descending) in orders.items():
        value, points = F.col(column), F.col("_cuts")[name]
        passed = reduce(add, (flag(value < points[i] if descending else value > points[i])
                              for i in range(tiles - 1)))
        df = df.withColumn(name, (passed + 1).cast("int"))
    return df.drop("_cuts")
