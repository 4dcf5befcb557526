"""Connected components by distributed union-find over pairs of ids (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from tillwork.session import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns node, component: the smallest id that each linked node reaches.

    Large-star and small-star rounds: every node's neighbours are hung on the smallest id the node
    knows. The minimum is pre-aggregated per task and joined back, so that a hub of any degree is
    split by the adaptive skew join. Each round is a table in the shared folder; the driver sees
    two numbers a round, taken while it is written. Ids may be of any type that can be ordered;
    nodes without a pair to another node are not in the result.

    Repeated edges go at the end of a round only: a minimum does not mind them, no step before
    makes more of them, and every shuffle saved is one that the driver need not keep track of.
    """
    stars, now = _round(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")), 0)
    before, turn = None, 0
    while now[0] and before != now:
        before, turn = now, turn + 1
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.least("m", "u").alias("v")))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        stars, now = _round(joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .unionByName(low.select("u", F.col("m").alias("v"))).distinct(), turn)
    return (stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


def _round(edges: DataFrame, turn: int) -> tuple[DataFrame, tuple]:
    """The edges as a table, with their number and a digest."""
    seen = Observation()
    stars = written(edges.observe(seen, F.count(F.lit(1)).alias("rows"), F.bit_xor(F.xxhash64("u", "v")).alias("digest")), f"star-{turn}")
    return stars, (seen.get["rows"], seen.get["digest"])
