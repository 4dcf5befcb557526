"""Quality of scores and features, exactly: every figure comes from sums of decimals, so it does
not depend on the order of tasks, and from one pass and small aggregates, so it does not gather rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.functions.columns import flag
from tillwork.operators.ranking import with_running_sums

EXACT = "decimal(18,6)"  # squares of these have twelve places and add up to 38 digits


def exact(value: Column) -> Column:
    return value.cast(EXACT)


def total(value: Column) -> Column:
    """The sum of a decimal expression, as a double."""
    return F.sum(value).cast("double")


def roc_area(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row: positives, negatives and the area under the ROC curve, from rank sums; ties count half.

    Rows are added up per distinct score before anything is sorted, and the running sum of negatives is spread
    over range partitions. Rows without a score or a label do not count; with one class only the
    area is null.
    """
    positive = F.col(label) == 1
    counts = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.sum(flag(positive)).alias("pos"), F.sum(flag(~positive)).alias("neg"))
    running = with_running_sums(counts, [F.asc("score")], {"up_to": "neg"})
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    # Twice the number of pairs in order: 2 * negatives below + negatives that tie.
    pairs = F.sum(whole("pos") * (2 * whole("up_to") - whole("neg"))).cast("double")
    return running.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"), F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"),
                       pairs.alias("pairs")).select(
        "positives", "negatives", F.try_divide("pairs", (2.0 * F.col("positives") * F.col("negatives"))).alias("area"))


def root_mean_square(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: rows with both values, mean error and root mean squared error."""
    gap = exact(F.col(prediction)) - exact(F.col(label))
    known = df.select(gap.cast(EXACT).alias("gap")).where("gap IS NOT NULL")
    return known.agg(F.count(F.lit(1)).alias("n"), total(F.col("gap")).alias("sum"), total(F.col("gap") * F.col("gap")).alias("squares")).select(
        "n", F.try_divide("sum", "n").alias("mean_error"), F.sqrt(F.try_divide("squares", "n")).alias("rmse"))


def silhouette(df: DataFrame, cluster: str, numbers: Sequence[str]) -> DataFrame:
    """One row: points, clusters and the mean silhouette by squared Euclidean distance.

    The mean distance from a point to a cluster follows from the cluster's size, its sum and its sum of squared
    norms, so one row per cluster meets the points, not the points each other. A point alone in
    its cluster counts as 0; with fewer than two clusters the mean is null.
    """
    points = df.select(F.col(cluster).alias("cluster"), *(exact(F.col(c)).alias(f"x{i}") for i, c in enumerate(numbers))).dropna()
    places = [f"x{i}" for i in range(len(numbers))]
    norm = reduce(add, (F.col(x) * F.col(x) for x in places))
    groups = points.groupBy("cluster").agg(F.count(F.lit(1)).cast("double").alias("n"), total(norm).alias("norms"),
                                           *(total(F.col(x)).alias(f"sum_{x}") for x in places))
    # A row per cluster: as many as the model has.
    every = groups.agg(F.collect_list(F.struct("cluster", "n", "norms", F.array(*(f"sum_{x}" for x in places)).alias("sums"))).alias("groups")).scalar()
    at = F.array(*(F.col(x).cast("double") for x in places))
    joined = points.select("cluster", at.alias("at"), norm.cast("double").alias("norm")).withColumn("groups", every)

    def spread(g: Column) -> Column:
        dot = F.aggregate(F.zip_with("at", g["sums"], lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        return F.greatest(F.col("norm") * g["n"] + g["norms"] - 2 * dot, F.lit(0.0))

    own = F.filter("groups", lambda g: g["cluster"] == F.col("cluster"))[0]
    inside = F.try_divide(spread(own), own["n"] - 1)
    outside = F.array_min(F.transform(F.filter("groups", lambda g: g["cluster"] != F.col("cluster")), lambda g: spread(g) / g["n"]))
    value = F.when(own["n"] == 1, 0.0).otherwise(F.coalesce(F.try_divide(outside - inside, F.greatest(inside, outside)), F.lit(0.0)))
    scored = joined.select(F.size("groups").alias("clusters"), F.round(value, 9).cast("decimal(18,9)").alias("value"))
    return scored.agg(F.count(F.lit(1)).alias("points"), F.max("clusters").alias("clusters"),
                      F.when(F.max("clusters") > 1, F.avg("value").cast("double")).alias("silhouette"))


def f_scores(df: DataFrame, label: str, numbers: Sequence[str], labels: Sequence[str], chosen: int) -> DataFrame:
    """Columns feature, f_value, chosen: the F statistic of every number, and of every value of the label columns
    as a number that is 1 where it occurs, between the classes of ``label``.

    Numbers come from one aggregate of counts, sums and squares per class, values of labels from their counts per
    class: nothing is encoded. The first ``chosen`` are marked, ties by name.
    """
    rows = df.dropna(subset=[label, *numbers, *labels])
    per_class = rows.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"), *(
        F.struct(total(exact(F.col(c))).alias("sum"), total(exact(F.col(c)) * exact(F.col(c))).alias("square")).alias(c) for c in numbers))
    named = F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c)["sum"].alias("sum"), F.col(c)["square"].alias("square")) for c in numbers)))
    classes = per_class.select("class", F.col("n").cast("double").alias("n"))
    plain = per_class.select("class", named.alias("f")).select("class", "f.*")
    occurs = F.explode(F.array(*(F.struct(F.concat(F.lit(f"{c}="), F.col(c).cast("string")).alias("feature")) for c in labels)))
    counted = (rows.select(F.col(label).alias("class"), occurs.alias("f")).groupBy("class", "f.feature")
               .agg(F.count(F.lit(1)).cast("double").alias("sum")).withColumn("square", F.col("sum")))
    # A class without the value adds nothing to its sums, but its rows count.
    sums = plain.unionByName(counted).join(F.broadcast(classes), "class")
    rows, number = classes.agg(F.sum("n")).scalar(), classes.agg(F.count(F.lit(1))).scalar()
    between = sums.groupBy("feature").agg(F.sum(F.col("sum") * F.col("sum") / F.col("n")).alias("means"), F.sum("sum").alias("sum"),
                                          F.sum("square").alias("square")).withColumns({"rows": rows, "classes": number})
    apart = (F.col("means") - F.col("sum") * F.col("sum") / F.col("rows")) / (F.col("classes") - 1)
    within = (F.col("square") - F.col("means")) / (F.col("rows") - F.col("classes"))
    scored = between.select("feature", F.try_divide(apart, within).alias("f_value"))
    best = scored.orderBy(F.desc_nulls_last("f_value"), "feature").limit(chosen).select("feature", F.lit(True).alias("first"))
    return scored.join(F.broadcast(best), "feature", "left").select(
        "feature", F.round("f_value", 6).alias("f_value"), F.coalesce("first", F.lit(False)).alias("chosen"))


def label_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns column, label, position, count: labels by frequency, then by name, as an encoder numbers them."""
    named = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("label")) for c in columns)))
    counts = df.select(named.alias("x")).where("x.label IS NOT NULL").groupBy("x.column", "x.label").agg(F.count(F.lit(1)).alias("count"))
    order = Window.partitionBy("column").orderBy(F.desc("count"), "label")  # a row per label
    return counts.withColumn("position", F.row_number().over(order) - 1)


def distinct_estimates(df: DataFrame, groups: Sequence[str], column: str, deviation: float = 0.05, bound: float = 3.0) -> DataFrame:
    """Columns groups, exact, estimate, relative_error, within_bound: what a sketch says of the distinct values of
    ``column`` beside their number, and whether it errs by at most ``bound`` standard deviations.

    For choosing the deviation on a past day's rows. The exact count is a row per distinct value, so nothing
    is gathered.
    """
    estimates = df.groupBy(*groups).agg(F.approx_count_distinct(column, deviation).alias("estimate"))
    exacts = df.select(*groups, column).distinct().groupBy(*groups).agg(F.count(column).alias("exact"))
    same = reduce(lambda a, b: a & b, (F.col(f"e.{g}").eqNullSafe(F.col(f"x.{g}")) for g in groups))
    error = F.coalesce(F.try_divide(F.abs(F.col("estimate") - F.col("exact")), "exact"), F.lit(0.0))
    return exacts.alias("e").join(estimates.alias("x"), same).select(
        *(F.col(f"e.{g}") for g in groups), "exact", "estimate", error.alias("relative_error"),
        # One off is within any bound: counts are whole.
        ((error <= bound * deviation) | (F.abs(F.col("estimate") - F.col("exact")) <= 1)).alias("within_bound"))
