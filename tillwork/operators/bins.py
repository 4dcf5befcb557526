"""Bins of numeric columns as a decision tree sees them, and rows that fall into the same bins as one."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

# --- Fixed values: those of Spark's tree learners -------------------------------------
BINS = 32
#: Rows from which thresholds are taken, where there are more.
SEEN = 10_000
# --------------------------------------------------------------------------------------


def thresholds(values: Sequence[float], weights: Sequence[float] | None = None, bins: int = BINS) -> list[float]:
    """The values between which a tree may split: a row goes left if it is not above one.

    Spark's rule: half way between neighbours, between all of them where they are few, and
    otherwise where the running weight is nearest to a multiple of an equal share.
    """
    by_value: dict[float, float] = {}
    for value, weight in zip(values, weights or [1.0] * len(values)):
        by_value[value] = by_value.get(value, 0.0) + weight
    weighted = sorted(by_value.items())
    middle = [(a + b) / 2 for (a, _), (b, _) in zip(weighted, weighted[1:])]
    if len(middle) < bins:
        return middle
    found, share = [], sum(by_value.values()) / bins
    current, target = weighted[0][1], share
    for (_, weight), split in zip(weighted[1:], middle):
        previous, current = current, current + weight
        if abs(previous - target) < abs(current - target):
            found.append(split)
            target += share
    return found


def seen(rows: DataFrame, columns: Sequence[str], keys: Sequence[str], seed: int) -> list[Row]:
    """The rows that thresholds are taken from: :data:`SEEN`, or all where there are fewer, as in Spark's tree
    learners; chosen by the hash of their keys, whatever the partitions."""
    return (rows.select(*columns, F.xxhash64(F.lit(seed), *keys).alias("__hash"))
            .orderBy("__hash", *columns).limit(SEEN).collect())


def tree_bins(rows: DataFrame, columns: Sequence[str], keys: Sequence[str], seed: int) -> Bucketizer:
    """Adds a column ``<name>_bin`` for each of ``columns``: the bin that a tree learner would put it in."""
    found = seen(rows, columns, keys, seed)
    # A bucket begins with its lower end, a tree's right side just above it.
    inner = [[math.nextafter(t, math.inf) for t in thresholds([r[c] for r in found])] for c in columns]
    return Bucketizer(splitsArray=[[-math.inf, *(x or [math.nextafter(math.inf, 0)]), math.inf] for x in inner],
                      inputCols=list(columns), outputCols=[f"{c}_bin" for c in columns])


def as_cells(rows: DataFrame, columns: Sequence[str], label: str, weight: str = "weight") -> DataFrame:
    """A row for each combination of ``columns``, with the mean of ``label`` and the number of rows.

    For learners by squared error that see nothing but ``columns``: what varies inside a combination is the
    same before and after each split, so gains, splits and means are those of the rows.
    """
    return rows.groupBy(*columns).agg(F.avg(label).alias(label), F.count(F.lit(1)).cast("double").alias(weight))
