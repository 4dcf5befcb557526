"""Pivots and joins that keep a fixed order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread(df: DataFrame, rows: str, names: str, values: Sequence, cell: Column,
           prefix: str = "", fill=None) -> DataFrame:
    """Pivot with declared columns, so no extra job looks the values up first."""
    wide = df.groupBy(rows).pivot(names, list(values)).agg(cell)
    if prefix:
        wide = wide.select(rows, *(F.col(f"`{v}`").alias(f"{prefix}{v}") for v in values))
    return wide if fill is None else wide.fillna(fill)


def in_order(df: DataFrame, column: str, order: Sequence[str], keep_absent: bool) -> DataFrame:
    """Rows in domain order; labels without a row come as nulls or are left out."""
    labels = df.sparkSession.createDataFrame(
        [(i + 1, label) for i, label in enumerate(order)], f"position int, {column} string")
    how = "left" if keep_absent else "inner"
    return labels.join(df, column, how).orderBy("position")
