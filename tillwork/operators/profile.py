"""Table profiles: shapes, nulls, keys, domains."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions.columns import percent, rounded


def _stacked(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def shapes(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column: its type, and the table's row and column counts."""
    def shape(name: str, df: DataFrame) -> DataFrame:
        fields = F.array(*(F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype"))
                           for c, t in df.dtypes))
        return (df.agg(F.count(F.lit(1)).alias("rows"))
                .select(F.lit(name).alias("table"), "rows",
                        F.lit(len(df.columns)).alias("columns"), F.inline(fields)))
    return _stacked([shape(name, df) for name, df in tables.items()])


def null_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Columns that hold nulls, with their number and share: one scan per table."""
    def nulls(name: str, df: DataFrame) -> DataFrame:
        counted = df.agg(F.count(F.lit(1)).alias("_rows"),
                         *(F.count(F.col(c)).alias(c) for c in df.columns))
        cells = F.array(*(F.struct(F.lit(c).alias("column"),
                                   (F.col("_rows") - F.col(c)).alias("null_count"))
                          for c in df.columns))
        return (counted.select("_rows", F.inline(cells)).filter("null_count > 0")
                .select(F.lit(name).alias("table"), "column", "null_count",
                        rounded(percent(F.col("null_count"), F.col("_rows"))).alias("null_pct")))
    return (_stacked([nulls(name, df) for name, df in tables.items()])
            .orderBy("table", F.desc("null_count"), "column"))


def duplicate_keys(keys: dict[str, tuple[DataFrame, str | Sequence[str]]]) -> DataFrame:
    """Rows, distinct keys (of one column or several) and surplus rows of each table."""
    def check(name: str, df: DataFrame, key: str | Sequence[str]) -> DataFrame:
        if not isinstance(key, str):
            name_of_key = ", ".join(key)
            df, key = df.select(F.struct(*key).alias(name_of_key)), name_of_key
        return df.agg(F.count(F.lit(1)).alias("total"),
                      F.countDistinct(F.col(f"`{key}`")).alias("distinct_keys"),
                      F.count(F.when(F.col(f"`{key}`").isNull(), 1)).alias("_null")).select(
            F.lit(name).alias("table"), F.lit(key).alias("key"), "total",
            # A null key counts as one more value.
            (F.col("distinct_keys") + F.least("_null", F.lit(1))).alias("unique"))
    found = _stacked([check(name, df, key) for name, (df, key) in keys.items()])
    return found.withColumn("duplicates", F.col("total") - F.col("unique"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, standard deviation, minimum and maximum, one row per column."""
    stats = df.agg(*(F.struct(
        F.count(c).alias("count"), rounded(F.avg(F.col(c).cast("double")), 4).alias("mean"),
        rounded(F.stddev_samp(F.col(c).cast("double")), 4).alias("stddev"),
        F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")).alias(c)
        for c in columns))
    rows = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("s")) for c in columns))
    return stats.select(F.inline(rows)).select("column", "s.*")


def domain_difference(df: DataFrame, column: str, expected: Sequence[str]) -> DataFrame:
    """Expected values that never occur, and values that were not expected."""
    found = df.select(column).filter(F.col(column).isNotNull()).distinct()
    wanted = df.sparkSession.createDataFrame([(v,) for v in expected], f"{column} string")
    missing = wanted.join(found, column, "left_anti").withColumn("problem", F.lit("missing"))
    extra = found.filter(~F.col(column).isin(list(expected))).withColumn(
        "problem", F.lit("unexpected"))
    return missing.unionByName(extra)
