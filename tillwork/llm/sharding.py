"""Contiguous shards of near equal size, from prefix sums over per-partition totals.

Documents are range-partitioned by id. Only one row per partition (its bytes and rows) is summed
up over all partitions; everything else happens inside the partitions. Shard ``i`` holds the
documents whose byte middle lies between ``i`` and ``i + 1`` shares of all bytes, so that every
cut is at most half a document away from its target. Equal documents are free to be on both
sides of a cut: the law is the size.

Defined results: a null text has no bytes (its size is the fixed overhead) and the checksum of
the empty text; null ids come first; repeated ids and rows each take a slot of their own; an
empty table gives no rows; more shards than documents leave some shards empty; other columns of
the input are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from tillwork.session import written


def balanced_shards(docs: DataFrame, shards: int = 40, overhead: int = 16,
                    id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Columns: id, size, text_crc32, law, shard, slot (gapless per shard), grown_shard (null)."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    sized = docs.select(
        F.col(id_column).alias("id"), (F.octet_length(text) + overhead).cast("long").alias("size"),
        F.crc32(text).alias("crc"), F.monotonically_increasing_id().alias("row"))
    # "row" parts equal ids, so that no number of repeats ends up in one task.
    ranged = written(sized.repartitionByRange("id", "crc", "row")
                     .withColumn("part", F.spark_partition_id()), "shard-sizes")
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = totals.select(
        "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(every).alias("all_bytes"))
    inside = Window.partitionBy("part").orderBy("id", "crc", "row").rowsBetween(Window.unboundedPreceding, 0)
    # A row per partition of the range partitioning: small whatever the corpus.
    placed = (ranged.join(F.broadcast(starts), "part")
              .withColumn("end", F.col("bytes_before") + F.sum("size").over(inside))
              .withColumn("place", F.col("rows_before") + F.row_number().over(inside) - 1)
              .withColumn("shard", F.least(F.lit(shards - 1), F.expr(
                  f"(cast(2 * end - size as decimal(38, 0)) * {shards}) div (2 * all_bytes)")).cast("int")))
    first = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return (placed.join(F.broadcast(first), "shard")
            .select(F.col("id").alias(id_column), "size", F.col("crc").alias("text_crc32"),
                    F.lit("bytes").alias("law"), "shard", (F.col("place") - F.col("first")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
