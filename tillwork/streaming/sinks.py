"""Sinks and life cycle of the streaming jobs. One query serves all outputs of a job."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwork.functions.columns import ALERT_TIERS
from tillwork.session import shared_folder
from tillwork.streaming.jobs import STATE_KEYS, inventory_alerts
from tillwork.streaming.store import GONE, SnapshotStore

# --- Fixed values
TABLE_TRIGGER = "30 seconds"
CONSOLE_TRIGGER = "10 seconds"
CONSOLE_ROWS = 20
# ---


def _triggered(writer, every: str | None):
    """Run every so often, or once over all that is there when ``every`` is None."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def append_table(df: DataFrame, path: str, checkpoint: str, every: str | None = TABLE_TRIGGER,
                 partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append closed windows to a Parquet table."""
    writer = df.writeStream.outputMode("append").format("parquet").option(
        "checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _triggered(writer, every).start(path)


def console(df: DataFrame, checkpoint: str, mode: str = "append", rows: int = CONSOLE_ROWS,
            every: str | None = CONSOLE_TRIGGER) -> StreamingQuery:
    """Print each batch, for a look at a running job."""
    writer = df.writeStream.outputMode(mode).format("console").options(
        truncate="false", numRows=str(rows), checkpointLocation=checkpoint)
    return _triggered(writer, every).start()


def snapshots(state: DataFrame, path: str, checkpoint: str, alerts: str | None = None,
              every: str | None = TABLE_TRIGGER) -> StreamingQuery:
    """Write the complete state of each batch to its own folder, and the alerts beside it.

    A repeated batch overwrites its own folder, so a restart leaves no duplicate. Table and
    alerts come from one cached batch: the state is computed once. The history is kept whole: for states
    that are small and wanted in every version. :func:`keyed_snapshots` keeps the newest one.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        if alerts is None:
            batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            return
        batch.persist()
        try:
            batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            inventory_alerts(batch).write.mode("overwrite").parquet(f"{alerts}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = state.writeStream.outputMode("complete").foreachBatch(write).option(
        "checkpointLocation", checkpoint)
    return _triggered(writer, every).start()


def keyed_snapshots(changes: DataFrame, path: str, checkpoint: str, alerts: str | None = None,
                    every: str | None = TABLE_TRIGGER, **options) -> StreamingQuery:
    """Take the changed keys of each batch into the store at ``path``, and those on alert into ``alerts``.

    ``options`` go to :class:`SnapshotStore` (buckets, compact_every, keep). A key leaves the alerts
    when it recovers, and both stores when it is gone.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            SnapshotStore(spark, path, STATE_KEYS, **options).apply(batch, batch_id)
            if alerts is not None:
                off = ~F.coalesce(F.col("alert_tier").isin(ALERT_TIERS), F.lit(False))
                SnapshotStore(spark, alerts, STATE_KEYS, **options).apply(
                    batch.withColumn(GONE, F.col(GONE) | off), batch_id)
        finally:
            batch.unpersist()

    writer = changes.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, every).start()


def run_until_stopped(spark: SparkSession,
                      starters: Sequence[Callable[[], StreamingQuery]]) -> None:
    """Start every query and wait; when one ends or fails, stop them all."""
    running: list[StreamingQuery] = []
    spark.streams.resetTerminated()  # a query that ended earlier must not end the wait
    try:
        for start in starters:
            running.append(start())
        spark.streams.awaitAnyTermination()
    finally:
        for query in running:
            query.stop()


def new_stream_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/streams/{name}-{uuid.uuid4().hex}"


def catch_up(start: Callable[[str, str], StreamingQuery], spark: SparkSession, name: str) -> str:
    """Run a query over all that its source holds now; returns the folder it wrote.

    ``start`` takes the output folder and the checkpoint folder.
    """
    folder = new_stream_folder(spark, name)
    query = start(f"{folder}/table", f"{folder}/checkpoint")
    query.awaitTermination()
    return f"{folder}/table"
