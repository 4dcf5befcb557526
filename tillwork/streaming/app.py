"""All four jobs as one application: from topics of JSON messages to tables.

    spark-submit --packages <the Kafka connector> ... calls
    run(spark, base="hdfs:///streams", source=kafka(spark, "broker:9092"))
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillwork.sources import streams
from tillwork.streaming import jobs, keyed, sinks

# --- Fixed values
TOPICS = {
    "orders": "orders-topic",
    "events": "events-topic",
    "inventory": "inventory-topic",
    "revenue": "revenue-topic",
}
# ---

FIELDS = {"orders": streams.ORDER_FIELDS, "events": streams.EVENT_FIELDS,
          "inventory": streams.INVENTORY_FIELDS, "revenue": streams.REVENUE_FIELDS}
WINDOWED = {
    "order_anomaly": ("orders", jobs.order_anomaly),
    "traffic_funnel": ("events", jobs.traffic_funnel),
    "revenue_dashboard": ("revenue", jobs.revenue_dashboard),
}

# Windows that do not overlap, for roll-ups that add windows up.
BASES = {
    "traffic_funnel_minutes": ("events", partial(jobs.traffic_funnel, length="1 minute", slide=None)),
    "revenue_minutes": ("revenue", partial(jobs.revenue_dashboard, length="1 minute", slide=None)),
    "visitor_sketches": ("events", jobs.visitor_sketches),
}

Source = Callable[[str], DataFrame]


def kafka(spark: SparkSession, servers: str, topics: dict[str, str] | None = None,
          max_offsets: int | None = None) -> Source:
    """Messages of one of the four kinds, read from its topic."""
    names = topics or TOPICS
    return lambda kind: streams.read_topic(spark, servers, names[kind], FIELDS[kind], max_offsets)


def starters(source: Source, base: str, checkpoints: str, every: str | None = sinks.TABLE_TRIGGER,
             consoles: bool = False, bases: bool = False, silence: str | None = "30 days") -> list[Callable[[], StreamingQuery]]:
    """One query per job, and optionally one more that prints it.

    ``bases`` adds the tables that roll-ups over many windows need. Products that are silent for
    ``silence`` leave the inventory.

    Windowed tables are partitioned by the day of the window, so readers prune by date.
    """
    def windowed(name: str) -> list[Callable[[], StreamingQuery]]:
        kind, job = (WINDOWED | BASES)[name]
        result = job(source(kind)).withColumn("window_date", F.to_date("window_start"))
        begin = [lambda: sinks.append_table(result, f"{base}/{name}", f"{checkpoints}/{name}",
                                            every, ["window_date"])]
        if consoles and name in WINDOWED:
            begin.append(lambda: sinks.console(result, f"{checkpoints}/{name}_console"))
        return begin

    changes = keyed.inventory_changes(source("inventory"), silence)
    begin = [lambda: sinks.keyed_snapshots(changes, f"{base}/inventory_alert", f"{checkpoints}/inventory_alert",
                                           f"{base}/inventory_alert_feed", every)]
    if consoles:
        begin.append(lambda: sinks.console(jobs.inventory_alerts(changes),
                                           f"{checkpoints}/inventory_console", mode="update"))
    for name in [*WINDOWED, *(BASES if bases else ())]:
        begin.extend(windowed(name))
    return begin


def run(spark: SparkSession, base: str, source: Source, checkpoints: str | None = None,
        consoles: bool = False, bases: bool = True) -> None:
    """Run all jobs until one of them ends or the application is interrupted."""
    begin = starters(source, base, checkpoints or f"{base}/_checkpoints", consoles=consoles,
                     bases=bases)
    sinks.run_until_stopped(spark, begin)
