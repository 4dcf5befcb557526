"""Stream sources: schemas, the Kafka reader, JSON decoding and replay of stored tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.functions.columns import as_money, hundredths, to_iso_instant
from tillwork.streaming.store import newest_state

# --- Fixed values: the messages' fields, and the reader's limits ---------------------
ORDER_FIELDS = (
    "order_id long, user_id long, status string, gender string, created_at string, "
    "returned_at string, shipped_at string, delivered_at string, num_of_item int, "
    "country string, traffic_source string, product_id long, category string, brand string, "
    "sale_price double, cost double, is_anomaly boolean")
EVENT_FIELDS = (
    "event_id long, user_id long, session_id string, event_type string, funnel_depth int, "
    "ip_address string, city string, country string, traffic_source string, browser string, "
    "created_at string, uri string")
INVENTORY_FIELDS = (
    "inventory_item_id long, product_id long, product_name string, category string, "
    "brand string, distribution_center string, cost double, product_retail_price double, "
    "stock_quantity int, sold_quantity int, available_quantity int, is_low_stock boolean, "
    "is_out_of_stock boolean, updated_at string")
REVENUE_FIELDS = (
    "order_id long, user_id long, product_id long, category string, brand string, "
    "country string, traffic_source string, sale_price double, cost double, "
    "gross_margin double, num_of_item int, total_revenue double, total_cost double, "
    "total_margin double, status string, created_at string")
# -------------------------------------------------------------------------------------


def kafka_options(servers: str, topic: str, max_offsets: int | None = None,
                  accept_loss: bool = False) -> dict:
    """Read from the first offset on. Expired offsets are an error unless their loss is accepted;
    a limit per micro-batch is the caller's choice, since a low one makes the reader fall behind."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false" if accept_loss else "true",
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_topic(spark: SparkSession, servers: str, topic: str, fields: str,
               max_offsets: int | None = None, accept_loss: bool = False) -> DataFrame:
    """A Kafka topic of JSON messages as columns (needs the Kafka connector package)."""
    raw = (spark.readStream.format("kafka")
           .options(**kafka_options(servers, topic, max_offsets, accept_loss)).load())
    return decode_json(raw, fields)


def decode_json(raw: DataFrame, fields: str) -> DataFrame:
    """Binary ``value`` holding JSON to one column per field; broken JSON gives nulls."""
    message = F.from_json(F.col("value").cast("string"), fields)
    return raw.select(message.alias("message")).select("message.*")


def replay(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet",
           files_per_trigger: int = 1) -> DataFrame:
    """The Parquet files of a folder as a stream, a few files per micro-batch."""
    return (spark.readStream.schema(schema)
            .options(maxFilesPerTrigger=files_per_trigger, pathGlobFilter=pattern)
            .parquet(folder))


def replay_in_order(table: DataFrame, arrival: Column, batches: int, folder: str, files: int = 1) -> DataFrame:
    """The rows of a table as a stream that takes the rows of ``arrival`` 0 first, then those of 1, and so on.

    Every step is written as ``files`` files after the one before it, and makes a micro-batch of its own. So
    the watermark of each batch, and which rows come too late for it, follow from the table alone.
    """
    spark, steps = table.sparkSession, table.withColumn("_step", arrival)
    for step in range(batches):
        steps.where(F.col("_step") == step).drop("_step").repartition(files).write.mode("append").parquet(folder)
    return replay(spark, folder, table.schema, files_per_trigger=files)


def read_back(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Everything a stream has written below ``path``, with merged schemas.

    A stream that has not written yet gives an empty frame of ``schema``.
    """
    try:
        return spark.read.options(mergeSchema=True, recursiveFileLookup=True).parquet(path)
    except AnalysisException as error:
        waiting = error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
        if schema is None or not waiting:
            raise
        return spark.createDataFrame([], schema)


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete state that a stream keeps below ``path``.

    A store is read through its pointer; of a history (``batch_id=`` folders) only the folder names are
    listed, and the newest folder is read.
    """
    state = newest_state(spark, path)
    if state is not None:
        return state
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)]
    newest = max(int(n.partition("=")[2]) for n in names if n.startswith("batch_id="))
    return spark.read.parquet(f"{path}/batch_id={newest}").withColumn("batch_id", F.lit(newest))


# --- the star schema's events table, seen as the four streams --------------------------

# --- Fixed values: how event kinds and users stand for the streams' domains
_STAGE = {"view": "home", "error": "department", "click": "product", "signup": "cart",
          "purchase": "purchase"}
_STATUS = {"view": "Processing", "error": "Cancelled", "click": "Shipped", "signup": "Complete",
           "purchase": "Returned"}
CATEGORIES = ["Jeans", "Swim", "Active", "Accessories", "Skirts", "Socks & Hosiery"]
SOURCES = ["Organic", "Adwords", "Facebook", "Email", "Search"]
# ---


def _lookup(column, table: dict):
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.element_at(F.create_map(*pairs), column)


def _pick_by(column, names: list[str]):
    return F.element_at(F.array(*map(F.lit, names)), (column % len(names) + 1).cast("int"))


def star_web_events(events: DataFrame) -> DataFrame:
    """A session is one user's day."""
    day = F.date_format("ts", "yyyyMMdd")
    return events.select(
        "event_id", "user_id",
        F.concat_ws("-", F.col("user_id").cast("string"), day).alias("session_id"),
        _lookup(F.col("event_type"), _STAGE).alias("event_type"),
        _pick_by(F.col("user_id"), SOURCES).alias("traffic_source"),
        to_iso_instant(F.col("ts")).alias("created_at"))


def star_order_messages(events: DataFrame) -> DataFrame:
    """The top of the 0-99 scale in ``props`` marks an anomalous order."""
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        F.col("event_id").alias("order_id"), "user_id",
        _lookup(F.col("event_type"), _STATUS).alias("status"),
        (k % 20 + 1).alias("num_of_item"),
        as_money(hundredths(F.col("value")), 2).alias("sale_price"),
        (k >= 97).alias("is_anomaly"),
        to_iso_instant(F.col("ts")).alias("created_at"))


def star_inventory_messages(events: DataFrame) -> DataFrame:
    """The event's value, modulo 60, is the quantity available."""
    available = F.floor(F.col("value") % 60).cast("int")
    sold = (F.col("event_id") % 50 + 10).cast("int")
    user = F.col("user_id")
    return events.select(
        F.col("event_id").alias("inventory_item_id"), user.alias("product_id"),
        F.concat(F.lit("Product "), user.cast("string")).alias("product_name"),
        _pick_by(user, CATEGORIES).alias("category"),
        F.concat(F.lit("Brand "), (user % 7).cast("string")).alias("brand"),
        F.concat(F.lit("Center "), (user % 4).cast("string")).alias("distribution_center"),
        F.lit(10.0).alias("cost"), (F.lit(20.0) + user % 9).alias("product_retail_price"),
        (available + sold).alias("stock_quantity"), sold.alias("sold_quantity"),
        available.alias("available_quantity"),
        (available <= 10).alias("is_low_stock"), (available == 0).alias("is_out_of_stock"),
        to_iso_instant(F.col("ts")).alias("updated_at"))


def star_revenue_messages(events: DataFrame) -> DataFrame:
    """Cost is a share of the price that differs by event, so margins vary."""
    user, cents = F.col("user_id"), hundredths(F.col("value"))
    items = F.get_json_object("props", "$.k").cast("int") % 3 + 1
    share = F.lit(50) + F.col("event_id") % 40
    # In units of a hundredth of a cent
    price, cost, margin = cents * 100, cents * share, cents * (F.lit(100) - share)

    def money(units):
        return as_money(units, 4)

    return events.select(
        F.col("event_id").alias("order_id"), "user_id", user.alias("product_id"),
        _pick_by(user, CATEGORIES).alias("category"),
        F.concat(F.lit("Brand "), (user % 7).cast("string")).alias("brand"),
        _pick_by(F.col("event_id"), SOURCES).alias("traffic_source"),
        money(price).alias("sale_price"), money(cost).alias("cost"),
        money(margin).alias("gross_margin"), items.alias("num_of_item"),
        money(price * items).alias("total_revenue"), money(cost * items).alias("total_cost"),
        money(margin * items).alias("total_margin"),
        to_iso_instant(F.col("ts")).alias("created_at"))
