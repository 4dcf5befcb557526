"""The shop's relations, as the reports see them.

Every report takes a :class:`Shop`. Two kinds exist: :class:`CsvShop` reads the shop's
own seven tables, :class:`StarShop` maps an order/line-item star schema onto the same
relations. A relation is asked for by column, so a join that only supplies columns
nobody asked for is never planned.

=====================  ==================================================================
relation               columns
=====================  ==================================================================
``items``              order_id, item_no (the item's id, or its line in the order), product_id, inventory_item_id, status, sale_price,
                       quantity, user_id, created_at, shipped_at, delivered_at,
                       returned_at; also order_status and ordered_at, looked up from the
                       order, and gender, age, country and traffic_source, from the buyer
``orders``             order_id, user_id, status, created_at
``users``              user_id, full_name, gender, age, country, traffic_source,
                       created_at
``products``           product_id, name, category, brand, department, cost, retail_price
``inventory``          inventory_item_id, center_id
``stock``              product_id, created_at, sold_at
``centers``            center_id, center_name
``web_events``         event_id, user_id, session_id, event_type, traffic_source,
                       created_at
=====================  ==================================================================
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.functions.columns import as_money, clean_timestamp, hundredths, month_key
from tillwork.sources.quoted_csv import read_quoted_csv


class Shop(ABC):
    """Access to the relations; see the module documentation for their columns."""

    #: What tells items apart.
    item_key: tuple[str, ...] = ("order_id", "item_no")

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    @abstractmethod
    def items(self, *columns: str, statuses: Sequence[str] | None = None) -> DataFrame:
        """Items, all or only those of some statuses."""

    @abstractmethod
    def orders(self, *columns: str) -> DataFrame: ...

    @abstractmethod
    def users(self, *columns: str) -> DataFrame: ...

    @abstractmethod
    def products(self, *columns: str) -> DataFrame: ...

    @abstractmethod
    def inventory(self, *columns: str) -> DataFrame: ...

    @abstractmethod
    def stock(self, *columns: str) -> DataFrame: ...

    @abstractmethod
    def centers(self, *columns: str) -> DataFrame: ...

    @abstractmethod
    def web_events(self, *columns: str) -> DataFrame: ...

    @abstractmethod
    def priced_items(self, *columns: str) -> DataFrame:
        """Items with their products, if known: item columns plus category, brand, department,
        cost and retail_price of the whole line."""

    @abstractmethod
    def order_totals(self, metrics: Sequence[Column], statuses: Sequence[str] | None = None,
                     fields: Sequence[str] = ("user_id",), known_orders: bool = False) -> DataFrame:
        """Item metrics added up per order, with ``fields`` out of user_id, month
        (``yyyy-MM`` of creation) and last_at (latest creation time).

        With ``known_orders``, items of an order that is not on record do not count and the
        order says who bought; without it, items that carry their own buyer count as they are.

        ``metrics`` may use order_id, product_id, status, sale_price and quantity. The
        sums are formed before any join, so one huge order is combined on the map side.
        """

    def register(self) -> None:
        """Make the relations available to SQL under the shop's table names."""
        for name in ("items", "orders", "users", "products", "inventory", "stock",
                     "centers", "web_events"):
            getattr(self, name)().createOrReplaceTempView(f"shop_{name}")

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self._read(name)
        return self._tables[name]

    @abstractmethod
    def _read(self, name: str) -> DataFrame: ...


OF_BUYER = {"gender", "age", "country", "traffic_source"}
OF_PRODUCT = {"category", "brand", "department", "cost", "retail_price"}


def _pick(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns) if columns else df


class StarShop(Shop):
    """Maps region/nation/customer/supplier/part/orders/lineitem/events Parquet tables.

    ``lineitem`` has no unique key, so items are counted as rows. Prices become exact
    decimals: totals then do not depend on the order of addition.
    """

    ORDER_COLUMNS = {"user_id", "created_at", "shipped_at", "delivered_at", "returned_at",
                     "order_status", "ordered_at"}

    # --- Fixed values: the tables' columns, declared so that opening one runs no job ---
    SCHEMAS = {
        "region": "r_regionkey int, r_name string",
        "nation": "n_nationkey int, n_name string, n_regionkey int",
        "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                    "c_mktsegment string",
        "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
        "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
                "p_retailprice double",
        "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                  "o_orderdate timestamp_ntz, o_orderpriority string",
        "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                    "l_quantity double, l_extendedprice double, l_discount double, "
                    "l_tax double, l_returnflag string, l_linestatus string, "
                    "l_shipdate timestamp_ntz",
        "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, "
                  "value double, props string",
    }
    # -----------------------------------------------------------------------------------

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(self.SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @staticmethod
    def _status_rules() -> dict[str, Column]:
        returned, closed = F.col("l_returnflag"), F.col("l_linestatus") == "F"
        return {
            "Returned": returned == "R",
            "Complete": (returned == "A") & closed,
            "Shipped": (returned == "A") & ~closed,
            "Processing": (returned == "N") & closed,
            "Cancelled": (returned == "N") & ~closed,
        }

    def _lines(self, statuses: Sequence[str] | None = None) -> DataFrame:
        rules = self._status_rules()
        lines = self.table("lineitem")
        if statuses is not None:
            # On the stored columns, so that the scan skips row groups.
            lines = lines.filter(reduce(or_, (rules[s] for s in statuses)))
        cents = hundredths(F.col("l_extendedprice"))
        paid_percent = F.lit(100) - hundredths(F.col("l_discount"))
        return lines.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("item_no"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("inventory_item_id"),
            F.coalesce(*(F.when(rule, name) for name, rule in rules.items())).alias("status"),
            as_money(cents * paid_percent, 4).alias("sale_price"),
            as_money(cents, 2).alias("line_price"),
            F.col("l_quantity").cast("long").cast("decimal(18,0)").alias("quantity"),
            F.col("l_shipdate").alias("moved_at"),
        )

    def items(self, *columns: str, statuses: Sequence[str] | None = None) -> DataFrame:
        columns = columns or ("order_id", "user_id", "product_id", "inventory_item_id", "status",
                              "sale_price", "quantity", "created_at", "shipped_at",
                              "delivered_at", "returned_at")
        lines = self._lines(statuses)
        of_buyer = OF_BUYER & set(columns)
        if of_buyer or self.ORDER_COLUMNS & set(columns):
            heads = self.orders().withColumnRenamed("status", "order_status")
            if of_buyer:
                # Buyers join the orders, which are fewer than the items.
                heads = heads.join(self.users("user_id", *sorted(of_buyer)), "user_id", "left")
            lines = lines.join(heads, "order_id")
            status, moved = F.col("status"), F.col("moved_at")
            lines = lines.withColumns({
                "shipped_at": F.when(status.isin("Shipped", "Complete", "Returned"),
                                     F.col("created_at")),
                "delivered_at": F.when(status.isin("Complete", "Returned"), moved),
                "returned_at": F.when(status == "Returned", moved),
                "ordered_at": F.col("created_at"),
            })
        return lines.select(*columns)

    def orders(self, *columns: str) -> DataFrame:
        # Order statuses share the items' domain.
        status = (F.when(F.col("o_orderstatus") == "F", "Complete")
                  .when(F.col("o_orderstatus") == "P", "Returned")
                  .otherwise("Processing"))
        return _pick(self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            status.alias("status"),
            F.col("o_orderdate").alias("created_at"),
        ), columns)

    def users(self, *columns: str) -> DataFrame:
        key = F.col("c_custkey")
        people = self.table("customer").select(
            key.alias("user_id"),
            F.col("c_name").alias("full_name"),
            F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
            (12 + (key * 7) % 78).cast("int").alias("age"),
            F.col("c_nationkey"),
            F.col("c_mktsegment").alias("traffic_source"),
        )
        if not columns or "country" in columns:
            nation = self.table("nation").select("n_nationkey", F.col("n_name").alias("country"))
            people = people.join(nation, people.c_nationkey == nation.n_nationkey)
        if not columns or "created_at" in columns:
            # A customer signs up with the first order.
            first = (self.orders("user_id", "created_at").groupBy("user_id")
                     .agg(F.min("created_at").alias("created_at")))
            people = people.join(first, "user_id", "left")
        return people.select(*(columns or ("user_id", "full_name", "gender", "age", "country",
                                           "traffic_source", "created_at")))

    def products(self, *columns: str) -> DataFrame:
        price = as_money(hundredths(F.col("p_retailprice")), 2)
        return _pick(self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.when(F.col("p_size") <= 25, "Women").otherwise("Men").alias("department"),
            price.alias("cost"),
            price.alias("retail_price"),
        ), columns)

    def inventory(self, *columns: str) -> DataFrame:
        return _pick(self.table("supplier").select(
            F.col("s_suppkey").alias("inventory_item_id"),
            F.col("s_nationkey").alias("center_id"),
        ), columns)

    def stock(self, *columns: str) -> DataFrame:
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
            F.when(F.col("l_linestatus") == "F", F.col("l_shipdate")).alias("sold_at"))
        return _pick(lines.join(self.orders("order_id", "created_at"), "order_id")
                     .select("product_id", "created_at", "sold_at"), columns)

    def centers(self, *columns: str) -> DataFrame:
        return _pick(self.table("nation").select(
            F.col("n_nationkey").alias("center_id"), F.col("n_name").alias("center_name")), columns)

    def web_events(self, *columns: str) -> DataFrame:
        from tillwork.sources.streams import star_web_events
        return _pick(star_web_events(self.table("events")), columns)

    def priced_items(self, *columns: str) -> DataFrame:
        lines = self.items(*{"product_id", "line_price", "quantity", *columns} - OF_PRODUCT)
        joined = lines.join(
            self.products("product_id", "category", "brand", "department", "cost"),
            "product_id", "left")
        return joined.withColumns({
            "cost": F.col("cost") * F.col("quantity"),
            "retail_price": F.col("line_price"),
        }).select(*columns)

    def order_totals(self, metrics: Sequence[Column], statuses: Sequence[str] | None = None,
                     fields: Sequence[str] = ("user_id",), known_orders: bool = True) -> DataFrame:
        lines = self._lines(statuses)  # without an order there is no buyer here
        per_order = lines.groupBy("order_id").agg(*metrics)
        heads = self.orders("order_id", "user_id", "created_at").select(
            "order_id", "user_id", month_key(F.col("created_at")).alias("month"),
            F.col("created_at").alias("last_at"))
        return per_order.join(heads.select("order_id", *fields), "order_id")


class CsvShop(Shop):
    """Reads the shop's seven header CSV files (quoted, with embedded line breaks).

    The schemas are declared, so no extra pass infers them. Files of this kind cannot
    be split; ``to_parquet`` turns them into tables that can.
    """

    item_key = ("item_no",)

    # --- Fixed values: the files' columns ------------------------------------------
    SCHEMAS = {
        "orders": "order_id long, user_id long, status string, gender string, "
                  "created_at string, returned_at string, shipped_at string, "
                  "delivered_at string, num_of_item int",
        "order_items": "id long, order_id long, user_id long, product_id long, "
                       "inventory_item_id long, status string, created_at string, "
                       "shipped_at string, delivered_at string, returned_at string, "
                       "sale_price double",
        "users": "id long, first_name string, last_name string, email string, age int, "
                 "gender string, state string, street_address string, postal_code string, "
                 "city string, country string, latitude double, longitude double, "
                 "traffic_source string, created_at string",
        "products": "id long, cost double, category string, name string, brand string, "
                    "retail_price double, department string, sku string, "
                    "distribution_center_id long",
        "inventory_items": "id long, product_id long, created_at string, sold_at string, "
                           "cost double, product_category string, product_name string, "
                           "product_brand string, product_retail_price double, "
                           "product_department string, product_sku string, "
                           "product_distribution_center_id long",
        "distribution_centers": "id long, name string, latitude double, longitude double",
        "events": "id long, user_id long, sequence_number int, session_id string, "
                  "created_at string, ip_address string, city string, state string, "
                  "postal_code string, browser string, traffic_source string, uri string, "
                  "event_type string",
    }
    # -------------------------------------------------------------------------------

    def __init__(self, spark: SparkSession, folder: str, pattern: str = "{name}.csv",
                 parquet: bool = False):
        super().__init__(spark, folder)
        self.pattern = pattern
        self.parquet = parquet

    def _read(self, name: str) -> DataFrame:
        path = f"{self.folder}/{self.pattern.format(name=name)}"
        if self.parquet:
            return self.spark.read.schema(self.SCHEMAS[name]).parquet(path)
        return read_quoted_csv(self.spark, path, self.SCHEMAS[name])

    def to_parquet(self, target: str) -> CsvShop:
        """Copy every table to Parquet once and return a shop that reads the copy."""
        for name in self.SCHEMAS:
            self.table(name).write.parquet(f"{target.rstrip('/')}/{name}")
        return CsvShop(self.spark, target, pattern="{name}", parquet=True)

    def _with_times(self, name: str, *columns: str) -> DataFrame:
        return self.table(name).withColumns({c: clean_timestamp(F.col(c)) for c in columns})

    def items(self, *columns: str, statuses: Sequence[str] | None = None) -> DataFrame:
        lines = self._with_times("order_items", "created_at", "shipped_at", "delivered_at",
                                 "returned_at").withColumns({"quantity": F.lit(1), "item_no": F.col("id")})
        if statuses is not None:
            lines = lines.filter(F.col("status").isin(list(statuses)))
        if {"order_status", "ordered_at"} & set(columns):
            heads = self.orders().select("order_id", F.col("status").alias("order_status"),
                                         F.col("created_at").alias("ordered_at"))
            lines = lines.join(heads, "order_id", "left")
        of_buyer = OF_BUYER & set(columns)
        if of_buyer:
            lines = lines.join(self.users("user_id", *sorted(of_buyer)), "user_id", "left")
        return _pick(lines, columns)

    def orders(self, *columns: str) -> DataFrame:
        return _pick(self._with_times("orders", "created_at")
                     .select("order_id", "user_id", "status", "created_at"), columns)

    def users(self, *columns: str) -> DataFrame:
        return _pick(self._with_times("users", "created_at").select(
            F.col("id").alias("user_id"),
            F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
            "gender", "age", "country", "traffic_source", "created_at"), columns)

    def products(self, *columns: str) -> DataFrame:
        return _pick(self.table("products").select(
            F.col("id").alias("product_id"), "name", "category", "brand", "department",
            "cost", "retail_price"), columns)

    def inventory(self, *columns: str) -> DataFrame:
        return _pick(self.table("inventory_items").select(
            F.col("id").alias("inventory_item_id"),
            F.col("product_distribution_center_id").alias("center_id")), columns)

    def stock(self, *columns: str) -> DataFrame:
        return _pick(self._with_times("inventory_items", "created_at", "sold_at")
                     .select("product_id", "created_at", "sold_at"), columns)

    def centers(self, *columns: str) -> DataFrame:
        return _pick(self.table("distribution_centers").select(
            F.col("id").alias("center_id"), F.col("name").alias("center_name")), columns)

    def web_events(self, *columns: str) -> DataFrame:
        return _pick(self._with_times("events", "created_at").select(
            F.col("id").alias("event_id"), "user_id", "session_id", "event_type",
            "traffic_source", "created_at"), columns)

    def priced_items(self, *columns: str) -> DataFrame:
        lines = self.items(*{"product_id", *columns} - OF_PRODUCT)
        return lines.join(
            self.products("product_id", "category", "brand", "department", "cost",
                          "retail_price"), "product_id", "left").select(*columns)

    def order_totals(self, metrics: Sequence[Column], statuses: Sequence[str] | None = None,
                     fields: Sequence[str] = ("user_id",), known_orders: bool = False) -> DataFrame:
        lines = self.items(statuses=statuses).withColumn("month", month_key(F.col("created_at")))
        keys = [f for f in fields if f != "last_at" and not (known_orders and f == "user_id")]
        extra = [F.max("created_at").alias("last_at")] if "last_at" in fields else []
        totals = lines.groupBy("order_id", *keys).agg(*metrics, *extra)
        if known_orders:
            heads = self.orders("order_id", *(["user_id"] if "user_id" in fields else []))
            totals = totals.join(heads, "order_id")
        return totals
