"""Streaming jobs: the same result as on a table, late data, restarts, and sinks."""

import json
import os
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillwork.sources import streams
from tillwork.streaming import jobs, rollups, sinks

START = datetime(2024, 1, 1)


def iso(seconds):
    at = START + timedelta(seconds=seconds)
    return at.strftime("%Y-%m-%dT%H:%M:%S.") + f"{at.microsecond // 1000:03d}Z"


class Topic:
    """A folder of JSON messages as a stream source; each batch of messages is one file."""

    def __init__(self, spark, folder, fields):
        self.spark, self.folder, self.fields = spark, folder, fields
        self.files = 0
        folder.mkdir()

    def send(self, *messages):
        lines = [m if isinstance(m, str) else json.dumps(m) for m in messages]
        file = self.folder / f"{self.files:04d}.txt"
        file.write_text("\n".join(lines) + "\n")
        os.utime(file, (1_700_000_000 + self.files,) * 2)  # the source reads files by age
        self.files += 1

    def _decoded(self, text):
        return streams.decode_json(text.select(F.col("value").cast("binary").alias("value")), self.fields)

    def stream(self):
        return self._decoded(self.spark.readStream.option("maxFilesPerTrigger", 1).text(str(self.folder)))

    def table(self):
        return self._decoded(self.spark.read.text(str(self.folder)))


def order(i, seconds, status="Complete", price=10.0, items=1, odd=False, user=None):
    return {"order_id": i, "user_id": user or i, "status": status, "sale_price": price,
            "num_of_item": items, "is_anomaly": odd, "created_at": iso(seconds)}


def run(result, tmp_path, name="out"):
    sinks.append_table(result, str(tmp_path / name), str(tmp_path / f"{name}-state"), every=None).awaitTermination()
    return result.sparkSession.read.parquet(str(tmp_path / name))


def keyed(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


ORDER_COLUMNS = ["window_start", "status", "total_orders", "anomaly_count", "anomaly_rate_pct",
                 "avg_sale_price", "max_sale_price", "avg_items", "max_items", "total_gmv"]


def test_orders_equal_the_table_and_late_rows_are_dropped(spark, tmp_path):
    topic = Topic(spark, tmp_path / "in", streams.ORDER_FIELDS)
    topic.send(order(1, 5, odd=True), order(2, 30, price=30.0, items=4), order(3, 70, "Returned"))
    topic.send(order(4, 20), "{broken", order(5, 400))           # 4 is late but within 2 minutes
    topic.send(order(9, 401))  # a watermark filters late rows from the batch after next on
    topic.send(order(6, 50, price=999.0), order(7, 4000))        # 6 is beyond the watermark
    topic.send(order(8, 9000))
    got = run(jobs.order_anomaly(topic.stream()), tmp_path)
    on_time = topic.table().filter("order_id <> 6 OR order_id IS NULL")
    expected = jobs.order_anomaly(on_time).filter(F.col("window_end") <= F.lit(iso(9000 - 120)).cast("timestamp"))
    assert keyed(got, *ORDER_COLUMNS) == keyed(expected.filter("window_start IS NOT NULL"), *ORDER_COLUMNS)
    first = got.filter("total_orders = 3").first()
    assert (first["anomaly_count"], first["anomaly_rate_pct"], first["total_gmv"]) == (1, 33.33, 50.0)
    assert first["stream_name"] == "order_anomaly" and first["processed_at"] is not None


def test_restart_adds_no_duplicates(spark, tmp_path):
    topic = Topic(spark, tmp_path / "in", streams.ORDER_FIELDS)
    topic.send(order(1, 5), order(2, 300))
    run(jobs.order_anomaly(topic.stream()), tmp_path)
    topic.send(order(3, 310), order(4, 1000))
    run(jobs.order_anomaly(topic.stream()), tmp_path)
    got = run(jobs.order_anomaly(topic.stream()), tmp_path)
    assert got.count() == got.select("window_start", "status").distinct().count()
    assert got.agg(F.sum("total_orders")).first()[0] == 3


def event(i, seconds, kind, session, source="Search", user=1):
    return {"event_id": i, "user_id": user, "session_id": session, "event_type": kind,
            "traffic_source": source, "created_at": iso(seconds)}


def test_funnel_rates_and_sliding_windows(spark, tmp_path):
    topic = Topic(spark, tmp_path / "in", streams.EVENT_FIELDS)
    topic.send(event(1, 10, "home", "a"), event(2, 20, "cart", "a"), event(3, 25, "cart", "b", user=2),
               event(4, 29, "purchase", "b", user=2), event(5, 15, "product", "z", "Email", 3))
    topic.send(event(6, 9000, "home", "c"))
    got = run(jobs.traffic_funnel(topic.stream()), tmp_path).filter("traffic_source = 'Search'")
    assert got.count() == 4  # every event lies in four overlapping windows
    row = got.orderBy("window_start").first()
    assert (row["total_events"], row["total_sessions"], row["unique_users"]) == (4, 2, 2)
    assert (row["funnel_conversion_pct"], row["cart_abandon_pct"]) == (100.0, 50.0)
    none = jobs.traffic_funnel(topic.table(), distinct="exact").filter("traffic_source = 'Email'").first()
    assert (none["funnel_conversion_pct"], none["cart_abandon_pct"]) == (0.0, 0.0)


def test_exact_funnel_equals_estimates_on_few_sessions(spark, star):
    messages = streams.star_web_events(star.table("events"))
    exact = jobs.traffic_funnel(messages, "1 hour", None, distinct="exact")
    close = jobs.traffic_funnel(messages, "1 hour", None)
    columns = ["window_start", "traffic_source", "total_events", "total_sessions", "stage_home", "unique_users"]
    assert keyed(exact, *columns) == keyed(close, *columns)


def stock(i, seconds, available, product=1, name="P"):
    return {"inventory_item_id": i, "product_id": product, "product_name": name, "category": "Jeans",
            "brand": "B", "distribution_center": "N", "cost": 1.0, "product_retail_price": 2.5,
            "stock_quantity": 50, "sold_quantity": 3, "available_quantity": available,
            "is_low_stock": (available or 0) <= 10, "is_out_of_stock": available == 0,
            "updated_at": iso(seconds)}


def test_inventory_takes_the_newest_by_event_time(spark, tmp_path):
    topic = Topic(spark, tmp_path / "in", streams.INVENTORY_FIELDS)
    topic.send(stock(1, 10, 40), stock(2, 60, 4), stock(3, 20, 0, product=2))
    topic.send(stock(4, 30, 99), stock(5, 70, None, name=None))   # an old update, and one of nulls
    path, alerts = str(tmp_path / "state"), str(tmp_path / "alerts")
    sinks.snapshots(jobs.inventory_state(topic.stream()), path, str(tmp_path / "c"), alerts, every=None).awaitTermination()
    newest = streams.latest_snapshot(spark, path)
    got = {r["product_id"]: r for r in newest.collect()}
    assert (got[1]["available_quantity"], got[1]["product_name"], got[1]["update_count"]) == (4, "P", 4)
    assert (got[1]["alert_tier"], got[1]["potential_lost_revenue"]) == ("WARNING", 15.0)
    assert (got[2]["alert_tier"], got[2]["potential_lost_revenue"]) == ("CRITICAL", 25.0)
    assert newest.count() == 2 and spark.read.parquet(path).count() > 2
    assert streams.latest_snapshot(spark, alerts).count() == 2
    counts = [tuple(r) for r in rollups.alert_counts(newest).collect()]
    assert counts == [("CRITICAL", 1), ("WARNING", 1)]


def test_revenue_joins_targets(spark, tmp_path):
    topic = Topic(spark, tmp_path / "in", streams.REVENUE_FIELDS)

    def sale(i, seconds, category, revenue, cost):
        return {"order_id": i, "user_id": i, "category": category, "traffic_source": "Email",
                "sale_price": revenue, "cost": cost, "gross_margin": revenue - cost, "num_of_item": 1,
                "total_revenue": revenue, "total_cost": cost, "total_margin": revenue - cost, "created_at": iso(seconds)}
    topic.send(sale(1, 10, "Jeans", 100.0, 70.0), sale(2, 10, "Swim", 100.0, 63.0),
               sale(3, 10, "Accessories", 100.0, 90.0), sale(4, 10, "Hats", 0.0, 0.0), sale(5, 9000, "Jeans", 1.0, 1.0))
    got = {r["category"]: r for r in run(jobs.revenue_dashboard(topic.stream()), tmp_path).collect()}
    assert {k: (v["margin_target_pct"], v["vs_margin_target"], v["margin_status"]) for k, v in got.items()} == {
        "Jeans": (30.0, 0.0, "ABOVE_TARGET"), "Swim": (40.0, -3.0, "ON_TARGET"),
        "Accessories": (50.0, -40.0, "BELOW_TARGET"), "Hats": (0.0, 0.0, "ABOVE_TARGET")}


def test_outliers_on_a_stream(spark, tmp_path):
    topic = Topic(spark, tmp_path / "in", streams.ORDER_FIELDS)
    topic.send(*[order(i, i, price=10.0 + i % 3) for i in range(1, 60)],
               order(100, 61, price=5000.0), order(101, 62, items=16), order(102, 63, items=15))
    history = topic.table().filter("order_id < 100").select("status", "sale_price")
    statistics = jobs.price_statistics(history)
    assert statistics.count() == 1
    got = run(jobs.outlier_orders(topic.stream(), statistics), tmp_path)
    assert keyed(got, "order_id", "high_price", "many_items") == [(100, True, False), (101, False, True)]


def test_sketches_add_up_over_windows(spark, star):
    messages = streams.star_web_events(star.table("events"))
    merged = {r[0]: r[1] for r in rollups.distinct_visitors_by_source(
        jobs.visitor_sketches(messages, "1 hour")).collect()}
    exact = {r[0]: r[1] for r in messages.groupBy("traffic_source").agg(F.countDistinct("user_id")).collect()}
    assert merged.keys() == exact.keys()
    assert all(abs(merged[k] - exact[k]) <= 0.05 * exact[k] + 1 for k in exact)


def test_replay_of_stored_files(spark, star, tmp_path):
    copy = str(tmp_path / "events")
    star.table("events").repartitionByRange(5, "event_id").write.parquet(copy)
    for i, file in enumerate(sorted(Path(copy).glob("*.parquet"))):
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))  # files arrive in time order
    source = streams.replay(spark, copy, star.table("events").schema)
    got = run(jobs.order_anomaly(streams.star_order_messages(source), "1 hour", late="2 minutes"), tmp_path)
    columns = ["window_start", "status", "total_orders", "total_gmv"]
    assert set(keyed(got, *columns)) <= set(keyed(jobs.order_anomaly(
        streams.star_order_messages(star.table("events")), "1 hour"), *columns))
    assert got.count() > 500


def test_console_sink_and_life_cycle(spark, tmp_path):
    topic = Topic(spark, tmp_path / "in", streams.ORDER_FIELDS)
    topic.send(order(1, 5), order(2, 900))
    started = []

    def start():
        started.append(sinks.console(jobs.order_anomaly(topic.stream()), str(tmp_path / "c"), every=None))
        return started[0]
    sinks.run_until_stopped(spark, [start])
    assert not spark.streams.active
    assert sum(p["numInputRows"] for p in started[0].recentProgress) == 2
    assert "Console" in started[0].lastProgress["sink"]["description"]


def test_a_failing_query_stops_the_others(spark, tmp_path):
    topic = Topic(spark, tmp_path / "in", streams.ORDER_FIELDS)
    topic.send(order(1, 5))

    def broken():
        raise RuntimeError("no source")
    with pytest.raises(RuntimeError):
        sinks.run_until_stopped(spark, [lambda: sinks.append_table(
            jobs.order_anomaly(topic.stream()), str(tmp_path / "o"), str(tmp_path / "c")), broken])
    assert not spark.streams.active


def test_reading_back_a_stream_without_output(spark, tmp_path):
    schema = "window_start timestamp, total_gmv double"
    assert streams.read_back(spark, str(tmp_path / "nothing"), schema).count() == 0
    spark.range(2).write.parquet(str(tmp_path / "t/a"))
    spark.range(3).selectExpr("id", "'x' AS extra").write.parquet(str(tmp_path / "t/b"))
    merged = streams.read_back(spark, str(tmp_path / "t"))
    assert merged.count() == 5 and set(merged.columns) == {"id", "extra"}


def test_kafka_options():
    options = streams.kafka_options("host:1", "orders")
    assert options["subscribe"] == "orders" and options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "true" and "maxOffsetsPerTrigger" not in options
    bounded = streams.kafka_options("host:1", "orders", max_offsets=7, accept_loss=True)
    assert (bounded["maxOffsetsPerTrigger"], bounded["failOnDataLoss"]) == ("7", "false")


def test_exact_funnel_keeps_events_without_source(spark):
    rows = [(1, 1, "a", "home", None, "2024-01-01T00:00:00.000Z"), (2, 2, "b", "home", "X", "2024-01-01T00:00:01.000Z"),
            (3, None, None, "cart", "X", "2024-01-01T00:00:01.000Z")]
    df = spark.createDataFrame(rows, "event_id long, user_id long, session_id string, event_type string, "
                                     "traffic_source string, created_at string")
    got = [sorted(map(tuple, jobs.traffic_funnel(df, "1 hour", None, distinct=kind).select(
        F.coalesce("traffic_source", F.lit("-")), "total_events", "total_sessions", "unique_users", "stage_home").collect()))
        for kind in ("exact", "approx")]
    assert got[0] == got[1] == [("-", 1, 1, 1, 1), ("X", 2, 1, 1, 1)]


def test_exact_funnel_copies_no_event_per_distinct_count(spark, star):
    counted = jobs.traffic_funnel(streams.star_web_events(star.table("events")), "1 hour", None, distinct="exact")
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and plan.count("Aggregate") == 2 and plan.count("Relation") == 1


def test_exact_funnel_by_hand(spark):
    import random
    r = random.Random(6)
    data = [(i if r.random() < 0.95 else None, r.choice([1, 2, 3, None]), r.choice(["a", "b", "c", None]),
             r.choice([*jobs.FUNNEL_STAGES, "other", None]), r.choice(["X", "Y", None]), f"2024-01-01T0{r.randrange(3)}:00:01.000Z") for i in range(400)]
    df = spark.createDataFrame(data, "event_id long, user_id long, session_id string, event_type string, traffic_source string, created_at string")
    got = {(x["window_start"].hour, x["traffic_source"]): x for x in jobs.traffic_funnel(df, "1 hour", None, distinct="exact").collect()}
    for hour in range(3):
        for source in ("X", "Y", None):
            mine, row = [d for d in data if d[4] == source and f"T0{hour}" in d[5]], got.pop((hour, source))
            assert row["total_events"] == sum(d[0] is not None for d in mine)
            assert row["total_sessions"] == len({d[2] for d in mine} - {None})
            assert row["unique_users"] == len({d[1] for d in mine} - {None})
            for stage in jobs.FUNNEL_STAGES:
                assert row[f"stage_{stage}"] == len({d[2] for d in mine if d[3] == stage} - {None})
    assert not got


def test_replay_in_order_decides_what_is_late(spark, tmp_path):
    """A batch drops what had closed by the watermark that the batch before it began with."""
    rows = [(i, "Complete", 1, 10.0, False, iso(s), step) for i, (s, step) in enumerate(
        [(5, 0), (4000, 0), (10, 1), (8000, 1), (20, 2), (4001, 2), (4002, 3), (20000, 3), (8001, 4), (20001, 5)])]
    table = spark.createDataFrame(rows, "order_id long, status string, num_of_item int, sale_price double, is_anomaly boolean, created_at string, step int")
    table = table.withColumn("user_id", F.col("order_id"))
    stream = streams.replay_in_order(table, F.col("step"), 6, str(tmp_path / "steps"))
    out = sinks.append_table(jobs.order_anomaly(stream, "1 hour"), str(tmp_path / "o"), str(tmp_path / "c"), every=None)
    out.awaitTermination()
    batches = [p["numInputRows"] for p in out.recentProgress if p["numInputRows"]]
    assert batches == [2, 2, 2, 2, 1, 1]
    got = keyed(spark.read.parquet(str(tmp_path / "o")).select(F.hour("window_start").alias("h"), "total_orders"), "h", "total_orders")
    # (20, 2) comes when the watermark of batch 1, 4000 s less two minutes, is known; (4002, 3) after 8000 s.
    assert got == [(0, 2), (1, 2), (2, 2)]


def test_exact_funnel_on_a_stream(spark, tmp_path):
    topic = Topic(spark, tmp_path / "in", streams.EVENT_FIELDS)
    topic.send(event(1, 10, "home", "a"), event(2, 20, "cart", "a"), event(3, 25, "cart", "b", user=2))
    topic.send(event(4, 29, "purchase", "b", user=2), event(5, 70, "home", "a"), event(6, 15, "home", None, user=None))
    topic.send(event(7, 9000, "home", "c"))
    topic.send(event(8, 9001, "home", "d"))
    got = run(jobs.traffic_funnel(topic.stream(), "1 minute", None, distinct="exact"), tmp_path)
    want = jobs.traffic_funnel(topic.table(), "1 minute", None, distinct="exact").where(F.col("window_end") < F.lit("2024-01-01 01:00:00"))
    columns = [c for c in want.columns if c != "processed_at"]
    assert keyed(got, *columns) == keyed(want, *columns) and got.count() == 2


def test_streams_read_a_table_of_several_files(spark, tmp_path):
    from tests.conftest import SMALL
    from tillwork.registry import QUERIES
    spark.read.parquet(f"{SMALL}/events.parquet").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    want = QUERIES["s1_order_anomaly_stream"](spark, SMALL)
    got = QUERIES["s1_order_anomaly_stream"](spark, str(tmp_path))
    assert got.count() > 0 and got.columns == want.columns


def test_empty_roll_ups(spark):
    orders = spark.createDataFrame([], "total_orders long")
    funnel = spark.createDataFrame([], "unique_users long, stage_purchase long, stage_home long")
    state = spark.createDataFrame([], "is_out_of_stock boolean")
    revenue = spark.createDataFrame([], "gross_revenue double, gross_margin double")
    got = rollups.key_figures(orders, funnel, state, revenue).first()
    assert tuple(got) == (0.0, 0.0, 0, 0, 0, 0.0)


def test_application_runs_all_four_jobs(spark, tmp_path):
    from tillwork.streaming import app
    topics = {kind: Topic(spark, tmp_path / kind, fields) for kind, fields in app.FIELDS.items()}
    topics["orders"].send(order(1, 5), order(2, 9000))
    topics["events"].send(event(1, 5, "home", "a"), event(2, 9000, "home", "b"))
    topics["inventory"].send(stock(1, 5, 3))
    topics["revenue"].send({"order_id": 1, "category": "Jeans", "traffic_source": "Email", "total_revenue": 9.0,
                            "total_margin": 3.0, "created_at": iso(5)},
                           {"order_id": 2, "category": "Jeans", "created_at": iso(9000)})
    base = str(tmp_path / "base")
    begin = app.starters(lambda kind: topics[kind].stream(), base, str(tmp_path / "state"), every=None, bases=True)
    assert len(begin) == 7
    for query in [start() for start in begin]:
        query.awaitTermination()
    assert len(app.starters(lambda kind: topics[kind].stream(), base, base, consoles=True)) == 8
    orders, funnel, revenue = (streams.read_back(spark, f"{base}/{name}") for name in app.WINDOWED)
    state = streams.latest_snapshot(spark, f"{base}/inventory_alert")
    assert orders.count() == 1 and funnel.count() == 4 and revenue.count() == 4 and state.count() == 1
    minutes, sales, visitors = (streams.read_back(spark, f"{base}/{name}") for name in app.BASES)
    figures = rollups.key_figures(orders, minutes, state, sales).first()
    assert (figures["revenue"], figures["orders"], figures["out_of_stock"], figures["visitors"]) == (9.0, 1, 0, 1)
    assert [tuple(r) for r in rollups.distinct_visitors_by_source(visitors).collect()] == [("Search", 1)]
    dated = spark.read.parquet(f"{base}/order_anomaly").filter("window_date = DATE'2024-01-01'")
    assert "PartitionFilters: [isnotnull(window_date" in dated._jdf.queryExecution().executedPlan().toString()
