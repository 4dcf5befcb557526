"""Inventory state with expiry, and the store that holds its newest snapshot."""

import json
import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.test_streams import Topic, stock
from tillwork.sources import streams
from tillwork.streaming import jobs, keyed, sinks, store

STATE = ["product_id", "product_name", "available_quantity", "stock_quantity", "retail_price", "is_low_stock", "last_updated", "update_count",
         "alert_tier", "potential_lost_revenue"]


def rows(df, columns=STATE):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def follow(topic, tmp_path, silence, late="1 minute", **options):
    changes = keyed.inventory_changes(topic.stream(), silence, late)
    query = sinks.keyed_snapshots(changes, str(tmp_path / "state"), str(tmp_path / "c"), str(tmp_path / "alerts"), every=None, **options)
    query.awaitTermination()
    return query


def test_state_over_many_batches_equals_the_aggregate(spark, tmp_path):
    topic, r = Topic(spark, tmp_path / "in", streams.INVENTORY_FIELDS), random.Random(5)
    number = 0
    for batch in range(9):
        messages = []
        for _ in range(40):
            number += 1
            messages.append(stock(number, batch * 50 + r.randrange(-100, 50), r.choice([None, 0, 3, 25, 40]), r.randrange(12), r.choice(["P", "Q", None])))
        topic.send(*messages, "{broken")
    query = follow(topic, tmp_path, None, late="1 hour", compact_every=3, buckets=4)
    state = streams.latest_snapshot(spark, str(tmp_path / "state"))
    assert rows(state) == rows(jobs.inventory_state(topic.table()))
    assert len(query.recentProgress) >= 9
    alerts = streams.latest_snapshot(spark, str(tmp_path / "alerts"))
    assert rows(alerts) == rows(jobs.inventory_alerts(state)) != []


def test_silent_keys_leave_state_table_and_alerts(spark, tmp_path):
    topic = Topic(spark, tmp_path / "in", streams.INVENTORY_FIELDS)
    topic.send(stock(1, 0, 3, product=1), stock(2, 10, 40, product=2), stock(3, 20, 0, product=3))
    topic.send(stock(4, 700, 8, product=2), stock(5, 705, 2, product=4))  # 1 and 3 have been silent for ten minutes
    topic.send(stock(6, 710, None, product=4))
    topic.send(stock(7, 720, 9, product=1))  # and 1 begins anew
    topic.send(stock(8, 730, 11, product=4))
    query = follow(topic, tmp_path, "10 minutes")
    got = {r["product_id"]: r for r in streams.latest_snapshot(spark, str(tmp_path / "state")).collect()}
    assert set(got) == {1, 2, 4}
    assert (got[1]["available_quantity"], got[1]["update_count"]) == (9, 1)
    assert (got[4]["available_quantity"], got[4]["update_count"]) == (11, 3)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) >= 4 and held[-1] == 3
    alerts = streams.latest_snapshot(spark, str(tmp_path / "alerts"))
    assert {r["product_id"]: r["alert_tier"] for r in alerts.collect()} == {1: "WARNING", 2: "WARNING"}  # 4 recovered
    # Those that stayed have what the aggregate over their messages has.
    kept = jobs.inventory_state(topic.table()).filter("product_id IN (2, 4)")
    assert rows(streams.latest_snapshot(spark, str(tmp_path / "state")).filter("product_id <> 1")) == rows(kept)


def test_restart_goes_on_with_state_and_store(spark, tmp_path):
    topic = Topic(spark, tmp_path / "in", streams.INVENTORY_FIELDS)
    topic.send(stock(1, 10, 40), stock(2, 60, 4))
    follow(topic, tmp_path, "1 day")
    topic.send(stock(3, 30, 99), stock(4, 90, 7, product=2))
    follow(topic, tmp_path, "1 day")
    follow(topic, tmp_path, "1 day")
    assert rows(streams.latest_snapshot(spark, str(tmp_path / "state"))) == rows(jobs.inventory_state(topic.table()))


SCHEMA = "k string, n long, is_gone boolean"


def size(folder):
    return sum(1 for f in Path(folder).rglob("*.parquet")), sum(1 for f in Path(folder).rglob("*") if f.is_dir())


def test_storage_is_bounded_over_fifty_batches(spark, tmp_path):
    path, r, want = str(tmp_path / "s"), random.Random(1), {}
    table = store.SnapshotStore(spark, path, ["k"], buckets=3, compact_every=4, keep=2)
    sizes = []
    for batch in range(50):
        keys = r.sample([None, *"abcdefghij"], r.randrange(0, 4))
        changes = [(k, batch, r.random() < 0.3) for k in keys]
        for k, n, gone in changes:
            want.pop(k, None) if gone else want.__setitem__(k, n)
        table.apply(spark.createDataFrame(changes, SCHEMA), batch)
        sizes.append(size(path))
        if batch % 7 == 0 or batch == 49:
            assert {x["k"]: x["n"] for x in store.newest_state(spark, path).collect()} == want
    files, folders = max(sizes)
    assert files <= 3 * (2 + 4 + 2 + 1) and folders <= 40 and max(sizes[25:]) <= max(sizes[:25])
    # The state names its files; nothing else below the path is looked at.
    read = {Path(f).relative_to(path).parts[:2] for f in (x.removeprefix("file:") for x in store.newest_state(spark, path).inputFiles())}
    pointer = json.loads((tmp_path / "s/pointer.json").read_text())
    assert read <= {("base", str(v)) for v in pointer["base"].values()} | {("changes", str(c["batch"])) for c in pointer["changes"]}


def test_repeated_and_broken_batches(spark, tmp_path):
    path = str(tmp_path / "s")
    table = store.SnapshotStore(spark, path, ["k"], buckets=2, compact_every=2)

    def changed(*changes):
        return spark.createDataFrame(list(changes), SCHEMA)
    table.apply(changed(("a", 1, False), ("b", 1, False)), 0)
    table.apply(changed(("a", 9, False)), 0)  # the pointer has it: skipped
    os.makedirs(tmp_path / "s/changes/1/bucket=0")  # a try that died before it moved the pointer
    (tmp_path / "s/changes/1/bucket=0/junk.parquet").write_text("torn")
    assert store.newest_state(spark, path).count() == 2
    table.apply(changed(("b", 2, True), ("c", 2, False)), 1)
    assert rows(store.newest_state(spark, path), ["k", "n"]) == [("a", 1), ("c", 2)]
    table.apply(changed(), 2)
    assert rows(store.newest_state(spark, path), ["k", "n"]) == [("a", 1), ("c", 2)]


def test_a_column_that_comes_later(spark, tmp_path):
    path = str(tmp_path / "s")
    table = store.SnapshotStore(spark, path, ["k"], compact_every=3)
    table.apply(spark.createDataFrame([("a", 1, False), ("b", 1, False)], SCHEMA), 0)
    table.apply(spark.createDataFrame([("b", 2, False, "x")], SCHEMA + ", extra string"), 1)
    assert rows(store.newest_state(spark, path), ["k", "n", "extra"]) == [("a", 1, None), ("b", 2, "x")]


def test_no_store_and_wrong_settings(spark, tmp_path):
    assert store.newest_state(spark, str(tmp_path / "none")) is None
    with pytest.raises(ValueError):
        store.SnapshotStore(spark, "x", ["k"], buckets=0)


def test_an_old_history_reads_its_newest_folder_only(spark, tmp_path):
    for batch in (2, 10, 9):
        spark.range(batch).write.parquet(str(tmp_path / f"h/batch_id={batch}"))
    newest = streams.latest_snapshot(spark, str(tmp_path / "h"))
    assert newest.count() == 10 and all("batch_id=10" in f for f in newest.inputFiles())
    assert newest.select(F.max("batch_id")).first()[0] == 10


