"""Intermediate tables: where they go, and that a scope removes its own."""

from pathlib import Path
from threading import Barrier, Thread

from pyspark.sql import functions as F

from tests.conftest import SMALL
from tillwork.registry import QUERIES
from tillwork.session import scratch, shared_folder, stored, written, written_evenly


def test_a_scope_removes_what_it_wrote(spark):
    tables = Path(shared_folder(spark).removeprefix("file:")) / "tables"
    outside = written(spark.range(3), "outside")
    before = set(tables.iterdir())
    with scratch(spark) as paths:
        for name in ("p1_item_features", "m2_customer_clusters"):
            QUERIES[name](spark, SMALL).write.format("noop").mode("overwrite").save()
        assert paths and set(tables.iterdir()) > before
    assert set(tables.iterdir()) == before and outside.count() == 3


def exists(df):
    return all(Path(f.removeprefix("file:")).exists() for f in df.inputFiles())


def test_scopes_may_be_nested(spark):
    with scratch(spark) as outer:
        first = written(spark.range(2), "a")
        with scratch(spark) as inner:
            second = written(spark.range(2), "b")
            kept = stored(spark, "c", lambda: written(spark.range(5), "d"))
            assert len(inner) == 3 and exists(second) and exists(kept)
        assert exists(first) and not exists(second) and not exists(kept)
        third = written(spark.range(2), "e")
        assert len(outer) == 5
    assert not exists(first) and not exists(third)


def test_scopes_of_threads_are_their_own(spark):
    both, seen = Barrier(2, timeout=60), {}

    def run(name, waits):
        with scratch(spark) as paths:
            table = written(spark.range(3), name)
            both.wait()
            if waits:
                both.wait()  # the other scope has ended by now
                seen[name] = exists(table)
            seen[f"{name} paths"] = len(paths)
        if not waits:
            both.wait()
    threads = [Thread(target=run, args=a) for a in (("one", True), ("two", False))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert seen == {"one": True, "one paths": 1, "two paths": 1}


def test_even_tables_give_every_task_its_share(spark):
    rows = spark.range(40000).select((F.col("id") % 20011).alias("k"), F.lit("x").alias("v"))
    with scratch(spark):
        table = written_evenly(rows.coalesce(1), "even", "k")
        sizes = [r["count"] for r in table.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) >= 8 and max(sizes) <= 2 * min(sizes) and sum(sizes) == 40000
        small = written_evenly(rows, "even", "k", rows_per_file=500)
        assert len(small.inputFiles()) >= 80
