"""Both shops treat items of unknown orders alike, and tell items apart by their own key."""

from pyspark.sql import functions as F

from tillwork.plans import quality, reports
from tillwork.sources import CsvShop


def _with_orphan(spark, csv_folder, tmp_path):
    shop = CsvShop(spark, csv_folder).to_parquet(str(tmp_path))
    orphan = shop.table("order_items").filter("id = 1000").withColumns(
        {"id": F.lit(2000).cast("long"), "order_id": F.lit(999).cast("long"), "sale_price": F.lit(100.0)})
    orphan.write.mode("append").parquet(f"{tmp_path}/order_items")
    return CsvShop(spark, str(tmp_path), pattern="{name}", parquet=True)


def test_items_of_unknown_orders_do_not_count(spark, shop, csv_folder, tmp_path):
    other = _with_orphan(spark, csv_folder, tmp_path)
    assert other.items().count() == shop.items().count() + 1
    for report in (reports.top_customers, reports.rfm_segments):
        assert sorted(map(str, report(other).collect())) == sorted(map(str, report(shop).collect()))


def test_items_are_told_apart_by_their_own_key(shop, star):
    found = {r["table"]: r for r in quality.key_duplicates(shop).collect()}
    assert found["items"]["key"] == "item_no" and found["items"]["duplicates"] == 0
    found = {r["table"]: r for r in quality.key_duplicates(star).collect()}
    assert found["items"]["key"] == "order_id, item_no"
