"""Oracle SQL for the data-quality checks."""

from oracle.base import d, pct, r, rel

RAW = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _shape(t: str) -> str:
    return f"""SELECT '{t}' AS "table", (SELECT count(*) FROM {t}) AS rows,
  CAST((SELECT count(*) FROM (DESCRIBE {t})) AS INTEGER) AS columns, column_name AS "column",
  CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
    WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE column_type END AS dtype
FROM (DESCRIBE {t})"""


def _describe(table: str, column: str, source: str, expr: str) -> str:
    return f"""SELECT '{table}' AS "table", '{column}' AS "column", count({expr}) AS count,
  {r(f'avg({d(expr)})', 4)} AS mean, {r(f'stddev_samp({d(expr)})', 4)} AS stddev,
  {d(f'min({expr})')} AS min, {d(f'max({expr})')} AS max FROM {source}"""


def _nulls(table: str, source: str, column: str) -> str:
    return f"""SELECT '{table}' AS "table", '{column}' AS "column",
  count(*) - count({column}) AS null_count,
  {r(pct(f'count(*) - count({column})', 'count(*)'))} AS null_pct FROM {source}"""


def _dup(table: str, source: str, key: str) -> str:
    return f"""SELECT '{table}' AS "table", '{key}' AS key, count(*) AS total,
  count(DISTINCT ({key})) AS "unique", count(*) - count(DISTINCT ({key})) AS duplicates FROM {source}"""


def _range(name: str, source: str, expr: str, bad: str, points: bool) -> str:
    cuts = {"p1": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}
    cells = ", ".join(
        (d(f"quantile_disc({expr}, {p})") if points else "CAST(NULL AS DOUBLE)") + f" AS {n}"
        for n, p in cuts.items())
    return f"""SELECT '{name}' AS "check", {d(f'min({expr})')} AS min, {d(f'max({expr})')} AS max,
  count(*) FILTER ({bad}) AS suspicious, count(*) - count({expr}) AS nulls, {cells} FROM {source}"""


STOCK = """v_stock AS (SELECT l_partkey AS product_id, o_orderdate AS created_at,
  CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS sold_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
CHECKED = [
    *(("items", "v_items", c) for c in (
        "order_id", "user_id", "product_id", "status", "sale_price", "created_at",
        "shipped_at", "delivered_at", "returned_at")),
    *(("orders", "v_orders", c) for c in ("order_id", "user_id", "status", "created_at")),
    *(("users", "v_users", c) for c in ("user_id", "full_name", "country", "age", "created_at")),
    *(("products", "v_products", c) for c in ("product_id", "category", "brand")),
    *(("stock", "v_stock", c) for c in ("product_id", "created_at", "sold_at")),
]
BY_STATUS = ", ".join(f"count(*) FILTER ({c} IS NULL) AS null_{c}"
                      for c in ("shipped_at", "delivered_at", "returned_at"))

SQL = {
    "dq01_table_shapes": "\nUNION ALL\n".join(map(_shape, RAW)),
    "dq02_descriptive_statistics": f"WITH {rel('v_lines', 'v_users', 'v_products')}\n" + " UNION ALL ".join([
        _describe("items", "sale_price", "v_lines", "sale_price"),
        _describe("users", "age", "v_users", "age"),
        _describe("products", "cost", "v_products", "unit_cost"),
        _describe("products", "retail_price", "v_products", "unit_cost")]),
    "dq03_nulls": f"WITH {rel('v_items', 'v_orders', 'v_users', 'v_products')}, {STOCK}\n"
                  "SELECT * FROM (" + " UNION ALL ".join(_nulls(*c) for c in CHECKED)
                  + ") WHERE null_count > 0",
    "dq04_nulls_by_status": f"""WITH {rel('v_items')}
SELECT status, count(*) AS total, {BY_STATUS} FROM v_items GROUP BY 1""",
    "dq05_key_duplicates": f"WITH {rel('v_lines', 'v_orders', 'v_users', 'v_products')}\n" + " UNION ALL ".join([
        _dup("orders", "v_orders", "order_id"), _dup("items", "v_lines", "order_id, item_no"),
        _dup("users", "v_users", "user_id"), _dup("products", "v_products", "product_id")]),
    "dq06_items_per_order": f"""WITH c AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT min(n) AS min_items, max(n) AS max_items, {r(f"{d('sum(n)')} / count(*)")} AS avg_items FROM c""",
    "dq07_ranges": f"WITH {rel('v_lines', 'v_users', 'v_products')}\n" + " UNION ALL ".join([
        _range("sale_price", "v_lines", "sale_price", "sale_price <= 0", True),
        _range("cost", "v_products", "unit_cost", "unit_cost <= 0", False),
        _range("age", "v_users", "age", "age < 10 OR age > 100", True)]),
    "dq08_time_order": f"""WITH {rel('v_items')}
SELECT count(*) AS delivered_before_created FROM v_items WHERE delivered_at < created_at""",
    "dq09_status_distribution": f"""WITH {rel('v_lines')}
SELECT status, count(*) AS count, {r(pct('count(*)', 'sum(count(*)) OVER ()'))} AS pct,
  status IN ('Complete','Shipped','Processing','Cancelled','Returned') AS expected
FROM v_lines GROUP BY 1""",
    "dq09_status_domain": f"""WITH {rel('v_lines')}, expected(status) AS (VALUES ('Complete'),
  ('Processing'), ('Cancelled'), ('Returned'), ('Pending')), found AS (SELECT DISTINCT status FROM v_lines)
SELECT status, 'missing' AS problem FROM (SELECT * FROM expected EXCEPT SELECT * FROM found)
UNION ALL
SELECT status, 'unexpected' AS problem FROM (SELECT * FROM found EXCEPT SELECT * FROM expected)""",
    "dq10_orders_and_items_by_status": f"""WITH {rel('v_lines', 'v_orders')},
o AS (SELECT status, count(*) AS orders_count FROM v_orders GROUP BY 1),
i AS (SELECT status, count(*) AS items_count FROM v_lines GROUP BY 1)
SELECT status, coalesce(orders_count, 0) AS orders_count, coalesce(items_count, 0) AS items_count
FROM o FULL JOIN i USING (status)""",
}
