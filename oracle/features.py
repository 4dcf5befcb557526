"""Oracle SQL for the feature tables."""

from oracle.base import d, rel

MASTER = f"""{rel('v_priced', 'v_users', 'v_orders')},
master AS (
  SELECT i.order_id, i.product_id, i.user_id, o.status AS order_status, i.created_at AS ordered_at,
    category, department, gender, traffic_source, {d('sale_price')} AS sale_price,
    {d('retail_price')} AS retail_price, {d('cost')} AS cost, {d('age')} AS age
  FROM v_priced i LEFT JOIN v_orders o ON i.order_id = o.order_id
  LEFT JOIN v_users u ON i.user_id = u.user_id
  WHERE sale_price IS NOT NULL AND cost IS NOT NULL AND gender IS NOT NULL
    AND category IS NOT NULL AND traffic_source IS NOT NULL AND age IS NOT NULL)"""


def bounds(table: str, columns: list[str]) -> str:
    cells = []
    for c in columns:
        a, b = f"quantile_disc({c}, 0.25)", f"quantile_disc({c}, 0.75)"
        cells += [f"{a} - ({b} - {a}) * 1.5 AS {c}_lo", f"{b} + ({b} - {a}) * 1.5 AS {c}_hi"]
    return f"SELECT {', '.join(cells)} FROM {table}"


def capped(c: str) -> str:
    return f"least(greatest({c}, {c}_lo), {c}_hi) AS {c}"


CAPPED = ["sale_price", "retail_price", "cost", "age"]
FEATURES = f"""{MASTER}, b AS ({bounds('master', CAPPED)}),
clean AS (SELECT master.* REPLACE ({', '.join(map(capped, CAPPED))}) FROM master, b),
rated AS (SELECT *, CASE WHEN retail_price > 0 THEN (retail_price - sale_price) / retail_price
  ELSE 0.0::DOUBLE END AS discount_rate FROM clean),
features AS (SELECT *, retail_price - cost AS price_gap,
  CAST(discount_rate > 0 AS INTEGER)::DOUBLE AS is_discounted, sale_price - cost AS profit_margin
  FROM rated)"""

SQL = {
    "p1_item_features": f"WITH {FEATURES} SELECT * EXCLUDE (ordered_at) FROM features",
    "p3_rfm_features": f"""WITH {FEATURES},
rfm AS (SELECT user_id, CAST(date_diff('day', max(ordered_at),
    (SELECT max(ordered_at) FROM features)) AS INTEGER) AS recency,
  {d('count(DISTINCT order_id)')} AS frequency,
  {d('sum(CAST(sale_price AS DECIMAL(28,8)))')} AS monetary FROM features GROUP BY 1),
c AS ({bounds('rfm', ['monetary', 'frequency'])})
SELECT rfm.* REPLACE ({capped('monetary')}, {capped('frequency')}) FROM rfm, c""",
    "prj11_return_label": f"""WITH {MASTER}
SELECT order_status, CASE WHEN order_status = 'Returned' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
  AS is_returned, count(*) AS items FROM master GROUP BY 1, 2""",
    "ml07_class_weights": f"""WITH {MASTER},
y AS (SELECT CAST(order_status = 'Returned' AS INTEGER)::DOUBLE AS is_returned FROM master),
w AS (SELECT (count(*) - sum(is_returned)) / nullif(sum(is_returned), 0) AS balance FROM y)
SELECT is_returned, CASE WHEN is_returned = 1 THEN balance ELSE 1.0::DOUBLE END AS class_weight,
  count(*) AS items FROM y, w GROUP BY 1, 2""",
}
