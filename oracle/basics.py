"""Oracle SQL for the single operators."""

from oracle.base import d, pct, r, rel
from oracle.reports import SOLD
from oracle.streams import EVENTS

SQL = {
    "src02_quoted_csv": f"""WITH {rel('v_users')}
SELECT user_id, '"' || full_name || '", of' || chr(10) || country AS note FROM v_users""",
    "src03_sql_views": f"""WITH {rel('v_lines', 'v_products')}
SELECT category, status, count(*) AS items, {d('sum(sale_price)')} AS revenue
FROM v_lines JOIN v_products USING (product_id) GROUP BY 1, 2""",
    "src05_json_decode": f"""WITH {EVENTS}
SELECT event_id, user_id, session_id, kind AS event_type, traffic_source,
  strftime(at_ms, '%Y-%m-%dT%H:%M:%S.%gZ') AS created_at FROM e""",
    "prj02_clean_timestamp": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS cleaned FROM events",
    "prj03_delivery_days": f"""WITH {rel('v_items')}
SELECT status, date_diff('second', shipped_at, delivered_at) / 86400.0::DOUBLE AS delivery_days,
  count(*) AS items FROM v_items GROUP BY 1, 2""",
    "prj05_status_flags": f"""WITH {rel('v_lines')}
SELECT status, count(*) FILTER (status = 'Returned') AS is_returned,
  count(*) FILTER (status = 'Complete') AS is_complete FROM v_lines GROUP BY 1""",
    "prj07_age_band": f"""WITH {rel('v_users')}
SELECT user_id, CASE WHEN age < 18 THEN '<18' WHEN age < 25 THEN '18–24' WHEN age < 35 THEN '25–34'
  WHEN age < 45 THEN '35–44' WHEN age < 55 THEN '45–54' WHEN age < 65 THEN '55–64'
  WHEN age < 200 THEN '65+' ELSE 'Unknown' END AS age_group FROM v_users""",
    "prj09_item_margins": f"""WITH {rel('v_lines', 'v_products')},
x AS (SELECT order_id, product_id, sale_price, unit_cost * quantity AS cost
  FROM v_lines LEFT JOIN v_products USING (product_id))
SELECT order_id, product_id, {d('sale_price - cost')} AS profit,
  CASE WHEN sale_price > 0 THEN {r(pct('sale_price - cost', 'sale_price'), 6)} END AS margin_pct FROM x""",
    "agg12_quartiles": f"""WITH {rel('v_lines')} SELECT
  {d('quantile_disc(sale_price, 0.25)')} AS sale_price_q1, {d('quantile_disc(sale_price, 0.75)')} AS sale_price_q3,
  {d('quantile_disc(quantity, 0.25)')} AS quantity_q1, {d('quantile_disc(quantity, 0.75)')} AS quantity_q3
FROM v_lines""",
    "fn_scalar_functions": f"""WITH {rel('v_orders')}
SELECT order_id, status || ' ' || order_id AS label, regexp_replace(status, 'e+', '_', 'g') AS replaced,
  substr(status, 1, 9) AS prefix, strftime(created_at, '%Y-%m') AS month,
  CAST(date_diff('day', created_at, TIMESTAMP '2024-01-01') AS INTEGER) AS days_ago,
  CAST(epoch(created_at) AS BIGINT) AS epoch, abs(order_id - user_id) AS distance,
  order_id // 7 AS sevenths, coalesce(nullif(status, 'Complete'), '-') AS open_status,
  CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END AS parity FROM v_orders""",
    "q1_monthly_growth_every_month": f"""WITH {rel('v_items', 'v_products')},
sold AS (SELECT category, date_trunc('month', created_at) AS month, round(sum(sale_price), 2) AS rev
  FROM v_items JOIN v_products USING (product_id) WHERE status IN {SOLD} GROUP BY 1, 2),
calendar AS (SELECT category, unnest(generate_series(min(month), max(month), INTERVAL 1 month)) AS month
  FROM sold GROUP BY 1),
filled AS (SELECT category, month, coalesce(rev, 0) AS rev FROM calendar LEFT JOIN sold USING (category, month)),
l AS (SELECT *, lag(rev) OVER w AS prev, sum(rev) OVER w AS cum FROM filled
  WINDOW w AS (PARTITION BY category ORDER BY month))
SELECT category, strftime(month, '%Y-%m') AS order_month, {d('rev')} AS monthly_revenue,
  {d('prev')} AS prev_month_revenue,
  {r(f"({d('rev')} - {d('prev')}) / nullif({d('prev')}, 0) * 100")} AS mom_growth_pct,
  {d('cum')} AS cumulative_revenue FROM l""",
}
