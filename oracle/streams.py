"""Oracle SQL for the streaming jobs (as batches, and as closed windows) and roll-ups."""

from oracle.base import avg8, d, pct, r

STAGE = {"view": "home", "error": "department", "click": "product", "signup": "cart",
         "purchase": "purchase"}
STATUS = {"view": "Processing", "error": "Cancelled", "click": "Shipped", "signup": "Complete",
          "purchase": "Returned"}
CATEGORIES = ["Jeans", "Swim", "Active", "Accessories", "Skirts", "Socks & Hosiery"]
SOURCES = ["Organic", "Adwords", "Facebook", "Email", "Search"]
TARGETS = {"Jeans": 30.0, "Swim": 40.0, "Active": 33.0, "Accessories": 50.0, "Skirts": 35.0,
           "Socks & Hosiery": 20.0}
STAGES = list(STAGE.values())


def case(column: str, table: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table.items()) + " END"


def nth(expr: str, names: list) -> str:
    return f"CASE {expr} % {len(names)} " + " ".join(
        f"WHEN {i} THEN '{n}'" for i, n in enumerate(names)) + " END"


def text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
AT = "date_trunc('millisecond', ts) AS at_ms"

ORDERS = f"""o AS (SELECT event_id, user_id, {case('event_type', STATUS)} AS status,
  {K} % 20 + 1 AS items, CAST(value AS DECIMAL(18,2)) AS price, {K} >= 97 AS odd, {AT} FROM events)"""
EVENTS = f"""e AS (SELECT event_id, user_id, user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
  {case('event_type', STAGE)} AS kind, {nth('user_id', SOURCES)} AS traffic_source, {AT} FROM events)"""
STOCK = f"""i AS (SELECT event_id, user_id AS product_id, 'Product ' || user_id AS product_name,
  {nth('user_id', CATEGORIES)} AS category, 'Brand ' || (user_id % 7) AS brand,
  'Center ' || (user_id % 4) AS distribution_center, 20.0::DOUBLE + user_id % 9 AS retail_price,
  CAST(floor(value % 60) AS INTEGER) AS available, CAST(event_id % 50 + 10 AS INTEGER) AS sold, {AT}
  FROM events)"""
REVENUE = f"""p AS (SELECT *, CAST(value AS DECIMAL(18,2)) AS price, {K} % 3 + 1 AS items,
  {nth('user_id', CATEGORIES)} AS category, {nth('event_id', SOURCES)} AS traffic_source,
  {AT} FROM events),
q AS (SELECT *, CAST(price * CAST(50 + event_id % 40 AS DECIMAL(4,0)) AS DECIMAL(18,2))
  * CAST(0.01 AS DECIMAL(3,2)) AS cost FROM p)"""


def windows(source: str, length: str, slide: str | None, copies: int) -> str:
    """Each row once per window it falls in, as column ``w``."""
    if slide is None:
        return f"SELECT *, time_bucket(INTERVAL '{length}', at_ms) AS w FROM {source}"
    return (f"SELECT *, time_bucket(INTERVAL '{slide}', at_ms) - k * INTERVAL '{slide}' AS w "
            f"FROM {source}, (SELECT unnest(range({copies})) AS k)")


def s1(length: str) -> str:
    return f"""{ORDERS}, b AS ({windows('o', length, None, 1)}),
s1 AS (SELECT {text('w')} AS window_start, {text(f"w + INTERVAL '{length}'")} AS window_end, status,
  count(*) AS total_orders, count(*) FILTER (odd) AS anomaly_count,
  {d('sum(price)')} / count(*) AS avg_sale_price, {d('max(price)')} AS max_sale_price,
  {d('sum(items)')} / count(*) AS avg_items, max(items) AS max_items, {d('sum(price)')} AS total_gmv,
  count(DISTINCT user_id) AS unique_buyers,
  {r(pct('count(*) FILTER (odd)', 'count(*)'))} AS anomaly_rate_pct,
  'order_anomaly' AS stream_name FROM b GROUP BY w, status)"""


def s2(length: str, slide: str | None, copies: int) -> str:
    stage = ",\n  ".join(f"count(DISTINCT session_id) FILTER (kind = '{s}') AS stage_{s}" for s in STAGES)
    return f"""{EVENTS}, c AS ({windows('e', length, slide, copies)}),
f AS (SELECT w, traffic_source, count(*) AS total_events, count(DISTINCT session_id) AS total_sessions,
  {stage}, count(DISTINCT user_id) AS unique_users FROM c GROUP BY 1, 2),
s2 AS (SELECT {text('w')} AS window_start, {text(f"w + INTERVAL '{length}'")} AS window_end,
  * EXCLUDE (w),
  CASE WHEN stage_home > 0 THEN {r(pct('stage_purchase', 'stage_home'))} ELSE 0.0::DOUBLE END
    AS funnel_conversion_pct,
  CASE WHEN stage_cart > 0 THEN {r(pct('stage_cart - stage_purchase', 'stage_cart'))}
    ELSE 0.0::DOUBLE END AS cart_abandon_pct, 'traffic_funnel' AS stream_name FROM f)"""


S3 = f"""{STOCK},
l AS (SELECT product_id, category, brand, distribution_center,
  arg_max(product_name, (at_ms, event_id)) AS product_name,
  arg_max(available, (at_ms, event_id)) AS available_quantity,
  arg_max(available + sold, (at_ms, event_id)) AS stock_quantity,
  arg_max(sold, (at_ms, event_id)) AS sold_quantity, arg_max(retail_price, (at_ms, event_id)) AS retail_price,
  10.0::DOUBLE AS cost, max(at_ms) AS last_at, count(*) AS update_count FROM i GROUP BY 1, 2, 3, 4),
s3 AS (SELECT * EXCLUDE (last_at), {text('last_at')} AS last_updated,
  available_quantity <= 10 AS is_low_stock, available_quantity = 0 AS is_out_of_stock,
  CASE WHEN available_quantity = 0 THEN 'CRITICAL' WHEN available_quantity <= 10 THEN 'WARNING'
       WHEN available_quantity <= 30 THEN 'NOTICE' ELSE 'OK' END AS alert_tier,
  CASE WHEN available_quantity < 10 THEN {r('(10 - available_quantity) * retail_price')}
       ELSE 0.0::DOUBLE END AS potential_lost_revenue, 'inventory_alert' AS stream_name FROM l)"""


def s4(length: str, slide: str | None, copies: int) -> str:
    targets = ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in TARGETS.items())
    return f"""{REVENUE}, g AS ({windows('q', length, slide, copies)}),
t(category, margin_target_pct) AS (VALUES {targets}),
a AS (SELECT w, category, traffic_source, count(*) AS order_count,
  {d('sum(price * items)')} AS gross_revenue, {d('sum(cost * items)')} AS total_cost,
  {d('sum((price - cost) * items)')} AS gross_margin,
  {d('sum(price - cost)')} / count(*) AS avg_margin_per_order, CAST(sum(items) AS BIGINT) AS units_sold,
  count(DISTINCT user_id) AS unique_buyers, {d('sum(price)')} / count(*) AS avg_order_value
  FROM g GROUP BY 1, 2, 3),
m AS (SELECT *, CASE WHEN gross_revenue > 0 THEN {r('gross_margin / gross_revenue * 100')}
  ELSE 0.0::DOUBLE END AS margin_pct FROM a LEFT JOIN t USING (category)),
v AS (SELECT *, {r('margin_pct - margin_target_pct')} AS vs_margin_target FROM m),
s4 AS (SELECT {text('w')} AS window_start, {text(f"w + INTERVAL '{length}'")} AS window_end,
  * EXCLUDE (w), CASE WHEN vs_margin_target >= 0 THEN 'ABOVE_TARGET'
    WHEN vs_margin_target >= -5 THEN 'ON_TARGET' ELSE 'BELOW_TARGET' END AS margin_status,
  'revenue_dashboard' AS stream_name FROM v)"""


def closed(table: str, late: str, drop: str) -> str:
    """Rows of the windows that the watermark has passed."""
    return f"""SELECT * EXCLUDE ({drop}) FROM {table} WHERE strptime(window_end, '%Y-%m-%d %H:%M:%S')
  <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL '{late}'"""


HOUR, HOURS, HALF = "1 hour", "2 hours", "30 minutes"
S1, S2T, S4T = s1(HOUR), s2(HOUR, None, 1), s4(HOUR, None, 1)
STAGE_ROWS = " UNION ALL ".join(
    f"SELECT {i + 1} AS position, '{s}' AS stage, CAST(sum(stage_{s}) AS BIGINT) AS sessions FROM s2"
    for i, s in enumerate(STAGES))


def on_time(late: str, length: str) -> str:
    """Events in the steps they arrive in, without those whose window had closed. A batch drops by the watermark that
    the batch before it began with: what was known two steps earlier."""
    return f"""arrived AS (SELECT *, least(4, (day(ts) - 1) // 6 + CASE WHEN event_id % 10 = 0 THEN 2 ELSE 0 END) AS step FROM events),
marks AS (SELECT s.step, max(date_trunc('millisecond', a.ts)) - INTERVAL '{late}' AS mark
  FROM (SELECT DISTINCT step FROM arrived) s JOIN arrived a ON a.step <= s.step - 2 GROUP BY 1),
kept AS (SELECT a.* FROM arrived a LEFT JOIN marks USING (step)
  WHERE mark IS NULL OR time_bucket(INTERVAL '{length}', date_trunc('millisecond', ts)) + INTERVAL '{length}' > mark)"""


def d8(x: str) -> str:
    return f"sum(CAST({x} AS DECIMAL(28,8)))"


SQL = {
    "s1_order_anomaly": f"WITH {S1} SELECT * FROM s1",
    "s2_traffic_funnel": f"WITH {s2(HOURS, HALF, 4)} SELECT * FROM s2",
    "s2_funnel_reached": f"""WITH {EVENTS},
x AS (SELECT time_bucket(INTERVAL '1 day', at_ms) AS w, traffic_source, session_id,
  max(list_position({STAGES}, kind)) AS depth FROM e GROUP BY 1, 2, 3)
SELECT {text('w')} AS window_start, traffic_source,
  {', '.join(f'count(*) FILTER (depth >= {i + 1}) AS reached_{s}' for i, s in enumerate(STAGES))}
FROM x GROUP BY w, traffic_source""",
    "s3_inventory_state": f"WITH {S3} SELECT * FROM s3",
    "s3_inventory_alerts": f"WITH {S3} SELECT * FROM s3 WHERE alert_tier IN ('CRITICAL', 'WARNING')",
    "s4_revenue_dashboard": f"WITH {s4(HOURS, HALF, 4)} SELECT * FROM s4",
    "s1_order_anomaly_stream": f"WITH {S1} {closed('s1', '2 minutes', 'unique_buyers')}",
    "s3_inventory_snapshot_stream": f"WITH {S3} SELECT * FROM s3",
    "str02_late_orders_stream": f"""WITH {on_time('2 minutes', HOUR)}, {S1.replace('FROM events', 'FROM kept')}
{closed('s1', '2 minutes', 'unique_buyers')}""",
    "s2_exact_funnel_stream": f"""WITH {on_time('3 minutes', HOURS)}, {s2(HOURS, None, 1).replace('FROM events', 'FROM kept')}
{closed('s2', '3 minutes', 'stream_name').replace(' EXCLUDE (stream_name)', '')}""",
    "s3_inventory_active_stream": f"""WITH {S3} SELECT s3.* FROM s3 JOIN l USING (product_id, category, brand, distribution_center)
WHERE last_at >= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL '1 hour' - INTERVAL '12 hours'""",
    "s4_revenue_dashboard_stream": f"WITH {s4(HOURS, HALF, 4)} {closed('s4', '3 minutes', 'unique_buyers')}",
    "str15_outlier_orders": f"""WITH {ORDERS},
h AS (SELECT avg(CAST(price AS DOUBLE)) + 3 * stddev_samp(CAST(price AS DOUBLE)) AS top FROM o)
SELECT event_id AS order_id, status, {d('price')} AS sale_price, items AS num_of_item,
  {d('price')} > top AS high_price, items > 15 AS many_items
FROM o, h WHERE {d('price')} > top OR items > 15""",
    "r1a_value_by_status": f"""WITH {S1}
SELECT status, {d(d8('total_gmv'))} AS total_gmv FROM s1 GROUP BY 1""",
    "r1b_anomaly_trend": f"""WITH {S1}
SELECT window_start, {avg8('anomaly_rate_pct')} AS anomaly_rate_pct FROM s1
GROUP BY 1 ORDER BY 1 DESC LIMIT 30""",
    "r2a_funnel_totals": f"""WITH {S2T}, x AS ({STAGE_ROWS}),
y AS (SELECT *, lag(sessions) OVER (ORDER BY position) AS before FROM x)
SELECT position, stage, sessions, {d('sessions')} / max(sessions) OVER () AS share_of_largest,
  {pct('sessions', 'before')} AS step_conversion_pct FROM y""",
    "r2b_visitors_by_source": f"""WITH {S2T}
SELECT traffic_source, CAST(sum(unique_users) AS BIGINT) AS unique_users FROM s2
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 6""",
    "r3a_stock_matrix": f"""WITH {S3},
tb AS (SELECT brand FROM s3 GROUP BY 1 ORDER BY sum(sold_quantity) DESC, brand LIMIT 5),
tc AS (SELECT category FROM s3 GROUP BY 1 ORDER BY sum(sold_quantity) DESC, category LIMIT 7)
SELECT category, brand, min(stock_quantity) AS smallest_stock
FROM s3 WHERE brand IN (SELECT brand FROM tb) AND category IN (SELECT category FROM tc) GROUP BY 1, 2""",
    "r3b_alert_counts": f"WITH {S3} SELECT alert_tier, count(*) AS count FROM s3 GROUP BY 1",
    "r4a_category_revenue": f"""WITH {S4T},
x AS (SELECT category, {d8('gross_revenue')} AS rev, {d8('gross_margin')} AS mar FROM s4
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 7)
SELECT category, substr(category, 1, 9) AS label, {d('rev')} AS gross_revenue, {d('rev - mar')} AS cost,
  {d('mar')} AS gross_margin, {pct('mar', 'rev')} AS margin_pct FROM x""",
    "r4b_margin_trend": f"""WITH {S4T},
x AS (SELECT window_start, {d(d8('gross_margin'))} / greatest({d(d8('gross_revenue'))}, 1) * 100 AS margin_pct
  FROM s4 GROUP BY 1 ORDER BY 1 DESC LIMIT 30)
SELECT *, {r('avg(margin_pct) OVER ()', 6)} AS avg_margin_pct FROM x""",
    "r5_key_figures": f"""WITH {S1}, {S2T}, {S3}, {S4T}
SELECT (SELECT {d(d8('gross_revenue'))} FROM s4) AS revenue,
  (SELECT {d(d8('gross_margin'))} FROM s4) AS profit,
  (SELECT CAST(sum(total_orders) AS BIGINT) FROM s1) AS orders,
  (SELECT count(*) FILTER (is_out_of_stock) FROM s3) AS out_of_stock,
  CAST(sum(unique_users) AS BIGINT) AS visitors,
  {pct('sum(stage_purchase)', 'greatest(sum(stage_home), 1)')} AS conversion_pct FROM s2""",
}
