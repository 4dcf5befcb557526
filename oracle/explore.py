"""Oracle SQL for the exploratory analyses."""

from oracle.base import d, pct, r, rel

FULL = rel("v_full")
PRICED = rel("v_priced")
DONE = "status = 'Complete'"


def div(a: str, b: str) -> str:
    return f"({d(a)} / nullif({d(b)}, 0))"


def in_share(per_mille: int, text: str = "concat_ws('|', order_id, item_no)") -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS UBIGINT) % 1000 < {per_mille}"


def r6(x: str) -> str:
    return r(x, 6)


MONTHLY = f"""{rel('v_items')},
monthly AS (SELECT strftime(created_at, '%Y-%m') AS month, count(DISTINCT order_id) AS orders,
  sum(sale_price) AS rev FROM v_items WHERE {DONE} GROUP BY 1)"""

AGES = f"""{rel('v_users')},
bands AS (SELECT CASE WHEN age < 18 THEN '<18' WHEN age < 25 THEN '18–24' WHEN age < 35 THEN '25–34'
    WHEN age < 45 THEN '35–44' WHEN age < 55 THEN '45–54' WHEN age < 65 THEN '55–64'
    ELSE '65+' END AS age_group, count(*) AS count
  FROM v_users WHERE age >= 0 AND age < 120 GROUP BY 1)"""

BUYERS = f"""sum(sale_price) FILTER ({DONE}) AS revenue,
    count(DISTINCT user_id) FILTER ({DONE}) AS buyers,
    count(DISTINCT order_id) FILTER ({DONE}) AS orders,
    count(*) FILTER ({DONE}) AS priced, count(DISTINCT user_id) AS users, count(status) AS items,
    count(*) FILTER (status = 'Returned') AS returned, sum(sale_price) AS value"""


def market(column: str) -> str:
    return f"{FULL},\nm AS (SELECT {column}, {BUYERS} FROM v_full GROUP BY 1)"


MARGINS = f"""{PRICED},
margins AS (
  SELECT category,
    {r6(f"avg(({d('sale_price')} - {d('cost')}) / {d('sale_price')} * 100) FILTER ({DONE})")}
      AS avg_margin,
    {d(f"sum(sale_price - cost) FILTER ({DONE})")} AS total_profit,
    {d(f"sum(sale_price) FILTER ({DONE})")} / count(*) FILTER ({DONE}) AS avg_sale_price,
    {d(f"sum(cost) FILTER ({DONE})")} / count(*) FILTER ({DONE}) AS avg_cost,
    count(status) AS total_items, count(*) FILTER (status = 'Returned') AS returned_items
  FROM v_priced GROUP BY 1)"""

PRICES = rel("v_lines")


def bars(source: str, column: str, bins: int, cap: str = "") -> str:
    """Equal-width bars with empty ones kept; ``source`` is a WITH list defining ``vals``."""
    return f"""WITH {source},
kept AS (SELECT {d(column)} AS x FROM vals {cap}),
span AS (SELECT min(x) AS lo, (max(x) - min(x)) / {bins}.0::DOUBLE AS w FROM kept),
filled AS (SELECT CAST(least(floor((x - lo) / w), {bins - 1}) AS INTEGER) AS bin, count(*) AS n
  FROM kept, span GROUP BY 1)
SELECT CAST(b.bin AS INTEGER) AS bin, lo + b.bin * w AS bin_start, coalesce(n, 0) AS count
FROM (SELECT unnest(range({bins})) AS bin) b CROSS JOIN span LEFT JOIN filled USING (bin)"""


DELIVERED = f"""{FULL},
delivered AS (SELECT country, date_diff('second', shipped_at, delivered_at) AS seconds FROM v_full
  WHERE date_diff('second', shipped_at, delivered_at) > 0
    AND date_diff('second', shipped_at, delivered_at) < 60 * 86400),
top AS (SELECT country FROM delivered GROUP BY 1 ORDER BY count(*) DESC, country LIMIT 12)"""
DAYS = f"({d('seconds')} / 86400)"
AND_RETURNS = f"""{DELIVERED},
medians AS (SELECT country, {d('quantile_disc(seconds, 0.5)')} / 86400 AS median_days
  FROM delivered WHERE country IN (SELECT country FROM top) GROUP BY 1),
rates AS (SELECT country, count(status) AS total_items,
  {pct("count(*) FILTER (status = 'Returned')", 'count(status)')} AS return_rate
  FROM v_full GROUP BY 1)"""

SQL = {
    "e11_monthly_revenue": f"""WITH {MONTHLY},
g AS (SELECT month, rev, {d('rev')} / lag({d('rev')}) OVER (ORDER BY month) - 1 AS growth FROM monthly)
SELECT month, {d('rev')} AS revenue, {d('sum(rev) OVER ()')} AS total_revenue,
  arg_max(month, rev) OVER () AS peak_month, {d('max(rev) OVER ()')} AS peak_revenue,
  {r6('avg(growth) OVER () * 100')} AS avg_growth_pct FROM g""",
    "e12_monthly_orders": f"""WITH {MONTHLY},
a AS (SELECT month, orders, {d('rev')} AS revenue, {div('rev', 'orders')} AS aov FROM monthly)
SELECT *, {d('sum(orders) OVER ()')} / count(*) OVER () AS avg_monthly_orders,
  {r6('avg(aov) OVER ()')} AS avg_aov FROM a""",
    "e13_status_shares": f"""WITH {PRICES}
SELECT status, count(*) AS count, {r(pct('count(*)', 'sum(count(*)) OVER ()'))} AS pct
FROM v_lines GROUP BY 1""",
    "e14_price_profile": f"""WITH {PRICES}
SELECT {d('min(sale_price)')} AS min, {d('max(sale_price)')} AS max,
  {d('sum(sale_price)')} / count(*) AS mean,
  {', '.join(f"{d(f'quantile_disc(sale_price, {p / 100})')} AS p{p}" for p in (50, 75, 90, 95, 99))}
FROM v_lines""",
    "e14_price_histogram_p99": bars(
        f"{PRICES}, vals AS (SELECT * FROM v_lines)", "sale_price", 60,
        "WHERE sale_price <= (SELECT quantile_disc(sale_price, 0.99) FROM vals)"),
    "e14_price_histogram_full": bars(f"{PRICES}, vals AS (SELECT * FROM v_lines)", "sale_price", 80),
    "e15_age_distribution": f"""WITH {AGES},
o AS (SELECT {r6('avg(age)')} AS mean_age, {d('median(age)')} AS median_age,
  {r6('stddev_samp(age)')} AS std_age FROM v_users)
SELECT age_group, count, {pct('count', 'sum(count) OVER ()')} AS pct, mean_age, median_age, std_age
FROM bands, o""",
    "e15_age_histogram": bars(f"{rel('v_users')}, vals AS (SELECT * FROM v_users)", "age", 50),
    "e21_gender_revenue": f"""WITH {market('gender')}
SELECT gender, {d('revenue')} AS total_revenue, buyers AS unique_buyers, orders AS total_orders,
  {div('revenue', 'priced')} AS avg_item_price, {div('revenue', 'buyers')} AS revenue_per_buyer,
  {div('orders', 'buyers')} AS orders_per_buyer FROM m WHERE gender IN ('M','F')""",
    "e22_age_behaviour": f"""WITH {market('age_group')},
labels(position, age_group) AS (VALUES (1, '<18'), (2, '18–24'), (3, '25–34'), (4, '35–44'),
  (5, '45–54'), (6, '55–64'), (7, '65+'))
SELECT position, age_group, buyers AS unique_buyers, orders AS total_orders,
  {d('revenue')} AS total_revenue, {div('revenue', 'priced')} AS avg_item_price,
  {div('orders', 'buyers')} AS orders_per_buyer, {div('revenue', 'buyers')} AS revenue_per_buyer,
  {r6(f"avg({div('orders', 'buyers')}) OVER ()")} AS avg_orders_per_buyer
FROM m JOIN labels USING (age_group) WHERE buyers > 0""",
    "e23_source_conversion": f"""WITH {market('traffic_source')},
c AS (SELECT traffic_source, users AS total_users, buyers AS converted_users,
  {d('value')} AS total_revenue, {pct('buyers', 'users')} AS conversion_rate,
  {div('value', 'users')} AS revenue_per_user FROM m WHERE traffic_source IS NOT NULL)
SELECT *, {r6('median(conversion_rate) OVER ()')} AS median_conversion,
  conversion_rate >= median(conversion_rate) OVER () AS above_median,
  {d('total_users')} / max(total_users) OVER () AS size_share FROM c""",
    "e24_country_revenue": f"""WITH {market('country')}
SELECT country, {d('revenue')} AS revenue, buyers, {div('revenue', 'priced')} AS avg_item_price,
  {div('revenue', 'buyers')} AS revenue_per_buyer FROM m WHERE country IS NOT NULL
ORDER BY m.revenue DESC, country LIMIT 20""",
    "e25_country_returns": f"""WITH {market('country')},
best AS (SELECT country FROM m ORDER BY revenue DESC, country LIMIT 20),
rated AS (SELECT country, items AS total_items, returned AS returned_items,
  {pct('returned', 'items')} AS return_rate,
  CASE WHEN country IN (SELECT country FROM best) THEN {d('revenue')} END AS revenue
  FROM m WHERE items >= 100 AND country IS NOT NULL),
mid AS (SELECT {r6('median(return_rate)')} AS median_return_rate FROM rated),
worst AS (SELECT rated.*, median_return_rate FROM rated, mid
  ORDER BY return_rate DESC, country LIMIT 20)
SELECT *, CASE WHEN revenue IS NOT NULL THEN {d('total_items')}
  / max(total_items) FILTER (revenue IS NOT NULL) OVER () END AS size_share FROM worst""",
    "e51_revenue_and_quantity": f"""WITH {PRICED},
s AS (SELECT category, sum(sale_price) AS rev, count(sale_price) AS quantity
  FROM v_priced WHERE {DONE} GROUP BY 1),
k AS (SELECT *, rank() OVER (ORDER BY rev DESC) + (count(*) OVER (PARTITION BY rev) - 1) / 2.0::DOUBLE
    AS rev_rank, rank() OVER (ORDER BY quantity DESC)
    + (count(*) OVER (PARTITION BY quantity) - 1) / 2.0::DOUBLE AS qty_rank FROM s)
SELECT category, {d('rev')} AS revenue, quantity, rev_rank, qty_rank,
  abs(qty_rank - rev_rank) AS rank_diff FROM k""",
    "e52_category_margin": f"""WITH {MARGINS}
SELECT category, avg_margin, total_profit, avg_sale_price, avg_cost,
  {r6('median(avg_margin) OVER ()')} AS median_margin FROM margins""",
    "e53_category_returns": f"""WITH {MARGINS},
x AS (SELECT category, total_items, returned_items,
  {pct('returned_items', 'total_items')} AS return_rate FROM margins)
SELECT *, {r6('median(return_rate) OVER ()')} AS median_return_rate FROM x""",
    "e54_double_risk": f"""WITH {MARGINS},
x AS (SELECT category, avg_margin, total_profit, total_items,
  {pct('returned_items', 'total_items')} AS return_rate FROM margins),
y AS (SELECT *, median(return_rate) OVER () AS rm, median(avg_margin) OVER () AS mm FROM x)
SELECT category, avg_margin, total_profit, total_items, return_rate,
  CASE WHEN return_rate >= rm AND avg_margin < mm THEN 'double risk'
       WHEN return_rate >= rm THEN 'risky revenue' WHEN avg_margin < mm THEN 'low value'
       ELSE 'ideal' END AS quadrant,
  {d('total_items')} / max(total_items) OVER () AS size_share FROM y""",
    "e55_category_by_gender": f"""WITH {rel('v_priced', 'v_users')},
g AS (SELECT category, coalesce(sum(sale_price) FILTER (gender = 'F'), 0) AS f,
    coalesce(sum(sale_price) FILTER (gender = 'M'), 0) AS m
  FROM v_priced JOIN v_users USING (user_id) WHERE {DONE} GROUP BY 1)
SELECT category, {d('f')} AS revenue_f, {d('m')} AS revenue_m, {pct('f', 'f + m')} AS pct_f,
  {pct('m', 'f + m')} AS pct_m FROM g""",
    "e61_source_order_value": f"""WITH {market('traffic_source')}
SELECT traffic_source, {d('revenue')} AS total_revenue, orders AS total_orders,
  buyers AS total_users, {div('revenue', 'orders')} AS aov,
  {div('revenue', 'buyers')} AS revenue_per_user FROM m WHERE buyers > 0""",
    "e62_source_returns": f"""WITH {market('traffic_source')},
x AS (SELECT traffic_source, items AS total_items, returned,
  {pct('returned', 'items')} AS return_rate, {div('revenue', 'orders')} AS aov
  FROM m WHERE buyers > 0 AND traffic_source IS NOT NULL)
SELECT *, {r6('median(return_rate) OVER ()')} AS median_return_rate FROM x""",
    "e63_delivery_overview": f"""WITH {DELIVERED}
SELECT count(*) AS n, {r6(f'avg({DAYS})')} AS mean_days,
  {r6(f"{d('quantile_disc(seconds, 0.5)')} / 86400")} AS median_days FROM delivered""",
    "e63_delivery_by_country": f"""WITH {DELIVERED}
SELECT country, {r(f"{d('quantile_disc(seconds, 0.5)')} / 86400")} AS median_days,
  {r(f'avg({DAYS})')} AS mean_days, {r(f'stddev_samp({DAYS})')} AS std_days, count(*) AS count
FROM delivered WHERE country IN (SELECT country FROM top) GROUP BY 1""",
    "e63_delivery_boxes": f"""WITH {DELIVERED}
SELECT country, {', '.join(f"{r6(f'quantile_cont({DAYS}, {p})')} AS {n}" for n, p in
                           (('low', 0), ('q1', 0.25), ('median', 0.5), ('q3', 0.75), ('high', 1)))}
FROM delivered WHERE country IN (SELECT country FROM top) GROUP BY 1""",
    "e63_delivery_histogram": bars(
        f"{DELIVERED}, vals AS (SELECT {DAYS} AS days FROM delivered)", "days", 40),
    "e64_delivery_and_returns": f"""WITH {AND_RETURNS}
SELECT country, median_days, total_items, return_rate FROM medians JOIN rates USING (country)""",
    "e64_delivery_correlation": f"""WITH {AND_RETURNS},
f AS (SELECT corr(median_days, return_rate) AS r, regr_slope(return_rate, median_days) AS slope,
  regr_intercept(return_rate, median_days) AS intercept, count(*) AS countries
  FROM medians JOIN rates USING (country))
SELECT {r6('r')} AS r, {r6('slope')} AS slope, {r6('intercept')} AS intercept, countries,
  CASE WHEN r > 0.4 THEN 'positive' WHEN r < -0.4 THEN 'negative' ELSE 'weak' END AS verdict
FROM f""",
    "join09_stock_units": f"""WITH {rel('v_products')}
SELECT l_partkey AS product_id, o_orderdate AS created_at,
  CASE WHEN l_linestatus = 'F' THEN l_shipdate END AS sold_at, category, name,
  date_diff('second', o_orderdate, CASE WHEN l_linestatus = 'F' THEN l_shipdate END)
    / 86400.0::DOUBLE AS days_to_sell,
  CAST(l_linestatus = 'F' AS INTEGER) AS is_sold
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN v_products ON product_id = l_partkey""",
    "e14_price_sample": f"""WITH {rel('v_items')}
SELECT sale_price FROM v_items WHERE {in_share(100)} AND sale_price IS NOT NULL""",
    "e63_delivery_sample": f"""WITH {rel('v_items')}, t AS (
  SELECT date_diff('second', shipped_at, delivered_at) / 86400.0 AS days FROM v_items WHERE {in_share(50)})
SELECT {d('days')} AS days FROM t WHERE days > 0 AND days < 60""",
    "fil16_train_share": f"""WITH {rel('v_items')}
SELECT count(*) AS train_rows FROM v_items WHERE {in_share(800, "concat_ws('|', order_id, product_id, sale_price)")}""",
}
