"""Oracle SQL for exact metrics, feature scores and vector slots."""

from oracle.base import d, rel
from oracle.explore import in_share
from oracle.features import FEATURES, MASTER
from oracle.reports import rfm
from oracle.streams import EVENTS

PRICES = ["sale_price", "retail_price", "cost", "age"]
RATED = f"""{MASTER},
t AS (SELECT *, CAST(order_status = 'Returned' AS INTEGER) AS y, retail_price - cost AS price_gap,
  CASE WHEN retail_price > 0 THEN (retail_price - sale_price) / retail_price ELSE 0.0::DOUBLE END AS discount_rate
  FROM master WHERE retail_price IS NOT NULL AND department IS NOT NULL),
rated AS (SELECT *, round(discount_rate, 4) AS rate FROM t)"""
NUMBERS = [*PRICES, "discount_rate", "price_gap"]
LABELS = ["gender", "category", "traffic_source"]
ALL_LABELS = ["gender", "category", "department", "traffic_source"]
MORE = ["is_discounted", "profit_margin"]
LABEL_ROWS = " UNION ALL ".join(f"SELECT '{c}' AS c, {c} AS label, y FROM rated WHERE {c} IS NOT NULL" for c in LABELS)
NUMBER_ROWS = " UNION ALL ".join(f"SELECT '{c}' AS feature, y, CAST({c} AS DECIMAL(18,6)) AS v FROM rated" for c in NUMBERS)


def slots(table: str, labels: list[str], numbers: list[str]) -> str:
    """Each slot's values that are not zero, over their deviation in the whole table."""
    plain = " UNION ALL ".join(f"""SELECT '{c}' AS slot, count(*) FILTER ({c} <> 0) AS rows,
  min({c}) FILTER ({c} <> 0) / stddev_samp({c}) AS low, max({c}) FILTER ({c} <> 0) / stddev_samp({c}) AS high FROM {table}""" for c in numbers)
    hot = " UNION ALL ".join(f"""SELECT '{c}_ohe_' || {c} AS slot, count(*) AS rows,
  1 / sqrt((count(*) - count(*) * count(*) / {d('any_value(n)')}) / (any_value(n) - 1)) AS low, low AS high FROM {table}, size GROUP BY {c}""" for c in labels)
    return f"""size AS (SELECT count(*) AS n FROM {table}), slots AS ({plain} UNION ALL {hot})
SELECT slot, rows, round(low, 6) AS smallest, round(high, 6) AS largest FROM slots WHERE rows > 0"""


SQL = {
    "ml09_roc_area": f"""WITH {RATED}, p AS (SELECT rate, count(*) AS n FROM rated WHERE y = 1 GROUP BY 1),
q AS (SELECT rate, count(*) AS n FROM rated WHERE y = 0 GROUP BY 1),
c AS (SELECT count(*) FILTER (y = 1) AS positives, count(*) FILTER (y = 0) AS negatives FROM rated),
m AS (SELECT {d('sum(p.n * q.n * CASE WHEN p.rate > q.rate THEN 2 WHEN p.rate = q.rate THEN 1 ELSE 0 END)')} AS pairs FROM p, q)
SELECT positives, negatives, pairs / (2.0::DOUBLE * positives * negatives) AS area FROM c, m""",
    "ml10_roc_points": f"""WITH {RATED}, x AS (SELECT DISTINCT rate FROM rated)
SELECT x.rate AS threshold, {d('count(*) FILTER (y = 0 AND r.rate >= x.rate)')} / count(*) FILTER (y = 0) AS fpr,
  {d('count(*) FILTER (y = 1 AND r.rate >= x.rate)')} / count(*) FILTER (y = 1) AS tpr FROM x, rated r GROUP BY 1""",
    "ml06_feature_scores": f"""WITH {RATED}, z AS ({LABEL_ROWS}), f AS ({NUMBER_ROWS}),
n AS (SELECT y, {d('count(*)')} AS n FROM rated GROUP BY 1),
s AS (SELECT feature, y, {d('sum(v)')} AS s, {d('sum(CAST(v AS DECIMAL(24,6)) * CAST(v AS DECIMAL(24,6)))')} AS q FROM f GROUP BY 1, 2
  UNION ALL SELECT c || '=' || label, y, {d('count(*)')}, {d('count(*)')} FROM z GROUP BY 1, 2),
g AS (SELECT feature, sum(s * s / n) AS means, sum(s) AS s, sum(q) AS q FROM s JOIN n USING (y) GROUP BY 1),
w AS (SELECT sum(n) AS n, count(*) AS k FROM n),
v AS (SELECT feature, ((means - s * s / n) / (k - 1)) / nullif((q - means) / (n - k), 0) AS f FROM g, w)
SELECT feature, round(f, 6) AS f_value, row_number() OVER (ORDER BY f DESC NULLS LAST, feature) <= 15 AS chosen FROM v""",
    "ml13_silhouette": f"""WITH {rfm()}, p AS (SELECT user_id, rfm_segment AS c, {d('recency_days')} AS x, {d('frequency')} AS y, monetary AS z FROM q7),
n AS (SELECT c, count(*) AS n FROM p GROUP BY 1),
m AS (SELECT a.user_id, a.c, b.c AS other, sum((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) AS far FROM p a, p b GROUP BY 1, 2, 3),
k AS (SELECT m.user_id, m.c, max(CASE WHEN m.c = other THEN far / (n - 1) END) AS own, min(CASE WHEN m.c <> other THEN far / n END) AS near,
  max(CASE WHEN m.c = other THEN n END) AS size FROM m JOIN n ON n.c = other GROUP BY 1, 2)
SELECT count(*) AS points, CAST((SELECT count(*) FROM n) AS INTEGER) AS clusters,
  round(avg(CASE WHEN size = 1 THEN 0 ELSE (near - own) / greatest(near, own) END), 6) AS silhouette FROM k""",
    "ml15_rmse": f"""WITH {RATED}, i AS (SELECT category, CAST(sale_price AS DECIMAL(18,6)) AS price FROM rated),
c AS (SELECT category, CAST(round({d('sum(price)')} / count(price), 6) AS DECIMAL(18,6)) AS mean FROM i GROUP BY 1),
g AS (SELECT mean - price AS gap FROM i JOIN c USING (category))
SELECT count(*) AS n, {d('sum(gap)')} / count(*) AS mean_error, sqrt({d('sum(CAST(gap AS DECIMAL(24,6)) * CAST(gap AS DECIMAL(24,6)))')} / count(*)) AS rmse FROM g""",
    "ml02_label_order": f"""WITH {RATED}, z AS ({" UNION ALL ".join(f"SELECT '{c}' AS c, {c} AS label FROM rated WHERE {c} IS NOT NULL" for c in ALL_LABELS)}),
n AS (SELECT c AS "column", label, count(*) AS count FROM z GROUP BY 1, 2)
SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY count DESC, label) - 1 AS INTEGER) AS position FROM n""",
    "p2_vector_slots": f"""WITH {FEATURES}, known AS (SELECT * FROM features WHERE retail_price IS NOT NULL AND department IS NOT NULL),
{slots('known', ALL_LABELS, [*NUMBERS, *MORE])}""",
    "p4_vector_slots": f"""WITH {FEATURES}, known AS (SELECT * FROM features WHERE retail_price IS NOT NULL AND sale_price > 0),
{slots('known', LABELS, [*NUMBERS[1:4], 'discount_rate', 'price_gap', *MORE])}""",
    "agg16_distinct_within_bound": f"""WITH {rel('v_items')}
SELECT status, count(DISTINCT user_id) AS exact, true AS within_bound FROM v_items GROUP BY 1""",
    "r2b_sketches_within_bound": f"""WITH {EVENTS}
SELECT traffic_source, count(DISTINCT user_id) AS exact, true AS within_bound FROM e GROUP BY 1""",
    "fil15_sample_members": f"""WITH {rel('v_users')}
SELECT user_id, country FROM v_users WHERE {in_share(200, 'CAST(user_id AS VARCHAR)')}""",
}
