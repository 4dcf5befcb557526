"""Shared parts of the oracle SQL: the mapped relations, and rounding."""

RELATIONS = {
    "v_lines": """
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS inventory_item_id, l_linenumber AS item_no,
    CASE WHEN l_returnflag = 'R' THEN 'Returned'
         WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Complete'
         WHEN l_returnflag = 'A' THEN 'Shipped'
         WHEN l_linestatus = 'F' THEN 'Processing' ELSE 'Cancelled' END AS status,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
         AS DECIMAL(18,4)) AS sale_price,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS retail_price,
    CAST(l_quantity AS DECIMAL(18,0)) AS quantity, l_shipdate
  FROM lineitem""",
    "v_items": """
  SELECT v.*, o_custkey AS user_id, o_orderdate AS created_at,
    CASE WHEN status IN ('Shipped','Complete','Returned') THEN o_orderdate END AS shipped_at,
    CASE WHEN status IN ('Complete','Returned') THEN l_shipdate END AS delivered_at,
    CASE WHEN status = 'Returned' THEN l_shipdate END AS returned_at
  FROM v_lines v JOIN orders ON order_id = o_orderkey""",
    "v_orders": """
  SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS created_at,
    CASE o_orderstatus WHEN 'F' THEN 'Complete' WHEN 'P' THEN 'Returned'
                       ELSE 'Processing' END AS status
  FROM orders""",
    "v_users": """
  SELECT c_custkey AS user_id, c_name AS full_name, n_name AS country,
    c_mktsegment AS traffic_source,
    CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    CAST(12 + (c_custkey * 7) % 78 AS INTEGER) AS age,
    (SELECT min(o_orderdate) FROM orders WHERE o_custkey = c_custkey) AS created_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "v_products": """
  SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_brand AS brand,
    CASE WHEN p_size <= 25 THEN 'Women' ELSE 'Men' END AS department,
    CAST(p_retailprice AS DECIMAL(18,2)) AS unit_cost
  FROM part""",
    "v_priced": """
  SELECT i.*, category, brand, department, unit_cost * quantity AS cost
  FROM v_items i LEFT JOIN v_products USING (product_id)""",
    "v_full": """
  SELECT i.*, u.gender, u.age, u.country, u.traffic_source,
    CASE WHEN age < 18 THEN '<18' WHEN age < 25 THEN '18–24' WHEN age < 35 THEN '25–34'
         WHEN age < 45 THEN '35–44' WHEN age < 55 THEN '45–54' WHEN age < 65 THEN '55–64'
         WHEN age < 200 THEN '65+' ELSE 'Unknown' END AS age_group
  FROM v_items i LEFT JOIN v_users u USING (user_id)""",
}
NEEDS = {"v_items": ["v_lines"], "v_priced": ["v_items", "v_products"],
         "v_full": ["v_items", "v_users"]}
RANK = list(RELATIONS)


def rel(*names: str) -> str:
    """``WITH`` items for the named relations and what they build on (no trailing comma)."""
    wanted, todo = set(), list(names)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += NEEDS.get(name, [])
    return ",\n".join(f"{n} AS ({RELATIONS[n]})" for n in RANK if n in wanted)


def r(expression: str, digits: int = 2) -> str:
    """Half-up rounding on the decimal digits."""
    return f"CAST(round(CAST({expression} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


def d(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    return f"({d(part)} / nullif({d(whole)}, 0) * 100)"


def avg8(expression: str, over: str = "") -> str:
    """Mean of rounded figures, added up as decimals."""
    return (f"({d(f'sum(CAST({expression} AS DECIMAL(28,8))) {over}')}"
            f" / count({expression}) {over})")
