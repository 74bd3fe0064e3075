"""The input tables as DuckDB common table expressions over the generic Parquet tables."""

from __future__ import annotations

MIN_AGE = """coalesce(CASE WHEN regexp_matches(trim({c}), '^[0-9]+ [0-9]+/[0-9]+')
      THEN CAST(regexp_extract(trim({c}), '^([0-9]+) ', 1) AS INTEGER)
         + CAST(regexp_extract(trim({c}), '^[0-9]+ ([0-9]+)/', 1) AS INTEGER)
        // nullif(CAST(regexp_extract(trim({c}), '^[0-9]+ [0-9]+/([0-9]+)', 1) AS INTEGER), 0)
      ELSE TRY_CAST(regexp_extract(trim({c}), '^[0-9]+') AS INTEGER) END, 0)"""


def min_age(column: str) -> str:
    return MIN_AGE.format(c=column)


def age_band(years: str) -> str:
    return (
        f"CASE WHEN {years} <= 5 THEN '0-5' WHEN {years} <= 8 THEN '6-8' WHEN {years} <= 12 THEN '9-12' "
        f"WHEN {years} <= 17 THEN '13-17' WHEN {years} >= 18 THEN '18+' END"
    )


VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "product": (
        (),
        """SELECT CAST(p_partkey AS VARCHAR) AS sku_id, 'SKU ' || p_name AS sku_name,
  CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE p_brand END AS product_line,
  CASE WHEN p_size % 10 = 0 THEN NULL WHEN p_size % 10 = 1 THEN '1 1/2' WHEN p_size % 10 = 2 THEN 'all ages'
       WHEN p_size < 6 THEN CAST(p_size AS VARCHAR) || ' 1/2+' WHEN p_size < 20 THEN CAST(p_size AS VARCHAR) || '+'
       ELSE ' ' || CAST(p_size AS VARCHAR) || '-99 ' END AS age_mark,
  CAST((p_retailprice - 900) * 12 AS DECIMAL(18,2)) AS rsp,
  launch AS bu_launch_date, launch + 14 AS store_launch_date
FROM (SELECT *, CASE WHEN p_partkey % 13 = 0 THEN NULL
    WHEN p_partkey % 4 = 0 THEN DATE '2000-12-20' + CAST(p_partkey % 180 AS INTEGER)
    WHEN p_partkey % 4 = 1 THEN DATE '1999-12-20' + CAST(p_partkey % 180 AS INTEGER)
    ELSE DATE '1996-01-01' + CAST(p_partkey % 900 AS INTEGER) END AS launch FROM part)""",
    ),
    "order_lines": (
        ("product",),
        """SELECT o_orderdate + (l_orderkey % 86400) * INTERVAL 1 SECOND AS order_paid_time,
  o_orderdate AS order_paid_date,
  CASE o_custkey % 4 WHEN 0 THEN 'CRM' WHEN 1 THEN 'DY' WHEN 2 THEN 'TM' ELSE 'ANON' END AS type_name,
  'ext-' || CAST(o_custkey AS VARCHAR) AS type_value,
  CAST(l_orderkey AS VARCHAR) AS parent_order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
  p.product_line, p.sku_name, p.bu_launch_date, p.store_launch_date,
  CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS sales_qty,
  l_returnflag <> 'R' AS is_effective,
  o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS is_member_order,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS order_amt,
  CASE WHEN o_orderkey % 10 = 9 THEN 'OTHER' WHEN o_orderstatus IN ('F', 'P') THEN 'STORE'
       WHEN o_orderkey % 2 = 0 THEN 'WEB_A' ELSE 'WEB_B' END AS source_channel,
  CASE WHEN l_linenumber = 7 THEN 3 ELSE 1 END AS sales_type,
  CASE WHEN l_linenumber = 6 THEN 'refund' ELSE 'normal' END AS order_type,
  CASE WHEN n_nationkey % 7 = 0 THEN NULL
       ELSE 'Tier ' || CAST(1 + n_nationkey % 6 AS VARCHAR) END AS city_tier,
  n_name AS city, CAST(o_custkey AS VARCHAR) AS member_ref
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN product p ON CAST(l_partkey AS VARCHAR) = p.sku_id
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "store_sales": (
        ("order_lines",),
        """SELECT parent_order_id, sku_id, sku_name, product_line,
  strftime(order_paid_date, '%Y-%m-%d') AS date_id, CAST(order_paid_date AS DATE) AS sale_date,
  sales_qty, order_amt, bu_launch_date, store_launch_date
FROM order_lines WHERE source_channel = 'STORE' AND sales_type <> 3""",
    ),
    "member_bridge": (
        (),
        """SELECT 100000 + c_custkey AS id, CAST(c_custkey AS VARCHAR) AS member_id
FROM customer WHERE c_custkey % 10 <> 0""",
    ),
    "member": (
        (),
        """SELECT CAST(100000 + c_custkey AS VARCHAR) AS member_detail_id,
  DATE '1999-07-01' + CAST(c_custkey * 7 % 731 AS INTEGER) AS join_date,
  CASE WHEN c_custkey % 3 <> 0 THEN 'STORE-APP' ELSE 'WEB' END AS reg_channel,
  c_mktsegment AS tier_code,
  CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE c_custkey % 4 END AS gender,
  CASE WHEN c_custkey % 11 = 0 THEN NULL
       ELSE DATE '1940-01-01' + CAST(c_custkey * 97 % 21900 AS INTEGER) END AS birthday,
  CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS has_kid,
  c_custkey % 2 = 0 AND c_custkey % 11 <> 0 AS has_beneficiary_birthday
FROM customer WHERE c_custkey % 10 <> 0""",
    ),
    "birthday_history": (
        (),
        """SELECT CAST(100000 + c_custkey AS VARCHAR) AS member_detail_id,
  CASE WHEN c_custkey % 3 = 0 THEN 1980 + c_custkey % 21 ELSE 1970 END AS birthday_year,
  CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS person_type
FROM customer WHERE c_custkey % 10 <> 0 AND c_custkey % 3 <> 2""",
    ),
    "store": (
        (),
        """SELECT DISTINCT n_name AS city FROM supplier JOIN nation ON s_nationkey = n_nationkey
WHERE n_nationkey % 8 <> 5""",
    ),
    "city_type": (
        (),
        """SELECT n_name AS city, CASE n_regionkey WHEN 0 THEN '1_mature' WHEN 1 THEN '2_core'
  ELSE '3_uprising' END AS city_type FROM nation WHERE n_regionkey IN (0, 1, 2)""",
    ),
    "sku_plan": (
        (),
        """SELECT CAST(p_partkey AS VARCHAR) AS sku_id, 2001 AS plan_year, m AS plan_month,
  1 + (p_partkey * m) % 20 AS plan_qty,
  CASE WHEN p_partkey % 3 = 0 THEN 'WEB' ELSE 'STORE,WEB' END AS review_channel,
  CASE WHEN p_partkey % 10 = 1 THEN 'DP02' ELSE 'DP03' END AS plan_version
FROM part CROSS JOIN (SELECT unnest(range(1, 13)) AS m)""",
    ),
    "line_orders": (
        ("store_sales",),
        """SELECT DISTINCT parent_order_id, product_line AS item FROM store_sales
WHERE product_line IS NOT NULL""",
    ),
    "line_age_orders": (
        ("store_sales", "product"),
        f"""SELECT DISTINCT s.parent_order_id, p.product_line || ' ' || {age_band(min_age('age_mark'))} AS item
FROM store_sales s JOIN product p ON s.sku_id = p.sku_id
WHERE p.product_line IS NOT NULL AND regexp_matches(trim(age_mark), '^[0-9]+')""",
    ),
}


def _similarity(orders: str, left: str, right: str) -> str:
    return f"""SELECT a AS {left}, b AS {right}, score AS cosine_similarity,
  CASE d WHEN 1 THEN row_number() OVER (PARTITION BY d, a ORDER BY score DESC, b)
    ELSE row_number() OVER (PARTITION BY d, a ORDER BY score, b DESC) END AS rank,
  CASE d WHEN 1 THEN DATE '2001-06-30' ELSE DATE '2001-06-01' END AS update_date
FROM (SELECT x.item AS a, y.item AS b,
    count(*) / sqrt(CAST(any_value(nx.n) * any_value(ny.n) AS DOUBLE)) AS score
  FROM {orders} x JOIN {orders} y ON x.parent_order_id = y.parent_order_id AND x.item <> y.item
  JOIN (SELECT item, count(*) AS n FROM {orders} GROUP BY item) nx ON nx.item = x.item
  JOIN (SELECT item, count(*) AS n FROM {orders} GROUP BY item) ny ON ny.item = y.item
  GROUP BY x.item, y.item) CROSS JOIN (SELECT unnest([1, 2]) AS d)"""


VIEWS["line_similarity"] = (("line_orders",), _similarity("line_orders", "line1", "line2"))
VIEWS["line_age_similarity"] = (
    ("line_age_orders",),
    _similarity("line_age_orders", "line_age1", "line_age2"),
)


def with_views(names: tuple[str, ...], ctes: list[tuple[str, str]], query: str) -> str:
    """One statement: the needed views in dependency order, further CTEs, the query."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dependency in VIEWS[name][0]:
            visit(dependency)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    parts = [(n, VIEWS[n][1]) for n in ordered] + ctes
    return "WITH " + ",\n".join(f"{n} AS (\n{sql}\n)" for n, sql in parts) + "\n" + query
