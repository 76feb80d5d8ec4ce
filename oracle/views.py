"""The sample views once more, as SQL text for an independent engine."""

PRODUCTS = """
products AS (
  SELECT lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS product_id,
         p_name || ' #' || p_partkey AS product_name,
         p_type AS category,
         CAST(round(p_retailprice * 100) AS INTEGER) AS unit_price_cents,
         CAST(p_partkey % (SELECT count(*) FROM supplier) AS INTEGER) AS supplier_id
  FROM part
)"""

STORES = """
stores AS (
  SELECT 'ST' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS store_id,
         n_name AS store_name, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state,
         r_name AS region, 'retail' AS store_type
  FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT 'FC-EAST', 'Fulfillment East', NULL, NULL, 'FULFILLMENT', 'fulfillment_center'
)"""

# `tx` has the columns of `transactions` plus whole cents and the raw key parts.
TX = """
numbered AS (
  SELECT *, row_number() OVER (
              PARTITION BY l_orderkey
              ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn,
         CAST(l_orderkey AS VARCHAR) AS order_text
  FROM lineitem
),
keyed AS (
  SELECT n.*, o.o_custkey, o.o_orderdate, o.o_orderkey % 10 AS kind,
         CASE WHEN o.o_orderkey % 10 < 4 THEN 'ecommerce' ELSE 'pos' END AS channel,
         CASE WHEN o.o_orderkey % 10 < 3 THEN 'FC-EAST'
              ELSE 'ST' || lpad(CAST(c.c_nationkey AS VARCHAR), 3, '0') END AS store_id
  FROM numbered n
  JOIN orders o ON n.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
),
timed AS (
  SELECT *, o_orderdate + to_seconds(CAST((l_orderkey * 7919
              + CASE WHEN channel = 'pos' THEN rn ELSE 0 END * 131) % 86400 AS INTEGER)) AS instant
  FROM keyed
),
tx AS (
  SELECT CASE WHEN t.channel = 'pos' THEN 'POS-' || order_text || '-' || rn
              ELSE 'ECOM-WM-' || order_text || '-' || (rn - 1) END AS transaction_id,
         CASE WHEN t.channel = 'pos' THEN 'POS-' || order_text || '-' || rn
              ELSE 'WM-' || order_text END AS order_id,
         p.product_id, p.product_name, p.category,
         CAST(t.o_orderdate AS DATE) AS sale_date,
         CASE WHEN t.kind IN (4, 5) THEN date_trunc('minute', t.instant) ELSE t.instant END
           AS sale_timestamp,
         CAST(t.l_quantity AS INTEGER) AS quantity,
         p.unit_price_cents AS unit_cents,
         CAST(round(t.l_extendedprice * 100) AS BIGINT) // CAST(t.l_quantity AS BIGINT)
           AS sale_cents,
         t.store_id, s.region,
         CASE WHEN t.channel = 'ecommerce' THEN 'c_' || t.o_custkey END AS customer_id,
         t.channel, t.l_orderkey, t.rn, t.kind
  FROM timed t
  JOIN products p ON p.product_id = lpad(CAST(t.l_partkey AS VARCHAR), 12, '0')
  JOIN stores s ON s.store_id = t.store_id
)"""

FORECASTS = """
forecasts AS (
  SELECT product_id, store_id,
         CAST(date_trunc('week', sale_date) AS DATE) + 364 AS week_start,
         sum(quantity) AS forecasted_units,
         sum(sale_cents * quantity) AS plan_cents
  FROM tx GROUP BY ALL
)"""

RAW_POS = """
raw_pos AS (
  SELECT transaction_id, store_id, product_id, l_orderkey, rn, resent,
         CASE WHEN kind IN (4, 5) THEN strftime(sale_timestamp, '%m/%d/%Y %H:%M')
              ELSE strftime(sale_timestamp, '%Y-%m-%d %H:%M:%S') END AS timestamp_raw,
         CASE WHEN (l_orderkey + rn) % 33 = 0
              THEN regexp_replace(upper(product_name), '[AEIOU]', '', 'g')
              ELSE product_id END AS upc_or_name,
         quantity, CAST(sale_cents AS INTEGER) AS price_charged_cents
  FROM tx
  CROSS JOIN (SELECT unnest([0, 1]) AS resent) r
  WHERE channel = 'pos' AND (resent = 0 OR l_orderkey % 20 = 7)
)"""


def with_views(query: str, *extra: str) -> str:
    """`query` over products, stores, tx and the views named in `extra`."""
    return "WITH " + ",".join([PRODUCTS, STORES, TX, *extra]) + "\n" + query
