"""The registered queries as SQL for an independent engine."""

from __future__ import annotations

from oracle.views import FORECASTS, RAW_POS, STORES, with_views

START, END = "1997-01-01", "1997-03-31"
PRIOR_START, PRIOR_END = "1996-10-03", "1996-12-31"
WEEK_START, WEEK_END = "1997-01-06", "1997-01-12"

IN_WINDOW = f"sale_date BETWEEN DATE '{START}' AND DATE '{END}'"
WINDOW = f"""
w AS (SELECT *, sale_cents * quantity AS rev, unit_cents * quantity AS cost
      FROM tx WHERE {IN_WINDOW})"""

REVENUE = "CAST(sum(rev) AS DOUBLE) / 100"
COST = "CAST(sum(cost) AS DOUBLE) / 100"
MARGIN = "CAST(sum(rev) - sum(cost) AS DOUBLE) / 100"
UNITS = "CAST(sum(quantity) AS BIGINT)"


def rounded(value: str, places: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {places}) AS DOUBLE)"


def percent(part: str, whole: str, places: int) -> str:
    quotient = f"CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0) * 100"
    return rounded(quotient, places)


MARGIN_PCT = percent("sum(rev) - sum(cost)", "sum(rev)", 1)
MEAN_MARGIN = rounded("CAST(sum(sale_cents - unit_cents) AS DOUBLE) / count(*) / 100", 2)
BUCKETS = {
    "day": "sale_date",
    "week": "CAST(date_trunc('week', sale_date) AS DATE)",
    "month": "CAST(date_trunc('month', sale_date) AS DATE)",
}


def _window(query: str, *extra: str) -> str:
    return with_views(query, WINDOW, *extra)


def _over_time(granularity: str, dimension: str) -> str:
    return _window(f"""
SELECT strftime({BUCKETS[granularity]}, '%Y-%m-%d') AS bucket, {dimension}, {REVENUE} AS revenue
FROM w WHERE {dimension} IS NOT NULL GROUP BY 1, 2""")


def _by_dimension(dimension: str) -> str:
    return _window(f"""
SELECT {dimension}, {REVENUE} AS revenue, {UNITS} AS units_sold,
       count(DISTINCT order_id) AS orders
FROM w WHERE {dimension} IS NOT NULL GROUP BY 1""")


def _top(n: int, category: str | None = None) -> str:
    where = f"WHERE category = '{category}'" if category else ""
    return f"""
SELECT product_id, product_name, category, {REVENUE} AS revenue, {UNITS} AS units_sold
FROM w {where} GROUP BY 1, 2, 3 ORDER BY revenue DESC, product_id LIMIT {n}"""


GROWTH = f"""
SELECT t.*, coalesce(CAST(p.cents AS DOUBLE) / 100, 0.0) AS prior_revenue,
       {rounded("(t.revenue - CAST(p.cents AS DOUBLE) / 100) / nullif(CAST(p.cents AS DOUBLE) / 100, 0) * 100", 1)}
         AS growth_pct
FROM ({{top}}) t
LEFT JOIN (SELECT product_id, sum(sale_cents * quantity) AS cents FROM tx
           WHERE sale_date BETWEEN DATE '{PRIOR_START}' AND DATE '{PRIOR_END}'
           GROUP BY 1) p USING (product_id)"""


def _forecast(dimension: str) -> str:
    figures = f"""
       CAST(plan AS DOUBLE) / 100 AS forecasted_revenue,
       CAST(plan_units AS BIGINT) AS forecasted_units,
       CAST(sold AS DOUBLE) / 100 AS actual_revenue,
       CAST(sold_units AS BIGINT) AS actual_units,
       {percent("sold - plan", "plan", 1)} AS revenue_delta_pct"""
    planned = f"week_start BETWEEN DATE '{START}' AND DATE '{END}'"
    if dimension == "overall":
        return _window(f"""
SELECT {figures} FROM
  (SELECT count(*) AS weeks, coalesce(sum(plan_cents), 0) AS plan,
          coalesce(sum(forecasted_units), 0) AS plan_units FROM forecasts WHERE {planned}),
  (SELECT coalesce(sum(rev), 0) AS sold, coalesce(sum(quantity), 0) AS sold_units FROM w)
WHERE weeks > 0""", FORECASTS)
    return _window(f"""
SELECT {dimension}, {figures} FROM (
  SELECT coalesce(f.{dimension}, a.{dimension}) AS {dimension},
         coalesce(plan, 0) AS plan, coalesce(plan_units, 0) AS plan_units,
         coalesce(sold, 0) AS sold, coalesce(sold_units, 0) AS sold_units
  FROM (SELECT {dimension}, sum(plan_cents) AS plan, sum(forecasted_units) AS plan_units
        FROM (SELECT f.*, p.category, s.region FROM forecasts f
              LEFT JOIN products p USING (product_id) LEFT JOIN stores s USING (store_id))
        WHERE {planned} AND {dimension} IS NOT NULL GROUP BY 1) f
  FULL JOIN (SELECT {dimension}, sum(rev) AS sold, sum(quantity) AS sold_units
             FROM w WHERE {dimension} IS NOT NULL GROUP BY 1) a
    ON f.{dimension} = a.{dimension})
WHERE EXISTS (SELECT 1 FROM forecasts WHERE {planned})""", FORECASTS)


PAIRS = _window("""
SELECT coalesce(pa.product_name, a) AS product_a, coalesce(pb.product_name, b) AS product_b,
       co_occurrences
FROM (SELECT x.product_id AS a, y.product_id AS b, count(*) AS co_occurrences,
             min(x.order_id) AS first_order
      FROM (SELECT DISTINCT order_id, product_id FROM w) x
      JOIN (SELECT DISTINCT order_id, product_id FROM w) y
        ON x.order_id = y.order_id AND x.product_id < y.product_id
      GROUP BY 1, 2 ORDER BY co_occurrences DESC, first_order, a, b LIMIT 20) t
LEFT JOIN products pa ON pa.product_id = a
LEFT JOIN products pb ON pb.product_id = b""")

MIX = f"""
SELECT channel, category, CAST(cents AS DOUBLE) / 100 AS revenue,
       {percent("cents", "sum(cents) OVER (PARTITION BY channel)", 1)} AS share_pct
FROM (SELECT channel, category, sum(rev) AS cents FROM w GROUP BY 1, 2)"""

CATEGORIES = f"""
SELECT category, {REVENUE} AS revenue, {COST} AS wholesale_cost, {UNITS} AS units_sold,
       count(DISTINCT product_id) AS product_count, {MARGIN} AS total_margin,
       {MARGIN_PCT} AS margin_pct
FROM w GROUP BY 1"""

SCATTER = f"""
SELECT product_id, product_name, category, {UNITS} AS units_sold,
       {MEAN_MARGIN} AS margin_per_unit, {REVENUE} AS revenue
FROM w GROUP BY 1, 2, 3"""

MARGINS = f"""
SELECT product_id, product_name, category, {MEAN_MARGIN} AS margin_per_unit,
       {UNITS} AS units_sold, {REVENUE} AS revenue, {MARGIN} AS total_margin,
       {MARGIN_PCT} AS margin_pct
FROM w GROUP BY 1, 2, 3 ORDER BY margin_per_unit DESC, product_id LIMIT 20"""

VELOCITY = f"""
SELECT strftime(day, '%Y-%m-%d') AS sale_date, coalesce(units, 0) AS units_sold,
       coalesce(revenue, 0.0) AS revenue
FROM (SELECT CAST(unnest(generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 DAY)) AS DATE)
             AS day)
LEFT JOIN (SELECT sale_date, {UNITS} AS units, {REVENUE} AS revenue FROM w GROUP BY 1)
  ON day = sale_date"""

KPI = _window(f"""
SELECT CAST(coalesce(sum(rev), 0) AS DOUBLE) / 100 AS total_revenue,
       CAST(coalesce(sum(quantity), 0) AS BIGINT) AS total_units_sold,
       coalesce({rounded("CAST(sum(rev) AS DOUBLE) / 100 / nullif(count(DISTINCT order_id), 0)", 2)}, 0)
         AS average_order_value,
       CAST(coalesce(sum(rev) FILTER (rescued), 0) AS DOUBLE) / 100 AS ai_rescued_revenue,
       coalesce({percent("coalesce(sum(rev) FILTER (rescued), 0)", "sum(rev)", 2)}, 0)
         AS ai_rescued_revenue_pct
FROM (SELECT *, transaction_id IN (SELECT transaction_id FROM raw_pos
                WHERE NOT regexp_full_match(upc_or_name, '[0-9]+')) AS rescued FROM w)""", RAW_POS)

# One word's trigrams between word marks, over vowel-less names.
BARE = """trim(regexp_replace(regexp_replace(
  trim(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')),
  '[aeiou]', '', 'g'), ' +', ' ', 'g'))"""
GRAMS = """list_distinct(flatten(list_transform(
  list_filter(string_split({0}, ' '), lambda w: len(w) > 0),
  lambda w: list_transform(range(1, len(w) + 1),
                           lambda i: substr('^' || w || '$', CAST(i AS INTEGER), 3)))))"""


PLAIN = "trim(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"


def _brute_force_matches(identifiers: str) -> str:
    """Every string against every product name, no blocking."""
    return f"""
ids AS (SELECT identifier, bare, {GRAMS.format("bare")} AS grams,
               {GRAMS.format("split_part(bare, ' ', 1)")} AS first_grams
        FROM (SELECT identifier, {BARE.format("identifier")} AS bare FROM ({identifiers}))),
names AS (SELECT name_key, min(product_id) AS product_id, count(*) AS n,
                 {GRAMS.format("name_key")} AS name_grams,
                 {GRAMS.format("split_part(name_key, ' ', 1)")} AS name_first
          FROM (SELECT {BARE.format("product_name")} AS name_key, product_id FROM products)
          GROUP BY name_key),
shared AS (SELECT identifier, name_key, count(*) AS shared
           FROM (SELECT identifier, unnest(grams) AS gram FROM ids)
           JOIN (SELECT name_key, unnest(name_grams) AS gram FROM names) USING (gram)
           GROUP BY ALL),
scored AS (SELECT identifier, product_id, n, name_key, name_grams, name_first, grams, first_grams,
                  shared / (len(grams) + 0.2::DOUBLE * (len(name_grams) - shared)) AS score
           FROM shared JOIN ids USING (identifier) JOIN names USING (name_key)),
ranked AS (SELECT *, row_number() OVER best AS place, lead(score) OVER best AS second
           FROM scored WINDOW best AS (PARTITION BY identifier ORDER BY score DESC, name_key)),
matched AS (SELECT identifier, product_id, score FROM ranked
            WHERE place = 1 AND n = 1 AND score >= 0.5
              AND (second IS NULL OR score - second >= 0.1 - 1e-9)
              AND (list_has_any(name_first, grams) OR NOT list_has_any(first_grams, name_grams)))"""


# Every product name with one of five mistakes.
MISTYPED = """
mistyped AS (
  SELECT p_partkey, upper(CASE p_partkey % 5
      WHEN 0 THEN 'z' || substr(name, 2)
      WHEN 1 THEN regexp_replace(name, ' [a-z]+ ', ' ', 'g')
      WHEN 2 THEN substr(name, 1, 2) || substr(name, 4, 1) || substr(name, 3, 1) || substr(name, 5)
      WHEN 3 THEN regexp_replace(name, '([a-z]{3})[a-z]*', '\\1', 'g')
      ELSE substr(name, 1, 3) || substr(name, 3) END) AS identifier
  FROM (SELECT p_partkey, p_name || ' #' || p_partkey AS name FROM part)
)"""
REGISTER_STRINGS = f"""
strings AS (
  SELECT DISTINCT identifier FROM (
    SELECT CASE p_partkey % 7 WHEN 0 THEN upper(replace(product_name, ' ', '-'))
        WHEN 1 THEN regexp_replace(upper(product_name), '[AEIOU]', '', 'g')
        WHEN 5 THEN 'Nr. ' || p_partkey || ' of old'
        WHEN 6 THEN lpad(CAST(p_partkey AS VARCHAR), 13, '9') ELSE m.identifier END AS identifier
    FROM mistyped m JOIN products ON product_id = lpad(CAST(p_partkey AS VARCHAR), 12, '0'))
),
by_name AS (SELECT {PLAIN.format("product_name")} AS plain, min(product_id) AS name_id
            FROM products GROUP BY 1 HAVING count(*) = 1 AND plain <> ''),
by_skeleton AS (SELECT {BARE.format("product_name")} AS bare, min(product_id) AS skeleton_id
                FROM products GROUP BY 1 HAVING count(*) = 1 AND bare <> ''),
ruled AS (
  SELECT s.identifier, a.product_id AS alias_id,
         CASE WHEN NOT regexp_full_match(s.identifier, '[0-9]+') THEN name_id END AS name_id,
         CASE WHEN NOT regexp_full_match(s.identifier, '[0-9]+') THEN skeleton_id END
           AS skeleton_id
  FROM strings s
  LEFT JOIN (SELECT 'Nr. ' || p_partkey || ' of old' AS identifier,
                    lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS product_id
             FROM part WHERE p_partkey % 7 = 5) a ON a.identifier = s.identifier
  LEFT JOIN by_name ON plain = {PLAIN.format("s.identifier")}
  LEFT JOIN by_skeleton ON bare = {BARE.format("s.identifier")}
)"""


DIRTY = "SELECT DISTINCT upc_or_name AS identifier FROM raw_pos WHERE NOT regexp_full_match(upc_or_name, '[0-9]+')"

FAULT = {
    "null": "l_orderkey % 101 = 0",
    "copy": "l_orderkey % 103 = 0",
    "channel": "l_orderkey % 107 = 0",
    "product": "l_orderkey % 109 = 0",
    "time": "l_orderkey % 113 = 0",
}

_PRICES = """CAST(unit_cents AS DOUBLE) / 100 AS unit_price,
       CAST(sale_cents AS DOUBLE) / 100 AS sale_price"""

CLEAN = f"""
SELECT transaction_id, order_id, product_id, product_name, category,
       strftime(sale_date, '%Y-%m-%d') AS sale_date,
       strftime(sale_timestamp, '%Y-%m-%d %H:%M:%S') AS sale_timestamp,
       quantity, {_PRICES}, store_id, region, customer_id, channel
FROM tx"""

ORDER_COLUMNS = """order_id, sale_timestamp_raw AS placed_at, customer_id,
       CASE WHEN store_id IS NULL THEN 'delivery' ELSE 'pickup' END AS fulfillment, store_id"""

# Sale lines of both feeds as they come in, copies included.
FEED = """
feed AS (
  SELECT transaction_id, transaction_id AS order_id, upc_or_name AS product_identifier,
         quantity, price_charged_cents AS sale_price_cents,
         timestamp_raw AS sale_timestamp_raw, store_id, CAST(NULL AS VARCHAR) AS customer_id,
         'pos' AS channel, resent
  FROM raw_pos
  UNION ALL
  SELECT transaction_id, order_id, product_id, quantity, CAST(sale_cents AS INTEGER),
         strftime(sale_timestamp, '%Y-%m-%dT%H:%M:%SZ'),
         CASE WHEN store_id <> 'FC-EAST' THEN store_id END, customer_id, 'ecommerce', 0
  FROM tx WHERE channel = 'ecommerce'
)"""
FEED_COLUMNS = """transaction_id, order_id, product_identifier, quantity, sale_price_cents,
  sale_timestamp_raw, store_id, customer_id, channel"""


def _raw(query: str, *extra: str) -> str:
    return with_views(query, RAW_POS, FEED, *extra)


SUMMARY = _raw(f"""
, c AS (SELECT
    (SELECT count(*) FROM raw_pos) AS raw_pos_rows,
    (SELECT count(DISTINCT order_id) FROM tx WHERE channel = 'ecommerce') AS raw_orders,
    (SELECT count(*) FROM tx WHERE channel = 'ecommerce') AS exploded_lines,
    (SELECT count(*) FROM feed) - (SELECT count(*) FROM feed WHERE resent = 0) AS duplicates_removed,
    (SELECT count(*) FROM feed WHERE resent = 0) AS lines_after_dedup,
    (SELECT count(*) FROM tx WHERE channel = 'ecommerce' AND store_id = 'FC-EAST')
      AS routed_to_fulfillment,
    (SELECT count(*) FROM ({DIRTY})) AS unmatched_identifiers,
    (SELECT count(*) FROM ({DIRTY})) AS resolutions_made,
    0 AS unknown_rows_dropped, 0 AS bad_time_rows_dropped,
    (SELECT count(*) FROM tx) AS final_rows)
SELECT metric, CAST(value AS BIGINT) AS value FROM (UNPIVOT c ON COLUMNS(*) INTO NAME metric VALUE value)
""").replace("\n\n, c AS", ", c AS").replace("\n, c AS", ", c AS")


# Lines of the register feed with planted faults, in the order the faults are tried.
_POS_FIELDS = ("transaction_id", "store_id", "timestamp_raw", "upc_or_name",
               "CAST(quantity AS VARCHAR)", "CAST(price_charged_cents AS VARCHAR)")


def _pos_line(*changed: tuple[int, str]) -> str:
    fields = [dict(changed).get(i, f) for i, f in enumerate(_POS_FIELDS)]
    return " || ',' || ".join(fields)


_POS_FAULTS = [
    (113, " || ',' || ".join(_POS_FIELDS[:-1]), "field count"),
    (127, _pos_line((4, "'two'")), "bad quantity"),
    (131, _pos_line((5, "''")), "missing price_charged_cents"),
    (137, _pos_line() + " || ',again'", "field count"),
    (139, _pos_line((4, "'99999999999'")), "bad quantity"),
    (149, _pos_line((0, "''")), "missing transaction_id"),
    (151, "''", "missing transaction_id"),
]
_ORDER_FAULTS = [(113, "malformed", "- 10"), (127, "mistyped", ""),
                 (131, "missing order_id", ""), (137, "missing items", ""),
                 (139, "incomplete item", ""), (149, "missing order_id", "")]


def _by_fault(column: int, faults: list[tuple]) -> str:
    whens = " ".join(f"WHEN l_orderkey % {f[0]} = 0 THEN {f[column]}" for f in faults)
    return f"CASE {whens} END"


def _reason(faults: list[tuple], place: int) -> str:
    return _by_fault(place, [(*f[:place], f"'{f[place]}'", *f[place + 1:]) for f in faults])


POS_REJECTS = f"""
pos_lines AS (
  SELECT {_by_fault(1, _POS_FAULTS)} AS line, {_reason(_POS_FAULTS, 2)} AS reason,
         resent * 1152921504606846976 + l_orderkey * 4194304 + rn AS ingest_order
  FROM raw_pos
)"""
# The documents as JSON, items in line order, at most 500 of an order in one.
ORDER_REJECTS = f"""
documents AS (
  SELECT l_orderkey, (rn - 1) // 500 AS document, any_value(fault) AS reason,
         l_orderkey * 4194304 + document * 500 AS ingest_order,
         '"order_id":"WM-' || l_orderkey || '",' AS id_part,
         '"placed_at":"' || strftime(min(sale_timestamp), '%Y-%m-%dT%H:%M:%SZ')
           || '","customer":{{"id":"' || min(customer_id) || '"}},' AS middle,
         string_agg(CASE WHEN fault = 'incomplete item' THEN '{{' ELSE
             '{{"sku":"' || product_id || '",' END || '"qty":'
           || CASE WHEN fault = 'mistyped' THEN '"two"' ELSE CAST(quantity AS VARCHAR) END
           || ',"unit_price_cents":' || sale_cents || '}}', ',' ORDER BY rn) AS items,
         CASE WHEN min(store_id) = 'FC-EAST' THEN '"fulfillment":"delivery"}}'
              ELSE '"fulfillment":"pickup","store_id":"' || min(store_id) || '"}}' END AS tail
  FROM (SELECT *, {_reason(_ORDER_FAULTS, 1)} AS fault FROM tx WHERE channel = 'ecommerce')
  GROUP BY 1, 2
),
order_lines AS (
  SELECT ingest_order, reason, CASE
      WHEN reason = 'missing order_id' AND l_orderkey % 131 <> 0 THEN ''
      ELSE '{{' || CASE WHEN reason = 'missing order_id' THEN '' ELSE id_part END || middle
        || CASE WHEN reason = 'missing items' THEN '' ELSE '"items":[' || items || '],' END
        || tail END AS document
  FROM documents
)"""


FIRST_LOAD_END, SECOND_LOAD_START, RESENT_START = "1998-02-15", "1998-02-10", "1998-02-01"
LOADS = f"""
sent AS (
  SELECT transaction_id, upc_or_name AS product_identifier, r.store_id,
         r.price_charged_cents AS cents, resent, sale_date
  FROM raw_pos r JOIN tx t USING (transaction_id)
),
loads AS (
  SELECT *, 1 AS run, cents AS charged FROM sent
  WHERE resent = 0 AND sale_date <= DATE '{FIRST_LOAD_END}'
  UNION ALL
  SELECT *, 2, cents + 1 FROM sent
  WHERE sale_date >= CASE WHEN resent = 1 THEN DATE '{RESENT_START}'
                          ELSE DATE '{SECOND_LOAD_START}' END
),
merged AS (
  SELECT transaction_id, product_identifier, store_id, any_value(sale_date) AS sale_date,
         CAST(arg_min(charged, run) AS INTEGER) AS sale_price_cents,
         count(*) AS copies, min(run) AS first_run, max(run) AS last_run
  FROM loads GROUP BY 1, 2, 3
)"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    sql["describe_summary"] = with_views("""
SELECT strftime(min(sale_date), '%Y-%m-%d') AS window_start,
       strftime(max(sale_date), '%Y-%m-%d') AS window_end,
       string_agg(DISTINCT channel, ',' ORDER BY channel) AS channels,
       string_agg(DISTINCT category, ',' ORDER BY category) AS categories,
       string_agg(DISTINCT region, ',' ORDER BY region) AS regions,
       count(*) AS total_transactions, count(DISTINCT product_id) AS total_products
FROM tx""")
    sql["describe_stores"] = "WITH " + STORES + "\nSELECT * FROM stores"
    sql["kpi_summary"] = KPI

    for granularity in BUCKETS:
        for dimension in ("category", "region", "channel", "store_id"):
            sql[f"sales_over_time_{granularity}_{dimension}"] = _over_time(granularity, dimension)
    for dimension in ("region", "channel", "store_id", "category"):
        sql[f"sales_by_{dimension}"] = _by_dimension(dimension)
    sql["regions_by_revenue"] = _by_dimension("region")

    sql["top_products"] = _window(_top(10))
    sql["top_products_category"] = _window(_top(10, "PROMO"))
    sql["top_products_growth"] = _window(GROWTH.format(top=_top(10)))
    sql["top_products_category_growth"] = _window(GROWTH.format(top=_top(10, "PROMO")))
    for dimension in ("category", "store_id", "product_id", "region", "overall"):
        sql[f"forecast_vs_actual_{dimension}"] = _forecast(dimension)
    sql["product_pairs"] = PAIRS
    sql["category_mix"] = _window(MIX)
    sql["category_mix_pivot"] = _window(f"""
SELECT category, coalesce(max(share_pct) FILTER (channel = 'pos'), 0) AS pos,
       coalesce(max(share_pct) FILTER (channel = 'ecommerce'), 0) AS ecommerce
FROM ({MIX}) GROUP BY 1""")
    for granularity, bucket in BUCKETS.items():
        sql[f"revenue_vs_cost_{granularity}"] = _window(f"""
SELECT strftime({bucket}, '%Y-%m-%d') AS bucket, {REVENUE} AS revenue,
       {COST} AS wholesale_cost, {MARGIN} AS gross_margin, {MARGIN_PCT} AS gross_margin_pct
FROM w GROUP BY 1""")
    sql["product_margins"] = _window(MARGINS)
    sql["products_by_margin"] = _window(MARGINS)
    sql["product_margins_category"] = _window(
        MARGINS.replace("FROM w GROUP", "FROM w WHERE category = 'PROMO' GROUP"))
    sql["category_breakdown"] = _window(CATEGORIES)
    sql["daily_velocity"] = _window(VELOCITY)
    sql["product_scatter"] = _window(SCATTER)

    sql["product_quadrants"] = _window(f"""
SELECT *, CASE WHEN units_sold >= median_units AND margin_per_unit >= median_margin THEN 'Stars'
               WHEN margin_per_unit >= median_margin THEN 'Niche gems'
               WHEN units_sold >= median_units THEN 'Workhorses'
               ELSE 'Cut candidates' END AS quadrant
FROM (SELECT s.*, m.* FROM ({SCATTER}) s, (SELECT CAST(median(units_sold) AS DOUBLE) AS median_units,
      CAST(median(margin_per_unit) AS DOUBLE) AS median_margin FROM ({SCATTER})) m)""")
    sql["category_top_margin"] = _window(f"""
SELECT category, revenue, margin_pct,
       CAST(sum(CAST(revenue AS DECIMAL(38,2))) OVER () AS DOUBLE) AS total_revenue,
       row_number() OVER (ORDER BY margin_pct DESC, revenue DESC, category) = 1 AS is_top_margin
FROM ({CATEGORIES})""")
    sql["ranked_top_products"] = _window(f"""
SELECT CAST(row_number() OVER (ORDER BY revenue DESC, product_id) AS INTEGER) AS rank, *
FROM ({GROWTH.format(top=_top(10))})""")
    sql["delta_direction"] = _window(
        _forecast("category").split(WINDOW, 1)[1].split(FORECASTS, 1)[1].join([
            "SELECT category, revenue_delta_pct, CASE WHEN coalesce(revenue_delta_pct, 0) >= 0 "
            "THEN 'up' ELSE 'down' END AS direction FROM (", ")"]), FORECASTS)
    sql["product_search"] = with_views("""
SELECT *, CAST(instr(lower(product_name), 'ring') - 1 AS INTEGER) AS match_offset
FROM products WHERE contains(lower(product_name), 'ring')""")
    sql["sales_calendar"] = _window(f"""
SELECT sale_date, units_sold, revenue,
       CAST(floor((CAST(sale_date AS DATE)
         - (DATE '{START}' - CAST(dayofweek(DATE '{START}') AS INTEGER))) / 7) AS INTEGER)
         AS week_row,
       CAST(dayofweek(CAST(sale_date AS DATE)) AS INTEGER) AS weekday,
       CAST(greatest(ceil(CAST(units_sold * 5 AS DOUBLE) / max(units_sold) OVER ()), 1) AS INTEGER)
         AS level
FROM ({VELOCITY})""")

    sql["raw_before"] = with_views("""
SELECT transaction_id, upc_or_name, store_id, price_charged_cents FROM raw_pos
WHERE NOT regexp_matches(upc_or_name, '^[0-9]+$')
ORDER BY transaction_id LIMIT 20""", RAW_POS)
    sql["raw_after"] = with_views("""
SELECT t.transaction_id, t.product_name, t.category, t.store_id, t.region, t.quantity,
       CAST(t.sale_cents AS DOUBLE) / 100 AS sale_price
FROM tx t JOIN raw_pos r ON r.transaction_id = t.transaction_id
WHERE NOT regexp_matches(r.upc_or_name, '^[0-9]+$')
ORDER BY t.transaction_id LIMIT 20""", RAW_POS)
    sql["week_category_region"] = with_views(f"""
SELECT category, region, {UNITS} AS actual_units,
       CAST(sum(sale_cents * quantity) AS DOUBLE) / 100 AS actual_revenue
FROM tx WHERE sale_date BETWEEN DATE '{WEEK_START}' AND DATE '{WEEK_END}' GROUP BY 1, 2""")

    sql["pos_csv_parsed"] = with_views("""
SELECT transaction_id, store_id, timestamp_raw, upc_or_name,
       quantity, price_charged_cents FROM raw_pos""", RAW_POS)
    sql["orders_json_parsed"] = _raw(f"SELECT {ORDER_COLUMNS}, product_identifier AS sku, "
                                     "quantity AS qty, sale_price_cents AS unit_price_cents "
                                     "FROM feed WHERE channel = 'ecommerce'")
    sql["pos_csv_rejects"] = with_views(
        "SELECT ingest_order, reason, line FROM pos_lines WHERE reason IS NOT NULL",
        RAW_POS, POS_REJECTS)
    sql["order_json_rejects"] = with_views("""
SELECT ingest_order, reason,
       CAST(len(document) - CASE WHEN reason = 'malformed' THEN 10 ELSE 0 END AS BIGINT)
         AS line_length
FROM order_lines WHERE reason IS NOT NULL""", ORDER_REJECTS)
    sql["feed_balance"] = with_views("""
SELECT 'pos' AS feed, coalesce(reason, 'parsed') AS outcome, count(*) AS lines
FROM pos_lines GROUP BY ALL
UNION ALL
SELECT 'orders', coalesce(reason, 'parsed'), count(*) FROM order_lines GROUP BY ALL""",
        RAW_POS, POS_REJECTS, ORDER_REJECTS)
    sql["staged_pos"] = with_views("""
SELECT transaction_id, store_id, timestamp_raw, upc_or_name, quantity, price_charged_cents,
       (dense_rank() OVER (ORDER BY file, block) - 1) * 8589934592
         + (l_orderkey * 4194304 + rn) % 8589934592 AS ingest_order,
       '2026-04-21' AS ingested_on
FROM (SELECT *, CASE WHEN resent = 1 THEN 'again-' ELSE 'first-' END || l_orderkey % 3 AS file,
             l_orderkey // 500 AS block FROM raw_pos)""", RAW_POS)
    sql["staged_orders"] = _raw(f"""
SELECT {ORDER_COLUMNS}, count(*) AS items, CAST(sum(quantity) AS BIGINT) AS units
FROM feed WHERE channel = 'ecommerce' GROUP BY ALL""")
    sql["clean_table_casts"] = with_views(CLEAN.replace(
        "FROM tx", ", strftime(date_trunc('month', sale_date), '%Y-%m-%d') AS sale_month FROM tx"))
    sql["reference_scan"] = """
SELECT CAST(s_suppkey AS BIGINT) AS supplier_id, s_name AS supplier_name FROM supplier"""
    sql["freshness"] = with_views("""
SELECT strftime(max(sale_timestamp) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS last_loaded
FROM tx""")
    sql["explode_orders"] = _raw(f"SELECT {FEED_COLUMNS} FROM feed WHERE channel = 'ecommerce'")
    sql["normalized_union"] = _raw(f"SELECT {FEED_COLUMNS} FROM feed")
    sql["parsed_timestamps"] = _raw("""
SELECT f.transaction_id, f.sale_timestamp_raw,
       strftime(t.sale_timestamp, '%Y-%m-%d %H:%M:%S') AS sale_timestamp,
       strftime(t.sale_date, '%Y-%m-%d') AS sale_date
FROM feed f JOIN tx t USING (transaction_id)""")
    sql["dedup_keep_first"] = _raw(f"""
SELECT {FEED_COLUMNS}, CAST(count(*) AS BIGINT) AS copies
FROM feed GROUP BY ALL""")
    sql["store_routing"] = with_views("""
SELECT store_id, channel, count(*) AS lines FROM tx GROUP BY 1, 2""")
    sql["unmatched_ids"] = with_views(DIRTY, RAW_POS)
    sql["resolved_products"] = with_views("""
SELECT DISTINCT upc_or_name AS identifier, product_id, 'skeleton' AS method, CAST(1 AS DOUBLE) AS score
FROM raw_pos WHERE NOT regexp_full_match(upc_or_name, '[0-9]+')""", RAW_POS)
    sql["fuzzy_matches"] = with_views(
        "SELECT * FROM matched", MISTYPED,
        _brute_force_matches("SELECT DISTINCT identifier FROM mistyped"))
    sql["current_aliases"] = with_views("""
SELECT 'Nr. ' || p_partkey AS identifier,
       lpad(CAST(CASE WHEN p_partkey % 11 = 1 THEN p_partkey
                      WHEN p_partkey % 5 = 1 THEN p_partkey - 1 ELSE p_partkey END AS VARCHAR),
            12, '0') AS product_id
FROM part WHERE p_partkey % 22 <> 1 AND (p_partkey % 7 <> 0 OR p_partkey % 11 = 1)""")
    sql["resolver_cascade"] = with_views("""
SELECT r.identifier, coalesce(alias_id, name_id, skeleton_id, m.product_id, 'UNKNOWN') AS product_id,
       CASE WHEN alias_id IS NOT NULL THEN 'alias' WHEN name_id IS NOT NULL THEN 'exact_name'
            WHEN skeleton_id IS NOT NULL THEN 'skeleton'
            WHEN m.product_id IS NOT NULL THEN 'fuzzy' END AS method,
       CASE WHEN coalesce(alias_id, name_id, skeleton_id) IS NOT NULL THEN 1::DOUBLE
            ELSE m.score END AS score
FROM ruled r LEFT JOIN matched m USING (identifier)""", MISTYPED, REGISTER_STRINGS,
        _brute_force_matches("""SELECT identifier FROM ruled
          WHERE coalesce(alias_id, name_id, skeleton_id) IS NULL
            AND NOT regexp_full_match(identifier, '[0-9]+')"""))
    sql["enriched"] = with_views(CLEAN)
    sql["clean_transactions"] = with_views(CLEAN)
    sql["run_summary"] = SUMMARY
    sql["faulty_run_summary"] = with_views("""
SELECT metric, CAST(value AS BIGINT) AS value FROM (UNPIVOT (
  SELECT (SELECT count(*) FROM raw_pos) AS raw_pos_rows,
    count(DISTINCT l_orderkey) FILTER (channel = 'ecommerce') AS raw_orders,
    count(*) FILTER (channel = 'ecommerce' AND has_items) AS exploded_lines,
    (SELECT count(*) FROM raw_pos WHERE resent = 1) AS duplicates_removed,
    count(*) FILTER (has_items) AS lines_after_dedup,
    count(*) FILTER (channel = 'ecommerce' AND has_items AND store_id = 'FC-EAST')
      AS routed_to_fulfillment,
    count(DISTINCT CASE WHEN unlisted THEN '???' WHEN named THEN product_id END)
      AS unmatched_identifiers,
    count(DISTINCT CASE WHEN named AND NOT unlisted THEN product_id END) AS resolutions_made,
    count(*) FILTER (unlisted) AS unknown_rows_dropped,
    count(*) FILTER (bad_time AND NOT unlisted) AS bad_time_rows_dropped,
    count(*) FILTER (has_items AND NOT unlisted AND NOT bad_time) AS final_rows
  FROM (SELECT *, channel = 'pos' AND l_orderkey % 107 = 0 AS unlisted,
               channel = 'pos' AND l_orderkey % 113 = 0 AS bad_time,
               channel = 'pos' AND (l_orderkey + rn) % 33 = 0 AS named,
               channel = 'pos' OR l_orderkey % 109 <> 0 AS has_items FROM tx))
  ON COLUMNS(*) INTO NAME metric VALUE value)""", RAW_POS)
    sql["merged_load"] = with_views("""
SELECT transaction_id, product_identifier, store_id, sale_price_cents, copies, first_run
FROM merged""", RAW_POS, LOADS)
    sql["load_months"] = with_views("""
SELECT strftime(date_trunc('month', sale_date), '%Y-%m-%d') AS sale_month, count(*) AS lines,
       count(*) FILTER (first_run = 2) AS lines_added, bool_or(last_run = 2) AS written
FROM merged GROUP BY 1""", RAW_POS, LOADS)

    sql["null_violations"] = with_views(
        f"SELECT transaction_id, 'store_id' AS column_name FROM tx WHERE {FAULT['null']}")
    sql["pk_violations"] = with_views(
        f"SELECT transaction_id, CAST(2 AS BIGINT) AS copies FROM tx WHERE {FAULT['copy']}")
    sql["domain_violations"] = with_views(
        f"SELECT transaction_id, 'phone' AS channel FROM tx WHERE {FAULT['channel']}")
    sql["fk_violations"] = with_views(
        f"SELECT '999999999999' AS product_id, transaction_id FROM tx WHERE {FAULT['product']}")
    sql["pk_report"] = with_views(f"""
SELECT 'transactions' AS table_name, 'transaction_id' AS key,
       (SELECT count(*) FROM tx WHERE {FAULT['copy']}) AS violations
UNION ALL SELECT 'products', 'product_id', count(*) - count(DISTINCT product_id) FROM products
UNION ALL SELECT 'stores', 'store_id', count(*) - count(DISTINCT store_id) FROM stores
UNION ALL SELECT 'suppliers', 'supplier_id', count(*) - count(DISTINCT s_suppkey) FROM supplier
UNION ALL SELECT 'forecasts', 'forecast_id',
  count(*) - count(DISTINCT (product_id, store_id, week_start)) FROM forecasts""", FORECASTS)
    sql["fk_report"] = with_views(f"""
SELECT 'transactions' AS table_name, 'product_id' AS key,
       (SELECT count(*) FROM tx WHERE {FAULT['product']})
       + (SELECT count(*) FROM tx WHERE {FAULT['product']} AND {FAULT['copy']}) AS violations
UNION ALL SELECT 'transactions', 'store_id', count(*) FROM tx
  WHERE store_id NOT IN (SELECT store_id FROM stores)
UNION ALL SELECT 'products', 'supplier_id', count(*) FROM products
  WHERE supplier_id NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'forecasts', 'product_id', count(*) FROM forecasts
  WHERE product_id NOT IN (SELECT product_id FROM products)
UNION ALL SELECT 'forecasts', 'store_id', count(*) FROM forecasts
  WHERE store_id NOT IN (SELECT store_id FROM stores)""", FORECASTS)
    sql["bad_timestamps"] = with_views(f"""
SELECT transaction_id, 'not a time' AS sale_timestamp_raw FROM raw_pos
WHERE {FAULT['time']}""", RAW_POS)
    sql["reconciliation"] = _raw("""
SELECT 'lines_in' AS check_name, count(*) AS left_value, count(*) AS right_value,
       CAST(0 AS BIGINT) AS difference FROM feed
UNION ALL
SELECT 'lines_out', count(*), count(*), 0 FROM tx""")
    sql["rollup_reconciliation"] = _window("""
SELECT unnest(['category', 'region', 'channel', 'week']) AS check_name,
       left_value, left_value AS right_value, CAST(0 AS DOUBLE) AS difference
FROM (SELECT CAST(sum(rev) AS DOUBLE) / 100 AS left_value FROM w)""")
    sql["rollup_reconciliation_of_loss"] = _window(f"""
SELECT check_name, CAST(whole - lost AS DOUBLE) / 100 AS left_value,
       CAST(whole AS DOUBLE) / 100 AS right_value, CAST(-lost AS DOUBLE) / 100 AS difference
FROM (SELECT check_name, sum(rev) AS whole,
             coalesce(sum(rev) FILTER (check_name = 'region' AND {FAULT['null']}), 0) AS lost
      FROM w, (SELECT unnest(['category', 'region', 'channel', 'week']) AS check_name)
      GROUP BY 1)""")
    return sql
