"""DuckDB statements that answer the same questions on the same parquet
tables (views ``lineitem``, ``orders``, ... are registered by the caller).

They are written from the questions, by other steps than the Spark plans, so
that they check them rather than repeat them.  Column names and types
match the Spark results: money as DECIMAL(38,2), counts and unit sums as
BIGINT, calendar parts as INTEGER.
"""

from __future__ import annotations

from .. import params

ORDER_BY_LINE = ("order_date, order_id, line_number, product_id, "
                 "line_supplier_id, ship_date, ext_price")

STAR = f"""
WITH lines AS (
  SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_number,
         l.l_partkey AS product_id, l.l_suppkey AS line_supplier_id,
         l.l_shipdate AS ship_date, l.l_extendedprice AS ext_price,
         CAST(l.l_quantity AS INTEGER) AS qty,
         o.o_orderdate AS order_date, o.o_custkey AS customer_id,
         CAST(hour(o.o_orderdate) AS INTEGER) AS hour,
         CAST(minute(o.o_orderdate) AS INTEGER) AS minute,
         CAST(day(o.o_orderdate) AS INTEGER) AS day,
         CAST(month(o.o_orderdate) AS INTEGER) AS month,
         CAST(year(o.o_orderdate) AS INTEGER) AS year,
         CAST(quarter(o.o_orderdate) AS INTEGER) AS quarter,
         CAST(dayofweek(o.o_orderdate) + 1 AS INTEGER) AS day_of_week
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
product AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         p_partkey % (SELECT count(*) FROM supplier) AS supplier_id,
         CAST(p_retailprice AS DECIMAL(10,2)) AS price
  FROM part
),
supplier_d AS (
  SELECT s_suppkey AS supplier_id, s_name AS supplier_name FROM supplier
),
product_store AS (
  SELECT p.product_id, s.s_nationkey + 1 AS store_id, n.n_name AS store_name
  FROM product p JOIN supplier s ON p.supplier_id = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
),
store_dim AS (
  SELECT store_id, min(store_name) AS store_name, min(product_id) AS product_id
  FROM product_store GROUP BY store_id
),
customer_dim AS (
  SELECT customer_id, customer_name, segment, product_id FROM (
    SELECT l.customer_id, c.c_name AS customer_name, c.c_mktsegment AS segment,
           l.product_id,
           row_number() OVER (PARTITION BY l.customer_id ORDER BY {ORDER_BY_LINE}) AS rn
    FROM lines l JOIN customer c ON c.c_custkey = l.customer_id
  ) WHERE rn = 1
),
time_dim AS (
  SELECT row_number() OVER (ORDER BY {ORDER_BY_LINE}) AS time_id, * FROM lines
),
raw_txn AS (
  SELECT l.*, c.c_name AS customer_name, c.c_mktsegment AS gender,
         CASE WHEN l.order_id % {params.RAW_DATE_HEADER_EVERY} = 0 THEN 'Order Date'
              WHEN l.order_id % {params.RAW_DATE_EMPTY_EVERY} = 0 THEN ''
              ELSE strftime(l.order_date, '%-m/%-d/%y %H:%M') END AS order_date_text
  FROM lines l JOIN customer c ON c.c_custkey = l.customer_id
),
parsed_txn AS (
  SELECT *, try_strptime(order_date_text, '%m/%d/%y %H:%M') AS order_ts FROM raw_txn
),
master AS (
  SELECT p.product_id AS row_ord, p.product_id, p.product_name, p.price, p.supplier_id,
         CASE WHEN p.product_id % {params.CONFLICT_PART_EVERY} = 0
              THEN s.supplier_name || ' Ltd' ELSE s.supplier_name END AS supplier_name,
         ps.store_id, ps.store_name
  FROM product p JOIN supplier_d s ON p.supplier_id = s.supplier_id
  JOIN product_store ps ON ps.product_id = p.product_id
)
"""

# Each question is asked of one table of sales (a line with its revenue) or of a
# small summary of it by product; names and owners are attached afterwards.
SALES = STAR + """
, sold AS (
  SELECT product_id, customer_id, supplier_id, year, quarter, month, day_of_week, qty,
         qty * price AS revenue
  FROM lines JOIN product USING (product_id)
),
month_of_product AS (
  SELECT product_id, month, sum(revenue) AS revenue FROM sold GROUP BY product_id, month
),
whole_product AS (
  SELECT product_id, sum(revenue) AS revenue FROM month_of_product GROUP BY product_id
)
"""

Y = params.YEAR
SUP = params.SUPPLIER_NAME
STORE = params.STORE_NAME


def _money(value: str, name: str) -> str:
    return f"CAST({value} AS DECIMAL(38,2)) AS {name}"


QUERIES: dict[str, str] = {}

QUERIES["q1_supplier_drilldown"] = SALES + f"""
, cell AS (SELECT supplier_id, year, quarter, month, sum(revenue) AS revenue FROM sold GROUP BY ALL)
SELECT supplier_id, supplier_name, year, quarter, month, {_money("revenue", "total_sales")}
FROM cell JOIN supplier_d USING (supplier_id)
"""

_OF_SUPPLIER = SALES + f"""
, mine AS (
  SELECT product_id, product_name, month, supplier_id, supplier_name, revenue
  FROM (SELECT * FROM sold WHERE year = {Y}) JOIN product USING (product_id, supplier_id)
       JOIN (SELECT * FROM supplier_d WHERE supplier_name = '{SUP}') USING (supplier_id)
)
"""


def _levels(columns: list[str], kept: list[int]) -> str:
    """One SELECT per level: the first k columns stay, the others are NULL and set their bit."""
    parts = []
    for k in kept:
        shown = [c if n < k else f"NULL AS {c}" for n, c in enumerate(columns)]
        by = f"GROUP BY {', '.join(columns[:k])}" if k else "HAVING count(*) > 0"
        parts.append(f"SELECT {', '.join(shown)}, {_money('sum(revenue)', 'total_sales')}, "
                     f"{2 ** (len(columns) - k) - 1} AS gid FROM mine {by}")
    return " UNION ALL ".join(parts)


QUERIES["q2_rollup_compat"] = _OF_SUPPLIER + _levels(
    ["product_id", "product_name", "month", "supplier_id", "supplier_name"], [5, 4, 3, 2, 1, 0])
QUERIES["q2_grouping_sets"] = _OF_SUPPLIER + _levels(["product_id", "product_name", "month"], [3, 2, 0])

QUERIES["q3_weekend_top5"] = SALES + f"""
, weekend AS (SELECT product_id, sum(qty) AS units FROM sold WHERE day_of_week NOT BETWEEN 2 AND 6 GROUP BY 1)
SELECT product_id, product_name, CAST(units AS BIGINT) AS total_quantity
FROM weekend JOIN product USING (product_id) ORDER BY units DESC, product_id LIMIT {params.TOP_K}
"""

_QUARTERS = ", ".join(f"CAST(coalesce(max(units) FILTER (quarter = {q}), 0) AS BIGINT) AS q{q}" for q in range(1, 5))
QUERIES["q4_quarter_pivot"] = SALES + f"""
, part_year AS (SELECT product_id, quarter, sum(qty) AS units FROM sold WHERE year = {Y} GROUP BY ALL)
SELECT product_id, any_value(product_name) AS product_name, {_QUARTERS},
       CAST(sum(units) AS BIGINT) AS yearly_total
FROM part_year JOIN product USING (product_id) GROUP BY product_id
"""

QUERIES["q5_sigma_anomaly"] = SALES + f"""
, spread AS (SELECT avg(CAST(revenue AS DOUBLE)) AS middle, stddev_samp(CAST(revenue AS DOUBLE)) AS sd
             FROM whole_product)
SELECT product_id, product_name, {_money("revenue", "total_sales")}
FROM whole_product JOIN product USING (product_id), spread
WHERE CAST(revenue AS DOUBLE) NOT BETWEEN middle - {params.SIGMA} * sd AND middle + {params.SIGMA} * sd
"""


def _store_product(stores: str) -> str:
    return SALES + f"""
SELECT store_id, product_id, {_money("revenue", "store_total")}
FROM whole_product JOIN {stores} USING (product_id)
"""


def _store_slice(stores: str) -> str:
    return SALES + f"""
SELECT month, product_id, product_name, {_money("revenue", "total_sales")}
FROM month_of_product JOIN product USING (product_id)
WHERE product_id IN (SELECT product_id FROM {stores} WHERE store_name = '{STORE}')
"""


QUERIES["q6_store_product_mv"] = _store_product("store_dim")
QUERIES["q6_line"] = _store_product("product_store")
QUERIES["q7_store_slice"] = _store_slice("store_dim")
QUERIES["q7_line"] = _store_slice("product_store")

SUPPLIER_MONTH = SALES + f"""
, per_month AS (SELECT supplier_id, month, sum(revenue) AS revenue
                FROM month_of_product JOIN product USING (product_id) GROUP BY ALL)
SELECT supplier_id, supplier_name, month, {_money("revenue", "monthly_sales")}
FROM per_month JOIN supplier_d USING (supplier_id)
"""
QUERIES["q8_supplier_month_mv"] = SUPPLIER_MONTH

# a customer of the compat dimension stands for all sales of one product
QUERIES["q9_compat"] = SALES + f"""
, of_year AS (SELECT product_id, sum(revenue) AS revenue FROM sold WHERE year = {Y} GROUP BY 1)
SELECT customer_id, customer_name, CAST(1 AS BIGINT) AS unique_products, {_money("revenue", "total_sales")}
FROM of_year JOIN customer_dim USING (product_id)
ORDER BY revenue DESC, customer_id LIMIT {params.TOP_K}
"""

QUERIES["q9_line"] = SALES + f"""
, bought AS (SELECT customer_id, product_id, sum(revenue) AS revenue FROM sold WHERE year = {Y} GROUP BY ALL),
best AS (SELECT customer_id, count(*) AS n, sum(revenue) AS revenue FROM bought GROUP BY customer_id)
SELECT customer_id, c_name AS customer_name, CAST(n AS BIGINT) AS unique_products,
       {_money("revenue", "total_sales")}
FROM best JOIN customer ON c_custkey = customer_id
ORDER BY revenue DESC, customer_id LIMIT {params.TOP_K}
"""


def _entity_months(stores: str, buyers: str) -> str:
    """Monthly sales of stores and of customers; ``buyers`` gives (customer_id, month, revenue)."""
    return SALES + f"""
, earned AS (
  SELECT 'Store' AS entity_type, CAST(store_id AS BIGINT) AS id, month, revenue
  FROM month_of_product JOIN {stores} USING (product_id)
  UNION ALL
  SELECT 'Customer', customer_id, month, revenue FROM {buyers}
)
SELECT id, entity_type, id AS entity_id, month, {_money("sum(revenue)", "monthly_sales")}
FROM earned GROUP BY id, entity_type, month
"""


QUERIES["q10_entity_month_mv_compat"] = _entity_months(
    "store_dim", "customer_dim JOIN month_of_product USING (product_id)")
QUERIES["q10_entity_month_mv_line"] = _entity_months("product_store", "sold")


# ---- ingest -------------------------------------------------------------

QUERIES["clean_price"] = STAR + """
SELECT product_id, price FROM master
"""

QUERIES["parse_order_date"] = STAR + """
SELECT order_id, line_number, product_id, order_date_text, order_ts FROM parsed_txn
"""

QUERIES["reject_bad_dates"] = STAR + """
SELECT order_id, line_number, product_id, order_date_text,
       CASE WHEN coalesce(trim(order_date_text), '') = '' THEN 'empty order date'
            ELSE 'unparsable order date' END AS reason
FROM parsed_txn WHERE order_ts IS NULL
"""

QUERIES["calendar_parts"] = """
SELECT event_id,
       CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
       CAST(day(ts) AS INTEGER) AS day, CAST(month(ts) AS INTEGER) AS month,
       CAST(year(ts) AS INTEGER) AS year, CAST(quarter(ts) AS INTEGER) AS quarter,
       CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week
FROM events
"""

QUERIES["dim_time"] = STAR + f"""
SELECT row_number() OVER (ORDER BY {ORDER_BY_LINE}) AS time_id, order_id,
       order_ts AS order_date,
       CAST(hour(order_ts) AS INTEGER) AS hour, CAST(minute(order_ts) AS INTEGER) AS minute,
       CAST(day(order_ts) AS INTEGER) AS day, CAST(year(order_ts) AS INTEGER) AS year,
       CAST(quarter(order_ts) AS INTEGER) AS quarter, CAST(month(order_ts) AS INTEGER) AS month,
       qty, product_id, customer_id
FROM parsed_txn WHERE order_ts IS NOT NULL
"""

# ---- dimensions ---------------------------------------------------------

def _first(src: str, key: str, cols: str, order: str) -> str:
    return STAR + f"""
SELECT {key}, {cols} FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {src}
) WHERE rn = 1
"""


QUERIES["dim_supplier"] = _first("master", "supplier_id", "supplier_name", "row_ord")
QUERIES["dim_product"] = _first("master", "product_id",
                                "product_name, supplier_id, price", "row_ord")
QUERIES["dim_store"] = _first("master", "store_id", "store_name, product_id", "row_ord")
QUERIES["dim_customer"] = _first("parsed_txn", "customer_id",
                                 "customer_name, gender, product_id", ORDER_BY_LINE)

QUERIES["dim_conflicts"] = STAR + """
SELECT supplier_id, CAST(count(DISTINCT supplier_name) AS BIGINT) AS n_values
FROM master GROUP BY supplier_id HAVING count(DISTINCT supplier_name) > 1
"""

QUERIES["dim_incremental_anti"] = STAR + f"""
SELECT customer_id, customer_name, segment, product_id FROM customer_dim
WHERE customer_id IN (SELECT customer_id FROM lines GROUP BY customer_id
                      HAVING min(order_date) >= TIMESTAMP '{params.STORED_BEFORE}')
"""

QUERIES["surrogate_key"] = STAR + f"""
SELECT time_id, {ORDER_BY_LINE} FROM time_dim
"""

# ---- quality ------------------------------------------------------------

QUERIES["check_primary_key"] = """
SELECT l_orderkey AS order_id, l_linenumber AS line_number, count(*) AS n_rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""

QUERIES["check_lengths"] = f"""
SELECT c_custkey AS customer_id, 'segment' AS column_name, c_mktsegment AS value,
       CAST(length(c_mktsegment) AS INTEGER) AS length, {params.SEGMENT_MAX_LEN} AS max_length
FROM customer WHERE length(c_mktsegment) > {params.SEGMENT_MAX_LEN}
"""

QUERIES["load_audit_counts"] = STAR + """
SELECT table_name, attempted, loaded, rejected,
       attempted - loaded - rejected AS repeated FROM (
  SELECT 'supplier' AS table_name, count(*) AS attempted,
         count(DISTINCT supplier_id) AS loaded, count(*) FILTER (WHERE supplier_id IS NULL) AS rejected
  FROM master
  UNION ALL
  SELECT 'product', count(*), count(DISTINCT product_id),
         count(*) FILTER (WHERE product_id IS NULL) FROM master
  UNION ALL
  SELECT 'store', count(*), count(DISTINCT store_id),
         count(*) FILTER (WHERE store_id IS NULL) FROM master
  UNION ALL
  SELECT 'customer', count(*), count(DISTINCT customer_id),
         count(*) FILTER (WHERE customer_id IS NULL) FROM parsed_txn
  UNION ALL
  SELECT 'time', count(*), count(*) FILTER (WHERE order_ts IS NOT NULL),
         count(*) FILTER (WHERE order_ts IS NULL) FROM parsed_txn
)
"""

QUERIES["csv_roundtrip_scan"] = """
SELECT s_suppkey AS supplier_id, s_name || ', "Intl" Co.' AS supplier_name FROM supplier
"""

# ---- fact and lookups ---------------------------------------------------

_FIRST_TIME = "(SELECT product_id, min(time_id) AS time_id FROM time_dim GROUP BY product_id)"
_FIRST_STORE = "(SELECT product_id, min(store_id) AS store_id FROM store_dim GROUP BY product_id)"

QUERIES["lookup_time_first"] = STAR + f"""
SELECT c.customer_id, c.product_id, COALESCE(ft.time_id, 0) AS time_id
FROM customer_dim c LEFT JOIN {_FIRST_TIME} ft ON ft.product_id = c.product_id
"""

QUERIES["lookup_store_first"] = STAR + f"""
SELECT c.customer_id, c.product_id, COALESCE(fs.store_id, 0) AS store_id
FROM customer_dim c LEFT JOIN {_FIRST_STORE} fs ON fs.product_id = c.product_id
"""

FACT_COMPAT = STAR + f"""
SELECT c.product_id, c.customer_id, ft.time_id, COALESCE(fs.store_id, 0) AS store_id,
       CAST(td.qty * p.price AS DECIMAL(18,2)) AS total_sale
FROM customer_dim c
JOIN {_FIRST_TIME} ft ON ft.product_id = c.product_id
JOIN time_dim td ON td.time_id = ft.time_id
JOIN product p ON p.product_id = c.product_id
LEFT JOIN {_FIRST_STORE} fs ON fs.product_id = c.product_id
"""
QUERIES["fact_load_compat"] = FACT_COMPAT
QUERIES["fact_readback_semi"] = FACT_COMPAT

QUERIES["fact_load_line"] = STAR + """
SELECT td.product_id, td.customer_id, td.time_id, COALESCE(ps.store_id, 0) AS store_id,
       CAST(td.qty * p.price AS DECIMAL(18,2)) AS total_sale
FROM time_dim td JOIN product p ON p.product_id = td.product_id
LEFT JOIN product_store ps ON ps.product_id = td.product_id
"""

QUERIES["csv_load_fact"] = STAR + """
SELECT t.product_id, t.customer_id, t.time_id, COALESCE(ps.store_id, 0) AS store_id,
       CAST(t.qty * p.price AS DECIMAL(18,2)) AS total_sale
FROM (SELECT row_number() OVER (ORDER BY order_ts, order_id, product_id, customer_id, qty,
                                         customer_name, gender) AS time_id, *
      FROM parsed_txn WHERE order_ts IS NOT NULL) t
JOIN master p ON p.product_id = t.product_id
LEFT JOIN product_store ps ON ps.product_id = t.product_id
"""

# dirty files: unreadable prices and customer ids, products in no master row
_DIRTY = STAR + f"""
, dirty AS (
  SELECT *, order_id % {params.BAD_ID_EVERY} = 0 AS bad_id,
         order_id % {params.UNKNOWN_PRODUCT_EVERY} = 0 AS unknown FROM parsed_txn
)
"""
QUERIES["csv_load_rejects"] = _DIRTY + f"""
SELECT 'master' AS source, CAST(product_id AS VARCHAR) AS key, 'unreadable price' AS reason
FROM master WHERE product_id % {params.BAD_PRICE_EVERY} = 0
UNION ALL
SELECT 'transactions', CAST(order_id AS VARCHAR),
       CASE WHEN bad_id THEN 'non-numeric id or quantity'
            WHEN order_date_text = '' THEN 'empty order date' ELSE 'unparsable order date' END
FROM dirty WHERE bad_id OR order_ts IS NULL
"""
QUERIES["fact_line_rejects"] = _DIRTY + f"""
SELECT CASE WHEN unknown THEN product_id + {params.UNKNOWN_PRODUCT_SHIFT} ELSE product_id END AS product_id,
       customer_id, qty,
       CASE WHEN unknown THEN 'unknown product' ELSE 'product without a price' END AS reason
FROM dirty WHERE NOT bad_id AND order_ts IS NOT NULL
  AND (unknown OR product_id % {params.BAD_PRICE_EVERY} = 0)
"""

QUERIES["check_foreign_key"] = _DIRTY + f"""
SELECT order_id, product_id + {params.UNKNOWN_PRODUCT_SHIFT} AS product_id, customer_id, qty
FROM dirty WHERE unknown AND NOT bad_id AND order_ts IS NOT NULL
"""

# every master row and line is unique by its key, and only fact rows refer to others
QUERIES["check_constraints"] = STAR + """
, repeats AS (
  SELECT (SELECT count(*) - count(DISTINCT product_id) FROM master) AS products,
         (SELECT count(*) FROM master m WHERE NOT EXISTS
            (SELECT 1 FROM supplier_d s WHERE s.supplier_id = m.supplier_id)) AS unsupplied
)
SELECT 'primary key ' || t AS "constraint", CASE WHEN t = 'product_dim' THEN products ELSE 0 END AS violations
FROM repeats, (VALUES ('supplier_dim'), ('product_dim'), ('store_dim'), ('customer_dim'), ('time_dim'),
               ('sales_fact')) v(t)
UNION ALL
SELECT 'foreign key ' || t, CASE WHEN t = 'product_dim.supplier_id' THEN unsupplied ELSE 0 END
FROM repeats, (VALUES ('sales_fact.product_id'), ('sales_fact.customer_id'), ('sales_fact.time_id'),
               ('product_dim.supplier_id')) v(t)
"""

QUERIES["stream_csv_ingest"] = STAR + """
SELECT row_number() OVER (ORDER BY order_ts, order_id, product_id, customer_id, qty,
                                   customer_name, gender) AS time_id,
       order_id, CAST(NULL AS INTEGER) AS line_number, order_ts AS order_date,
       CAST(hour(order_ts) AS INTEGER) AS hour, CAST(minute(order_ts) AS INTEGER) AS minute,
       CAST(day(order_ts) AS INTEGER) AS day, CAST(year(order_ts) AS INTEGER) AS year,
       CAST(quarter(order_ts) AS INTEGER) AS quarter, CAST(month(order_ts) AS INTEGER) AS month,
       CAST(dayofweek(order_ts) + 1 AS INTEGER) AS day_of_week,
       qty, product_id, customer_id
FROM parsed_txn WHERE order_ts IS NOT NULL
"""

QUERIES["stream_rows_by_key"] = STAR + """
SELECT product_id, row_number() OVER (ORDER BY customer_id) AS position, customer_id FROM customer_dim
"""

# four batches of as many lines each as rounding allows
QUERIES["stream_rate_report"] = """
SELECT CAST(b AS BIGINT) AS batch_id,
       CAST(round_even(n * (b + 1) / 4.0, 0) - round_even(n * b / 4.0, 0) AS BIGINT) AS input_rows
FROM (SELECT count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey), range(4) t(b)
"""

# ---- aggregate tables and streams (the oracle is the batch statement) ----

QUERIES["mv_refresh_full"] = SUPPLIER_MONTH
QUERIES["mv_refresh_incremental"] = SUPPLIER_MONTH
QUERIES["mv_refresh_mixed"] = SUPPLIER_MONTH
QUERIES["stream_mv_refresh"] = SUPPLIER_MONTH
QUERIES["stream_enrich_fact"] = QUERIES["fact_load_line"]
QUERIES["stream_dim_incremental"] = QUERIES["dim_customer"]
QUERIES["stream_fact_compat"] = FACT_COMPAT
QUERIES["stream_q9_line"] = QUERIES["q9_line"]

QUERIES["stream_q9_sketch"] = QUERIES["q9_line"]
QUERIES["stream_q5_sigma"] = QUERIES["q5_sigma_anomaly"]
QUERIES["stream_controlled"] = QUERIES["fact_load_line"]
QUERIES["stream_microbatch_ingest"] = QUERIES["dim_time"]

# lines that came through the files: those with a readable date
_READABLE = "(SELECT * FROM parsed_txn WHERE order_ts IS NOT NULL)"
for _key, _of in (("stream_then_q4", "q4_quarter_pivot"), ("stream_then_q9", "q9_line")):
    QUERIES[_key] = QUERIES[_of].replace("FROM lines JOIN product", f"FROM {_READABLE} JOIN product")

# a warehouse that loads and streams have filled holds the fact of every readable line once
QUERIES["reload_then_stream"] = QUERIES["late_products"] = STAR + """
SELECT t.product_id, t.customer_id, s.store_id, CAST(t.qty * p.price AS DECIMAL(18,2)) AS total_sale,
       CAST(year(t.order_ts) AS INTEGER) AS year
FROM parsed_txn t JOIN product p USING (product_id) JOIN product_store s USING (product_id)
WHERE t.order_ts IS NOT NULL
"""

# of the master files, the one with even products comes first by name
QUERIES["stream_master_dims"] = STAR + """
, placed AS (SELECT *, (product_id % 2) * 1000000000000 + product_id AS place FROM master)
SELECT 'supplier' AS dimension, supplier_id AS id, arg_min(supplier_name, place) AS name,
       CAST(NULL AS BIGINT) AS supplier_id FROM placed GROUP BY supplier_id
UNION ALL
SELECT 'product', product_id, product_name, supplier_id FROM placed
UNION ALL
SELECT 'store', CAST(store_id AS BIGINT), arg_min(store_name, place), NULL FROM placed GROUP BY store_id
"""

QUERIES["refresh_all"] = f"""
SELECT 'store_analysis' AS table_name, concat_ws('/', store_id, product_id) AS cell, store_total AS sales
FROM ({QUERIES["q6_store_product_mv"]})
UNION ALL
SELECT 'supplier_performance', concat_ws('/', supplier_id, supplier_name, month), monthly_sales
FROM ({QUERIES["q8_supplier_month_mv"]})
UNION ALL
SELECT 'customer_store_sales', concat_ws('/', id, entity_type, entity_id, month), monthly_sales
FROM ({QUERIES["q10_entity_month_mv_compat"]})
"""

# lines of every 40th order of the middle range land twice; lines of a file never repeat each other but
# where an order has the same product and quantity twice
QUERIES["stream_constraints"] = STAR + """
, streamed AS (SELECT * FROM parsed_txn WHERE order_ts IS NOT NULL AND order_date >= TIMESTAMP '1997-01-01'),
same AS (
  SELECT order_id, product_id, customer_id, order_ts, qty, count(*) AS n, min(order_date) AS day
  FROM streamed GROUP BY ALL
)
SELECT 'repeated line' AS "constraint", count(*) AS violations FROM same
WHERE n > 1 OR (day < TIMESTAMP '1999-01-01' AND order_id % 40 = 0)
UNION ALL
SELECT 'product of a line', count(DISTINCT product_id) FROM streamed WHERE product_id % 2 = 0
"""
