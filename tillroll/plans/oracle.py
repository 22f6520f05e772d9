"""Independent SQL statements of every query, for DuckDB over the driver tables.

Written directly from the semantics (window + QUALIFY dedup, LEAD-based validity,
join-then-aggregate marts), not from the Spark plans, so a match is evidence.
One CTE chain (feeds -> clean -> star -> marts) is shared; each query selects
from it. Rounding is exact HALF_UP on whole cents (HUGEINT), as in Spark.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

# The rules of every table (name, good row, severity) as documented, in the documented
# order, and the constants of the derived feeds.


class Check(NamedTuple):
    name: str
    condition: str
    severity: str = "error"


class R:
    SILVER_CUSTOMERS = (
        Check("customer_id_not_null", "customer_id IS NOT NULL"),
        Check("country_not_null", "country IS NOT NULL"),
        Check("country_unambiguous", "country IS NULL OR country <> 'Multiple'", "warn"),
        Check("country_is_specific", "country IS NULL OR country NOT IN ('Unknown', 'European Community')", "warn"),
    )
    SILVER_PRODUCTS = (
        Check("stock_code_not_null", "stock_code IS NOT NULL"),
        Check("version_not_null", "version IS NOT NULL"),
        Check("unit_price_not_null", "unit_price IS NOT NULL"),
        Check("unit_price_positive", "unit_price IS NULL OR unit_price > 0"),
    )
    SILVER_ORDERS = (
        Check("order_line_id_not_null", "order_line_id IS NOT NULL"),
        Check("customer_id_not_null", "customer_id IS NOT NULL", "warn"),
        Check("invoice_no_not_null", "invoice_no IS NOT NULL"),
        Check("stock_code_not_null", "stock_code IS NOT NULL"),
        Check("invoice_ts_valid", "invoice_ts IS NOT NULL"),
        Check("quantity_valid", "quantity <> 0"),
    )
    DIM_CUSTOMER = (
        Check("customer_id_not_null", "customer_id IS NOT NULL"),
        Check("country_not_null", "country IS NOT NULL"),
    )
    DIM_PRODUCT = (
        Check("valid_range", "valid_from < valid_to"),
        Check("unit_price_not_null", "unit_price IS NOT NULL"),
    )
    FACT_SALES = (
        Check("product_found", "product_key IS NOT NULL"),
        Check("line_amount_not_null", "product_key IS NULL OR line_amount IS NOT NULL"),
    )
    TOP_COUNTRIES_BY_CUSTOMERS = (Check("customers_positive", "customers > 0"),)
    REVENUE_BY_COUNTRY = (
        Check("country_not_null", "country IS NOT NULL"),
        Check("revenue_not_null", "revenue IS NOT NULL"),
    )
    PRICE_VS_VOLUME = (Check("avg_unit_price_not_null", "avg_unit_price IS NOT NULL"),)
    TOP_PRICE_DROPS = (Check("is_a_drop", "price_drop > 0"),)


Rule = Check
SPECIAL_CODES = ["POST", "DOT", "C2", "D", "M", "BANK CHARGES", "AMAZONFEE", "CRUK", "B", "S"]
SOURCE_COUNTRY_BY_NATION = [" EIRE ", "RSA", "USA", "Unspecified", "European Community"]
LOAD_TS = {1: "2024-01-01 00:00:00", 2: "2024-01-02 00:00:00"}

INT_RX = "^([+-]?[0-9]+)([.][0-9]*)?$"
TS1, TS2 = (f"TIMESTAMP '{LOAD_TS[i]}'" for i in (1, 2))
BEGIN, END = "TIMESTAMP '1900-01-01 00:00:00'", "TIMESTAMP '9999-12-31 00:00:00'"


def code_sql(key: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(SPECIAL_CODES))
    return f"(CASE {key} {whens} WHEN 10 THEN 'gift_0001_10' ELSE 'SKU' || {key} || 'a' END)"


def lenient_int_sql(expr: str, type_name: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract(trim({expr}), '{INT_RX}', 1), '') AS {type_name})"


def failed_sql(rules: Sequence[Rule]) -> str:
    parts = ", ".join(
        f"CASE WHEN NOT coalesce(({r.condition}), false) THEN '{r.name}' END" for r in rules
    )
    return f"concat_ws(',', {parts})"


def quarantined_sql(rules: Sequence[Rule]) -> str:
    errs = [f"NOT coalesce(({r.condition}), false)" for r in rules if r.severity == "error"]
    return "(" + " OR ".join(errs) + ")" if errs else "false"


def tagged(name: str, source: str, rules: Sequence[Rule]) -> str:
    return (
        f"{name}_tagged AS (SELECT *, {failed_sql(rules)} AS failed_rules, "
        f"{quarantined_sql(rules)} AS quarantined FROM {source}),\n"
        f"{name} AS (SELECT * EXCLUDE (failed_rules, quarantined) FROM {name}_tagged "
        f"WHERE NOT quarantined)"
    )


_nation_case = " ".join(
    f"WHEN {i} THEN '{s}'" for i, s in enumerate(SOURCE_COUNTRY_BY_NATION)
)

CTES = f"""
raw_customers AS (
  SELECT CASE WHEN c.c_custkey % 101 = 0 THEN NULL
              WHEN c.c_custkey % 7 = 0 THEN ' ' || CAST(c.c_custkey AS VARCHAR) || '  '
              ELSE CAST(c.c_custkey AS VARCHAR) END AS customer_id,
         CASE c.c_nationkey {_nation_case} ELSE n.n_name END AS country,
         'customers_1.csv' AS _source_file, CAST(c.c_custkey AS BIGINT) AS _row_id, {TS1} AS _ingested_at
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
  UNION ALL
  SELECT CAST(c.c_custkey AS VARCHAR), n.n_name, 'customers_1.csv', 1000000000 + c.c_custkey, {TS1}
  FROM customer c JOIN nation n ON n.n_nationkey = (c.c_nationkey + 5) % 25
  WHERE c.c_custkey % 50 = 3
  UNION ALL
  SELECT CAST(c.c_custkey AS VARCHAR), n.n_name, 'customers_2.csv', c.c_custkey, {TS2}
  FROM customer c JOIN nation n ON n.n_nationkey = (c.c_nationkey + 7) % 25
  WHERE c.c_custkey % 10 = 1
),
part_rows AS (
  SELECT p_partkey, p_name, {code_sql('p_partkey')} AS code,
         UNNEST(generate_series(CASE WHEN p_partkey % 5 = 0 THEN -1 ELSE 0 END, p_partkey % 4)) AS n
  FROM part
),
raw_products AS (
  SELECT CASE WHEN n >= 0 AND n % 2 = 1 THEN lower(code) ELSE code END AS stock_code,
         CASE WHEN n < 0 THEN 'OLD NAME'
              WHEN p_partkey % 83 = 0 AND p_partkey > 20 THEN 'Gift Voucher '
              WHEN n = p_partkey % 3 THEN ' ' || upper(p_name) || ' '
              WHEN n = 1 THEN 'damaged'
              WHEN n = 2 THEN '   '
              ELSE p_name END AS description,
         CASE WHEN n < 0 THEN '9.99'
              ELSE CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')
         END AS unit_price,
         CASE WHEN n < 0 THEN 'products_1.csv' ELSE 'products_2.csv' END AS _source_file,
         CAST(p_partkey * 10 + greatest(n, 0) AS BIGINT) AS _row_id,
         CASE WHEN n < 0 THEN {TS1} ELSE {TS2} END AS _ingested_at
  FROM (SELECT *, (p_partkey * 37 + n * (p_partkey % 89) * 5 + n * 13) % 500 AS cents FROM part_rows)
),
raw_orders AS (
  SELECT CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 'C' || l.l_orderkey
              WHEN l.l_orderkey % 499 = 0 THEN 'A' || l.l_orderkey
              ELSE CAST(l.l_orderkey AS VARCHAR) END AS invoice_no,
         CASE WHEN l.l_linenumber % 3 = 0 THEN lower({code_sql('l.l_partkey')})
              ELSE {code_sql('l.l_partkey')} || ' ' END AS stock_code,
         CASE WHEN l.l_orderkey % 331 = 0 THEN '0'
              WHEN (l.l_returnflag = 'R' AND l.l_linestatus = 'F') OR l.l_orderkey % 41 = 0
                THEN CAST(-CAST(l.l_quantity AS BIGINT) AS VARCHAR)
              ELSE CAST(CAST(l.l_quantity AS BIGINT) AS VARCHAR) END AS quantity,
         CASE WHEN l.l_orderkey % 503 = 0 THEN '15/5/2011 14:48'
              ELSE strftime(o.o_orderdate, '%-m/%-d/%Y %-H:%M') END AS invoice_date,
         CASE WHEN o.o_custkey % 4 = 0 THEN NULL ELSE CAST(o.o_custkey AS VARCHAR) END AS customer_id,
         'orders_' || d.load || '.csv' AS _source_file,
         CAST(l.l_orderkey * 100 + l.l_linenumber * 2 + d.load AS BIGINT) AS _row_id,
         CASE WHEN d.load = 1 THEN {TS1} ELSE {TS2} END AS _ingested_at
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN (SELECT 1 AS load UNION ALL SELECT 2) d ON d.load = 1 OR l.l_orderkey % 100 = 7
),
cust_typed AS (
  SELECT {lenient_int_sql('customer_id', 'BIGINT')} AS customer_id,
         coalesce(CASE trim(country) WHEN 'EIRE' THEN 'Ireland' WHEN 'RSA' THEN 'South Africa'
                  WHEN 'USA' THEN 'United States' WHEN 'Unspecified' THEN 'Unknown' END,
                  trim(country)) AS country,
         _source_file, _row_id, _ingested_at
  FROM raw_customers
),
cust_current AS (
  SELECT * FROM cust_typed
  QUALIFY _ingested_at = max(_ingested_at) OVER (PARTITION BY customer_id)
),
cust_known AS (
  SELECT customer_id,
         list_sort(list_distinct(list(country) FILTER (WHERE country IS NOT NULL))) AS arr,
         min(_source_file) AS _source_file, min(_row_id) AS _row_id, max(_ingested_at) AS _ingested_at
  FROM cust_current WHERE customer_id IS NOT NULL GROUP BY customer_id
),
customers_clean AS (
  SELECT customer_id,
         CASE WHEN len(arr) > 1 THEN 'Multiple' ELSE arr[1] END AS country,
         CASE WHEN len(arr) > 0 THEN array_to_string(arr, ', ') END AS countries,
         _source_file, _row_id, _ingested_at
  FROM cust_known
  UNION ALL
  SELECT customer_id, country, country, _source_file, _row_id, _ingested_at
  FROM cust_current WHERE customer_id IS NULL
),
{tagged('silver_customers', 'customers_clean', R.SILVER_CUSTOMERS)},
prod_snapshot AS (
  SELECT * FROM raw_products WHERE _ingested_at = (SELECT max(_ingested_at) FROM raw_products)
),
prod_rows AS (
  SELECT upper(trim(stock_code)) AS stock_code,
         CASE WHEN trim(description) <> '' THEN trim(description) END AS description_raw,
         TRY_CAST(trim(unit_price) AS DECIMAL(10,2)) AS unit_price,
         _source_file, _row_id, _ingested_at
  FROM prod_snapshot
),
prod_versions AS (
  SELECT *,
         CAST(row_number() OVER (PARTITION BY stock_code ORDER BY _source_file DESC, _row_id DESC)
              AS INTEGER) AS version,
         coalesce(
           first_value(CASE WHEN regexp_matches(description_raw, '[A-Z]')
                             AND NOT regexp_matches(description_raw, '[a-z]')
                            THEN description_raw END IGNORE NULLS) OVER w,
           first_value(description_raw IGNORE NULLS) OVER w) AS description
  FROM prod_rows
  WINDOW w AS (PARTITION BY stock_code ORDER BY _source_file, _row_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
),
products_clean AS (
  SELECT stock_code, version, description, description_raw, unit_price,
         coalesce(CASE stock_code WHEN 'POST' THEN 'SHIPPING' WHEN 'DOT' THEN 'SHIPPING'
                    WHEN 'C2' THEN 'SHIPPING' WHEN 'D' THEN 'ADJUSTMENT' WHEN 'M' THEN 'ADJUSTMENT'
                    WHEN 'BANK CHARGES' THEN 'NON_REVENUE' WHEN 'AMAZONFEE' THEN 'NON_REVENUE'
                    WHEN 'CRUK' THEN 'NON_REVENUE' WHEN 'B' THEN 'NON_REVENUE'
                    WHEN 'S' THEN 'NON_REVENUE' END,
                  CASE WHEN starts_with(stock_code, 'GIFT_')
                         OR contains(upper(description), 'GIFT VOUCHER') THEN 'NON_REVENUE' END,
                  'MERCHANDISE') AS product_type,
         _source_file, _row_id, _ingested_at
  FROM prod_versions
),
{tagged('silver_products', 'products_clean', R.SILVER_PRODUCTS)},
order_lines AS (
  SELECT sha256(concat_ws('|', coalesce(upper(trim(invoice_no)), ''), coalesce(upper(trim(stock_code)), ''),
                coalesce(trim(quantity), ''), coalesce(trim(invoice_date), ''),
                coalesce(trim(customer_id), ''))) AS order_line_id,
         upper(trim(invoice_no)) AS invoice_no,
         upper(trim(stock_code)) AS stock_code,
         {lenient_int_sql('quantity', 'INTEGER')} AS quantity,
         try_strptime(trim(invoice_date), '%m/%d/%Y %H:%M') AS invoice_ts,
         {lenient_int_sql('customer_id', 'BIGINT')} AS customer_id,
         _source_file, _row_id, _ingested_at
  FROM raw_orders
),
order_lines_typed AS (
  SELECT order_line_id, invoice_no, stock_code, quantity, invoice_ts, customer_id,
         CASE WHEN invoice_no LIKE 'C%' THEN 'CANCELLATION'
              WHEN invoice_no LIKE 'A%' OR quantity < 0 THEN 'ADJUSTMENT'
              ELSE 'SALE' END AS transaction_type,
         _source_file, _row_id, _ingested_at
  FROM order_lines
),
orders_clean AS (
  SELECT * FROM order_lines_typed
  QUALIFY row_number() OVER (PARTITION BY order_line_id ORDER BY _ingested_at DESC, _row_id DESC) = 1
),
{tagged('silver_orders', 'orders_clean', R.SILVER_ORDERS)},
dim_customer_all AS (SELECT customer_id, country, countries FROM silver_customers),
{tagged('dim_customer', 'dim_customer_all', R.DIM_CUSTOMER)},
anchor AS (
  SELECT CAST(date_trunc('month', max(invoice_ts)) AS TIMESTAMP) AS anchor FROM silver_orders
),
dim_pos AS (
  SELECT p.stock_code, p.version, p.description, p.unit_price, p.product_type, a.anchor,
         row_number() OVER (PARTITION BY p.stock_code ORDER BY p.version) AS pos,
         count(*) OVER (PARTITION BY p.stock_code) AS cnt
  FROM silver_products p CROSS JOIN anchor a
),
dim_from AS (
  SELECT *, CASE WHEN pos = 1 THEN {BEGIN}
                 ELSE anchor + to_months(CAST(pos - cnt AS INTEGER)) END AS valid_from
  FROM dim_pos
),
dim_product_all AS (
  SELECT stock_code, version, description, unit_price, product_type, valid_from, valid_to,
         valid_to = {END} AS is_current
  FROM (SELECT *, coalesce(lead(valid_from) OVER (PARTITION BY stock_code ORDER BY version), {END})
                  AS valid_to FROM dim_from)
),
{tagged('dim_product', 'dim_product_all', R.DIM_PRODUCT)},
fact_all AS (
  SELECT o.order_line_id, o.invoice_no, o.invoice_ts, o.customer_id,
         CASE WHEN d.stock_code IS NOT NULL THEN d.version END AS product_key,
         d.stock_code AS p_stock_code, d.version AS p_version,
         o.quantity, d.unit_price, CAST(o.quantity * d.unit_price AS DECIMAL(18,2)) AS line_amount,
         o.transaction_type,
         o.transaction_type IN ('SALE', 'CANCELLATION') AND d.product_type <> 'NON_REVENUE' AS is_revenue
  FROM silver_orders o LEFT JOIN dim_product d
    ON o.stock_code = d.stock_code AND o.invoice_ts >= d.valid_from AND o.invoice_ts < d.valid_to
),
{tagged('fact_sales', 'fact_all', R.FACT_SALES)},
customers_per_country AS (
  SELECT country, CAST(count(*) AS BIGINT) AS customers FROM dim_customer GROUP BY country
),
top_countries_all AS (
  SELECT CAST(dense_rank() OVER (ORDER BY customers DESC) AS INTEGER) AS rank, country, customers
  FROM customers_per_country QUALIFY rank <= 10
),
{tagged('top_countries_by_customers', 'top_countries_all', R.TOP_COUNTRIES_BY_CUSTOMERS)},
revenue_per_country AS (
  SELECT coalesce(c.country, 'Unknown') AS country,
         CAST(sum(f.line_amount) AS DECIMAL(18,2)) AS revenue
  FROM fact_sales f LEFT JOIN dim_customer c ON f.customer_id = c.customer_id
  WHERE f.is_revenue GROUP BY 1
),
revenue_cents AS (
  SELECT country, revenue, CAST(revenue * 100 AS HUGEINT) AS r,
         (SELECT CAST(sum(revenue) * 100 AS HUGEINT) FROM revenue_per_country) AS t
  FROM revenue_per_country
),
revenue_by_country_all AS (
  SELECT CAST(dense_rank() OVER (ORDER BY revenue DESC) AS INTEGER) AS rank, country, revenue,
         CAST((CASE WHEN r < 0 THEN -1 WHEN r > 0 THEN 1 ELSE 0 END)
              * (CASE WHEN t < 0 THEN -1 ELSE 1 END)
              * ((20000 * abs(r) + abs(t)) // NULLIF(2 * abs(t), 0)) AS DOUBLE) / 100 AS revenue_share_pct
  FROM revenue_cents
),
{tagged('revenue_by_country', 'revenue_by_country_all', R.REVENUE_BY_COUNTRY)},
avg_price_by_product AS (
  SELECT stock_code, max(description) AS description,
         CAST(CAST((2 * sum(CAST(unit_price * 100 AS HUGEINT)) + count(unit_price))
                   // NULLIF(2 * count(unit_price), 0) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2))
           AS avg_unit_price
  FROM dim_product WHERE product_type = 'MERCHANDISE' GROUP BY stock_code
),
units_by_product AS (
  SELECT d.stock_code, CAST(sum(f.quantity) AS BIGINT) AS units_sold
  FROM fact_sales f JOIN dim_product d ON f.p_stock_code = d.stock_code AND f.p_version = d.version
  WHERE f.transaction_type IN ('SALE', 'CANCELLATION') GROUP BY d.stock_code
),
price_vs_volume_all AS (
  SELECT a.stock_code, a.description, a.avg_unit_price, CAST(coalesce(u.units_sold, 0) AS BIGINT) AS units_sold
  FROM avg_price_by_product a LEFT JOIN units_by_product u USING (stock_code)
),
{tagged('price_vs_volume', 'price_vs_volume_all', R.PRICE_VS_VOLUME)},
last_month AS (
  SELECT CAST(date_trunc('month', max(invoice_ts)) AS TIMESTAMP) AS ms,
         CAST(date_trunc('month', max(invoice_ts)) AS TIMESTAMP) + INTERVAL 1 MONTH AS me
  FROM fact_sales
),
drop_before AS (
  SELECT d.stock_code, d.unit_price AS price_before
  FROM dim_product d, last_month m
  WHERE d.product_type = 'MERCHANDISE' AND d.valid_from < m.ms AND d.valid_to >= m.ms
),
drop_after AS (
  SELECT d.stock_code, d.description, strftime(m.ms, '%Y-%m') AS month, d.unit_price AS price_after
  FROM dim_product d, last_month m
  WHERE d.product_type = 'MERCHANDISE' AND d.valid_from < m.me AND d.valid_to >= m.me
),
price_drops AS (
  SELECT stock_code, description, month, price_before, price_after,
         CAST(price_before - price_after AS DECIMAL(10,2)) AS price_drop
  FROM drop_before JOIN drop_after USING (stock_code)
),
top_price_drops_all AS (
  SELECT CAST(dense_rank() OVER (ORDER BY price_drop DESC) AS INTEGER) AS rank,
         stock_code, description, month, price_before, price_after, price_drop
  FROM price_drops WHERE price_drop > 0 QUALIFY rank <= 3
),
{tagged('top_price_drops', 'top_price_drops_all', R.TOP_PRICE_DROPS)}
"""

# (table name, layer, CTE of the rows before the rules, rules, tagged CTE)
TABLES = [
    ("silver.customers", "silver", "customers_clean", R.SILVER_CUSTOMERS, "silver_customers_tagged"),
    ("silver.products", "silver", "products_clean", R.SILVER_PRODUCTS, "silver_products_tagged"),
    ("silver.orders", "silver", "orders_clean", R.SILVER_ORDERS, "silver_orders_tagged"),
    ("gold.dim_customer", "gold", "dim_customer_all", R.DIM_CUSTOMER, "dim_customer_tagged"),
    ("gold.dim_product", "gold", "dim_product_all", R.DIM_PRODUCT, "dim_product_tagged"),
    ("gold.fact_sales", "gold", "fact_all", R.FACT_SALES, "fact_sales_tagged"),
    ("gold.top_countries_by_customers", "gold", "top_countries_all", R.TOP_COUNTRIES_BY_CUSTOMERS,
     "top_countries_by_customers_tagged"),
    ("gold.revenue_by_country", "gold", "revenue_by_country_all", R.REVENUE_BY_COUNTRY,
     "revenue_by_country_tagged"),
    ("gold.price_vs_volume", "gold", "price_vs_volume_all", R.PRICE_VS_VOLUME,
     "price_vs_volume_tagged"),
    ("gold.top_price_drops", "gold", "top_price_drops_all", R.TOP_PRICE_DROPS,
     "top_price_drops_tagged"),
]
MART_TABLES = [t for t in TABLES if t[0] in (
    "gold.top_countries_by_customers", "gold.revenue_by_country",
    "gold.price_vs_volume", "gold.top_price_drops")]


def q(select: str) -> str:
    return "WITH " + CTES.strip() + "\n" + select.strip()


def results_sql(tables) -> str:
    parts = []
    for name, _layer, source, rules, _tagged in tables:
        for r in rules:
            parts.append(
                f"SELECT '{name}' AS table_name, '{r.name}' AS rule, '{r.severity}' AS severity, "
                f"CAST(count_if(NOT coalesce(({r.condition}), false)) AS BIGINT) AS failed_rows, "
                f"CAST(count(*) AS BIGINT) AS total_rows FROM {source}"
            )
    return "\nUNION ALL\n".join(parts)


def run_metrics_sql() -> str:
    parts = [
        f"SELECT 'bronze.{b}' AS table_name, 'bronze' AS layer, CAST(count(*) AS BIGINT) AS rows_total, "
        f"CAST(count(*) AS BIGINT) AS rows_published, CAST(0 AS BIGINT) AS rows_quarantined "
        f"FROM raw_{b}"
        for b in ("customers", "products", "orders")
    ]
    for name, layer, _source, _rules, tagged_cte in TABLES:
        parts.append(
            f"SELECT '{name}', '{layer}', CAST(count(*) AS BIGINT), "
            f"CAST(count_if(NOT quarantined) AS BIGINT), CAST(count_if(quarantined) AS BIGINT) "
            f"FROM {tagged_cte}"
        )
    return "\nUNION ALL\n".join(parts)
