"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their oracle SQL.

Every query derives its input from the driver tables of ``sf_dir`` (the feeds are
a function of every row of them) and runs over the whole data. Outputs use the
natural keys (never ``xxhash64`` or wall-clock columns) so they compare exactly
with the SQL in ``ORACLE``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType

from tillroll.functions.text import lenient_integer, lenient_us_timestamp, recode_by_table
from tillroll.operators import checks, sinks
from tillroll.operators.asof import asof_join, asof_merge
from tillroll.operators.dedup import latest_per_key, newest_copies
from tillroll.operators.quality import (
    REJECTED,
    evaluate,
    failed_rules_text,
    published,
    quarantined,
    rule_results,
    table_counts,
)
from tillroll.operators.schema import conform
from tillroll.operators.staging import session_workspace
from tillroll.plans import clean, marts, oracle, pipeline, rules, schemas, star
from tillroll.plans.layers import Layers
from tillroll.session import child_names, fs_path, shuffles_removed
from tillroll.sources import feeds, landing
from tillroll.sources.tables import table
from tillroll.streaming.ingest import (
    SILVER_ORDERS_BY_MONTH,
    ingest_available,
    read_bronze,
    stream_orders_to_silver,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

NTZ = "timestamp_ntz"


def engine_neutral(df: DataFrame) -> DataFrame:
    """Driver-facing output types: money (DECIMAL) as its exact text, scale included, and DATE as
    TIMESTAMP_NTZ, which both engines hand back as the same Python/pandas types."""
    out = []
    for f in df.schema:
        if isinstance(f.dataType, DecimalType):
            out.append(F.col(f.name).cast("string").alias(f.name))
        elif isinstance(f.dataType, DateType):
            out.append(F.col(f.name).cast(NTZ).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, money=(), dates=(), texts=(), doubles=()):
    """Register a query; ``money``/``dates`` name its DECIMAL/DATE output columns,
    cast the same way in the oracle SQL. ``texts`` are timestamps emitted as
    canonical text because they hold open-interval ends (9999-12-31) that
    nanosecond-based consumers (pandas) cannot represent. ``doubles`` are nullable
    integer columns (ids, quantities) emitted as DOUBLE: pandas turns a nullable
    integer into float64 on one engine and Int64 on the other."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = engine_neutral(fn(spark, sf_dir))
            recast = {c: F.col(c).cast("string") for c in texts}
            recast.update({c: F.col(c).cast("double") for c in doubles})
            return out.withColumns(recast) if recast else out

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            casts = [f"CAST({c} AS VARCHAR) AS {c}" for c in money]
            casts += [f"CAST({c} AS TIMESTAMP) AS {c}" for c in dates]
            casts += [f"CAST({c} AS VARCHAR) AS {c}" for c in texts]
            casts += [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles]
            body = sql if not casts else f"SELECT * REPLACE ({', '.join(casts)}) FROM ({sql})"
            ORACLE[name] = oracle.q(body)
        return fn

    return register


SOURCE_COLS = ["invoice_no", "stock_code", "quantity", "invoice_date", "customer_id"]


#: Pieces of the orders feed (some 350,000 lines) in a part file of a delivery.
FILE_PIECES = 2


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the session's workspace."""
    return session_workspace(spark).path(name)


def source_columns(feed: str) -> list[str]:
    return [c for c in pipeline.FEEDS[feed][1].names if c[0] != "_"]


def deliver(layers: Layers, feed: str, load: int, landing_dir: str, file_name: str | None = None) -> None:
    """One load of a feed as a CSV delivery, in the order of its rows."""
    rows, files = layers.delivery(feed, load), layers.pieces // FILE_PIECES if feed == "orders" and layers.pieces else 0
    ordered = (rows.repartitionByRange(files, "_row_id") if files else rows.repartitionByRange("_row_id")).sortWithinPartitions("_row_id")
    landing.write_delivery(ordered.select(*source_columns(feed)), landing_dir, file_name or f"{feed}_{load}.csv")


def deliver_orders(spark: SparkSession, layers: Layers, landing_dir: str, load: int) -> None:
    deliver(layers, "orders", load, landing_dir)


# ------------------------------------------------------------------ feeds / scans


@query(
    "scan_raw_orders",
    "SELECT invoice_no, stock_code, quantity, invoice_date, customer_id, _source_file FROM raw_orders",
)
def scan_raw_orders(spark, sf_dir):
    layers = Layers(spark, sf_dir)
    landing_dir = scratch(spark, "landing")
    for load in (1, 2):
        deliver_orders(spark, layers, landing_dir, load)
    scanned = landing.read_landing(spark, landing_dir, "orders_", schemas.BRONZE_ORDERS)
    return scanned.select(*SOURCE_COLS, "_source_file")


@query(
    "snapshot_latest_load",
    "SELECT stock_code, description, unit_price, _source_file, _row_id FROM prod_snapshot",
)
def snapshot_latest_load(spark, sf_dir):
    snap = clean.latest_snapshot(Layers(spark, sf_dir).bronze("products"))
    return snap.select("stock_code", "description", "unit_price", "_source_file", "_row_id")


@query(
    "conform_orders",
    """SELECT order_line_id, invoice_no, stock_code, quantity, invoice_ts, customer_id,
              CAST(NULL AS VARCHAR) AS transaction_type, _source_file, _row_id FROM order_lines""", doubles=['customer_id', 'quantity']
)
def conform_orders(spark, sf_dir):
    lines = clean.typed_lines(Layers(spark, sf_dir).bronze("orders"))
    shaped = lines.drop("transaction_type").withColumn("unexpected", F.lit(1))
    return conform(shaped, schemas.SILVER_ORDERS).drop("_ingested_at")


# ------------------------------------------------------------------ cleaning

SILVER_CUSTOMER_COLS = ["customer_id", "country", "countries", "_source_file", "_row_id"]
SILVER_PRODUCT_COLS = [
    "stock_code", "version", "description", "description_raw", "unit_price", "product_type",
    "_source_file", "_row_id",
]
SILVER_ORDER_COLS = [
    "order_line_id", "invoice_no", "stock_code", "quantity", "invoice_ts", "customer_id",
    "transaction_type", "_source_file", "_row_id",
]


def cols(names):
    return ", ".join(names)


@query(
    "clean_customers", f"SELECT {cols(SILVER_CUSTOMER_COLS)} FROM silver_customers", doubles=['customer_id']
)
def clean_customers(spark, sf_dir):
    return Layers(spark, sf_dir).silver_customers.select(*SILVER_CUSTOMER_COLS)


@query(
    "clean_products", f"SELECT {cols(SILVER_PRODUCT_COLS)} FROM silver_products", money=['unit_price']
)
def clean_products(spark, sf_dir):
    return Layers(spark, sf_dir).silver_products.select(*SILVER_PRODUCT_COLS)


@query(
    "clean_orders", f"SELECT {cols(SILVER_ORDER_COLS)} FROM silver_orders", doubles=['customer_id', 'quantity']
)
def clean_orders(spark, sf_dir):
    return Layers(spark, sf_dir).silver_orders.select(*SILVER_ORDER_COLS)


@query(
    "recode_countries", "SELECT customer_id, country, _source_file, _row_id FROM cust_typed", doubles=['customer_id']
)
def recode_countries(spark, sf_dir):
    typed = clean.typed_customers(Layers(spark, sf_dir).bronze("customers"))
    return typed.select("customer_id", "country", "_source_file", "_row_id")


@query(
    "classify_transactions",
    "SELECT _source_file, _row_id, invoice_no, quantity, transaction_type FROM order_lines_typed", doubles=['quantity']
)
def classify_transactions(spark, sf_dir):
    lines = clean.typed_lines(Layers(spark, sf_dir).bronze("orders"))
    return lines.select("_source_file", "_row_id", "invoice_no", "quantity", "transaction_type")


@query(
    "classify_products",
    "SELECT stock_code, version, description, product_type FROM products_clean",
)
def classify_products(spark, sf_dir):
    products = clean.clean_products(Layers(spark, sf_dir).bronze("products"))
    return products.select("stock_code", "version", "description", "product_type")


@query(
    "fn_lenient_numbers",
    f"""SELECT _source_file, _row_id, quantity AS quantity_text,
               {oracle.lenient_int_sql('quantity', 'INTEGER')} AS quantity,
               {oracle.lenient_int_sql('customer_id', 'BIGINT')} AS customer_id
        FROM raw_orders""", doubles=['quantity', 'customer_id']
)
def fn_lenient_numbers(spark, sf_dir):
    bronze = Layers(spark, sf_dir).bronze("orders")
    return bronze.select(
        "_source_file",
        "_row_id",
        F.col("quantity").alias("quantity_text"),
        lenient_integer("quantity", "int").alias("quantity"),
        lenient_integer("customer_id", "bigint").alias("customer_id"),
    )


@query(
    "fn_lenient_timestamp",
    """SELECT _source_file, _row_id, invoice_date,
              try_strptime(trim(invoice_date), '%m/%d/%Y %H:%M') AS invoice_ts FROM raw_orders""",
)
def fn_lenient_timestamp(spark, sf_dir):
    bronze = Layers(spark, sf_dir).bronze("orders")
    return bronze.select(
        "_source_file", "_row_id", "invoice_date",
        lenient_us_timestamp("invoice_date").alias("invoice_ts"),
    )


@query("line_hash_keys", "SELECT _source_file, _row_id, order_line_id FROM order_lines")
def line_hash_keys(spark, sf_dir):
    lines = clean.typed_lines(Layers(spark, sf_dir).bronze("orders"))
    return lines.select("_source_file", "_row_id", "order_line_id")


@query("dedup_lines", "SELECT order_line_id, _source_file, _row_id FROM orders_clean")
def dedup_lines(spark, sf_dir):
    lines = clean.lines_with_text(Layers(spark, sf_dir).bronze("orders"))
    return clean.keyed(newest_copies(lines, feeds.files(spark, "orders"))).select("order_line_id", "_source_file", "_row_id")


@query(
    "latest_per_key",
    """SELECT customer_id, country, _source_file, _row_id FROM cust_typed
       QUALIFY customer_id IS NULL
            OR row_number() OVER (PARTITION BY customer_id ORDER BY _ingested_at DESC, _row_id DESC) = 1""", doubles=['customer_id']
)
def latest_per_key_customers(spark, sf_dir):
    typed = clean.typed_customers(Layers(spark, sf_dir).bronze("customers"))
    return latest_per_key(typed, ["customer_id"]).select(
        "customer_id", "country", "_source_file", "_row_id"
    )


# ------------------------------------------------------------------ windows


@query(
    "newest_load_per_customer",
    """SELECT customer_id, coalesce(array_to_string(arr, ','), '') AS countries,
              _source_file, _row_id FROM cust_known""", doubles=['customer_id']
)
def newest_load_per_customer(spark, sf_dir):
    typed = clean.typed_customers(Layers(spark, sf_dir).bronze("customers"))
    newest = clean.newest_load_per_customer(typed)
    return newest.select(
        "customer_id",
        F.array_join(F.array_sort("country_set"), ",").alias("countries"),
        "_source_file",
        "_row_id",
    )


@query(
    "customer_countries",
    "SELECT customer_id, country, countries FROM customers_clean WHERE customer_id IS NOT NULL", doubles=['customer_id']
)
def customer_countries(spark, sf_dir):
    customers = clean.clean_customers(Layers(spark, sf_dir).bronze("customers"))
    return customers.filter(F.col("customer_id").isNotNull()).select(
        "customer_id", "country", "countries"
    )


@query(
    "price_versions",
    "SELECT stock_code, version, description_raw, unit_price, _row_id FROM prod_versions", money=['unit_price']
)
def price_versions(spark, sf_dir):
    snap = clean.latest_snapshot(Layers(spark, sf_dir).bronze("products"))
    return clean.price_versions(snap).select(
        "stock_code", "version", "description_raw", "unit_price", "_row_id"
    )


@query("product_names", "SELECT DISTINCT stock_code, description FROM prod_versions")
def product_names(spark, sf_dir):
    snap = clean.latest_snapshot(Layers(spark, sf_dir).bronze("products"))
    return clean.price_versions(snap).select("stock_code", "description").distinct()


@query(
    "scd2_validity",
    "SELECT stock_code, version, valid_from, valid_to, is_current FROM dim_product",
    texts=["valid_from", "valid_to"],
)
def scd2_validity(spark, sf_dir):
    return Layers(spark, sf_dir).dim_product.select(
        "stock_code", "version", "valid_from", "valid_to", "is_current"
    )


# ------------------------------------------------------------------ star

DIM_PRODUCT_COLS = [
    "stock_code", "version", "description", "unit_price", "product_type", "valid_from",
    "valid_to", "is_current",
]
FACT_COLS = [
    "order_line_id", "invoice_no", "invoice_ts", "customer_id", "quantity", "unit_price",
    "line_amount", "transaction_type", "is_revenue",
]


@query(
    "dim_customer", "SELECT customer_id, country, countries FROM dim_customer", doubles=['customer_id']
)
def dim_customer(spark, sf_dir):
    return Layers(spark, sf_dir).dim_customer


@query(
    "dim_product", f"SELECT {cols(DIM_PRODUCT_COLS)} FROM dim_product", money=['unit_price'],
    texts=["valid_from", "valid_to"],
)
def dim_product(spark, sf_dir):
    return Layers(spark, sf_dir).dim_product.select(*DIM_PRODUCT_COLS)


@query(
    "fact_sales", f"SELECT {cols(FACT_COLS)} FROM fact_sales", money=['unit_price', 'line_amount'], doubles=['customer_id', 'quantity']
)
def fact_sales(spark, sf_dir):
    return Layers(spark, sf_dir).share_lines().fact_sales.select(*FACT_COLS)


@query(
    "asof_price_join",
    """SELECT o.order_line_id, o.stock_code, o.invoice_ts, d.version, d.unit_price
       FROM silver_orders o LEFT JOIN dim_product d
         ON o.stock_code = d.stock_code AND o.invoice_ts >= d.valid_from AND o.invoice_ts < d.valid_to""", money=['unit_price'], doubles=['version']
)
def asof_price_join(spark, sf_dir):
    layers = Layers(spark, sf_dir).share_lines()
    lines = layers.lines_for_fact.select("invoice_no", "stock_code", "invoice_ts", clean.LINE_TEXT)
    joined = asof_join(lines, layers.dim_product_for_gold, "stock_code", "invoice_ts", pieces=layers.fact_pieces)
    return joined.select(
        clean.line_key(lambda c: F.col(f"f.{c}")).alias("order_line_id"), "f.stock_code", "f.invoice_ts", "v.version", "v.unit_price"
    )


@query(
    "asof_price_merge",
    """SELECT o.order_line_id, o.stock_code, o.invoice_ts, d.version, d.unit_price
       FROM silver_orders o ASOF LEFT JOIN dim_product d
         ON o.stock_code = d.stock_code AND o.invoice_ts >= d.valid_from""", money=['unit_price'], doubles=['version']
)
def asof_price_merge(spark, sf_dir):
    """The as-of join by merging in (code, time) order: no version is repeated."""
    layers = Layers(spark, sf_dir).share_lines()
    lines = layers.lines_for_fact.select("invoice_no", "stock_code", "invoice_ts", clean.LINE_TEXT)
    versions = layers.dim_product_for_gold.select("stock_code", "version", "unit_price", "valid_from", "valid_to")
    joined = asof_merge(lines, versions, "stock_code", "invoice_ts")
    key = clean.line_key(lambda c: F.col(f"f.{c}")).alias("order_line_id")
    return joined.select(key, "f.stock_code", "f.invoice_ts", "v.version", "v.unit_price")


@query(
    "left_join_unknown_bucket",
    """SELECT f.customer_id, coalesce(c.country, 'Unknown') AS country,
              CAST(sum(f.line_amount) AS DECIMAL(18,2)) AS revenue
       FROM fact_sales f LEFT JOIN dim_customer c ON f.customer_id = c.customer_id
       WHERE f.is_revenue GROUP BY f.customer_id, c.country""", money=['revenue'], doubles=['customer_id']
)
def left_join_unknown_bucket(spark, sf_dir):
    layers = Layers(spark, sf_dir).share_lines(text=False)
    per_customer = marts.revenue_per_customer(layers.fact_for_marts).join(
        layers.dim_customer.select("customer_id", "country"), "customer_id", "left"
    )
    return per_customer.select(
        "customer_id",
        F.coalesce("country", F.lit(marts.UNKNOWN_COUNTRY)).alias("country"),
        F.col("revenue").cast("decimal(18,2)").alias("revenue"),
    )


@query(
    "price_at_instant",
    """SELECT d.stock_code, d.version, d.unit_price FROM dim_product d, anchor a
       WHERE d.valid_from < a.anchor AND d.valid_to >= a.anchor""", money=['unit_price']
)
def price_at_instant(spark, sf_dir):
    layers = Layers(spark, sf_dir)
    instant = star.latest_month(layers.orders_for_anchor, "invoice_ts").cast(NTZ)
    return star.price_at_instant(layers.dim_product_for_gold, instant).select(
        "stock_code", "version", "unit_price"
    )


@query(
    "latest_month",
    "SELECT (SELECT anchor FROM anchor) AS orders_month, (SELECT ms FROM last_month) AS fact_month",
)
def latest_month(spark, sf_dir):
    layers = Layers(spark, sf_dir).share_instants()
    return layers.orders_for_anchor.agg(
        star.month_of(F.max("invoice_ts")).cast(NTZ).alias("orders_month")
    ).select(
        "orders_month",
        star.latest_month(layers.fact_for_last_month, "invoice_ts").cast(NTZ).alias("fact_month"),
    )


# ------------------------------------------------------------------ marts


@query(
    "top_countries_by_customers",
    "SELECT rank, country, customers FROM top_countries_by_customers",
)
def top_countries_by_customers(spark, sf_dir):
    return Layers(spark, sf_dir).top_countries_by_customers


@query(
    "revenue_by_country",
    "SELECT rank, country, revenue, revenue_share_pct FROM revenue_by_country", money=['revenue']
)
def revenue_by_country(spark, sf_dir):
    return Layers(spark, sf_dir).share_lines(text=False).revenue_by_country


@query(
    "price_vs_volume",
    "SELECT stock_code, description, avg_unit_price, units_sold FROM price_vs_volume", money=['avg_unit_price']
)
def price_vs_volume(spark, sf_dir):
    return Layers(spark, sf_dir).share_lines(text=False).price_vs_volume


@query(
    "top_price_drops",
    """SELECT rank, stock_code, description, month, price_before, price_after, price_drop
       FROM top_price_drops""", money=['price_before', 'price_after', 'price_drop']
)
def top_price_drops(spark, sf_dir):
    return Layers(spark, sf_dir).top_price_drops


@query("customers_per_country", "SELECT country, customers FROM customers_per_country")
def customers_per_country(spark, sf_dir):
    return marts.customers_per_country(Layers(spark, sf_dir).dim_customer)


@query("units_by_product", "SELECT stock_code, units_sold FROM units_by_product")
def units_by_product(spark, sf_dir):
    layers = Layers(spark, sf_dir).share_lines(text=False)
    return marts.units_by_product(layers.fact_for_marts, layers.dim_product_for_gold)


@query(
    "avg_price_by_product",
    "SELECT stock_code, description, avg_unit_price FROM avg_price_by_product", money=['avg_unit_price']
)
def avg_price_by_product(spark, sf_dir):
    return marts.avg_price_by_product(Layers(spark, sf_dir).dim_product)


# ------------------------------------------------------------------ quality

TAG_KEYS = {
    "customers": ("tagged_customers", ["customer_id", "_source_file", "_row_id"], "silver_customers_tagged"),
    "products": ("tagged_products", ["stock_code", "version"], "silver_products_tagged"),
    "orders": ("tagged_orders", ["order_line_id"], "silver_orders_tagged"),
}


def _tag_query(attr, keys):
    def run(spark, sf_dir):
        tagged = getattr(Layers(spark, sf_dir), attr)
        return tagged.select(
            *keys, failed_rules_text().alias("failed_rules"), F.col(REJECTED).alias("quarantined")
        )

    return run


for _name, (_attr, _keys, _cte) in TAG_KEYS.items():
    query(
        f"dq_tag_{_name}",
        f"SELECT {cols(_keys)}, failed_rules, quarantined FROM {_cte}",
        doubles=[k for k in _keys if k == "customer_id"],
    )(_tag_query(_attr, _keys))


FACT_READERS = {"gold.revenue_by_country", "gold.price_vs_volume", "gold.top_price_drops"}

RESULT_GROUPS = {
    "customers": ["silver.customers"],
    "products": ["silver.products"],
    "orders": ["silver.orders"],
    "dim_customer": ["gold.dim_customer"],
    "dim_product": ["gold.dim_product"],
    "fact": ["gold.fact_sales"],
    "marts": [t[0] for t in oracle.MART_TABLES],
}


def _results(layers: Layers, names) -> DataFrame:
    if len([n for n in names if n in FACT_READERS]) > 1:
        layers.share_lines().share_fact()
    elif "gold.fact_sales" in names:
        layers.share_lines()
    frames = [rule_results(layers.tagged(n), Layers.TABLES[n][2], n) for n in names]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _results_query(names):
    def run(spark, sf_dir):
        return _results(Layers(spark, sf_dir), names)

    return run


for _group, _names in RESULT_GROUPS.items():
    query(
        f"dq_results_{_group}",
        oracle.results_sql([t for t in oracle.TABLES if t[0] in _names]),
    )(_results_query(_names))


# fields of the quarantine record that are compared: (name, type it is read back as)
QUARANTINE_FIELDS = {
    "customers": ("tagged_customers", "silver.customers", "silver_customers_tagged", [
        ("customer_id", "bigint"), ("country", "string"), ("countries", "string"), ("_source_file", "string"),
        ("_row_id", "bigint"),
    ]),
    "products": ("tagged_products", "silver.products", "silver_products_tagged", [
        ("stock_code", "string"), ("version", "int"), ("description", "string"), ("description_raw", "string"),
        ("unit_price", "decimal(10,2)"), ("product_type", "string"), ("_source_file", "string"),
    ]),
    "orders": ("tagged_orders", "silver.orders", "silver_orders_tagged", [
        ("order_line_id", "string"), ("invoice_no", "string"), ("stock_code", "string"), ("quantity", "int"),
        ("invoice_ts", "timestamp_ntz"), ("customer_id", "bigint"), ("transaction_type", "string"),
    ]),
    "fact": ("tagged_fact_sales", "gold.fact_sales", "fact_sales_tagged", [
        ("order_line_id", "string"), ("invoice_no", "string"), ("invoice_ts", "timestamp_ntz"), ("quantity", "int"),
        ("unit_price", "decimal(10,2)"), ("line_amount", "decimal(18,2)"), ("is_revenue", "boolean"),
    ]),
}


def record_field(name: str, type_name: str) -> F.Column:
    return F.get_json_object("record", f"$.{name}").cast(type_name).alias(name)


def _quarantine_query(attr, table_name, fields):
    def run(spark, sf_dir):
        layers = Layers(spark, sf_dir)
        records = quarantined(getattr(layers.share_lines() if attr == "tagged_fact_sales" else layers, attr), table_name)
        return records.select(
            "table_name", *[record_field(k, t) for k, t in fields], F.array_join("failed_rules", ",").alias("failed_rules")
        )

    return run


for _name, (_attr, _table, _cte, _fields) in QUARANTINE_FIELDS.items():
    query(
        f"dq_quarantine_{_name}",
        f"SELECT '{_table}' AS table_name, {cols([k for k, _ in _fields])}, failed_rules "
        f"FROM {_cte} WHERE quarantined",
        doubles=[k for k, _ in _fields if k in ("customer_id", "quantity")],
        money=[k for k, t in _fields if t.startswith("decimal")],
    )(_quarantine_query(_attr, _table, _fields))


@query("run_metrics", oracle.run_metrics_sql())
def run_metrics(spark, sf_dir):
    layers = Layers(spark, sf_dir).share_lines().share_fact()
    frames = []
    for b in ("customers", "products", "orders"):
        frames.append(
            layers.bronze(b).agg(
                F.lit(f"bronze.{b}").alias("table_name"),
                F.lit("bronze").alias("layer"),
                F.count(F.lit(1)).alias("rows_total"),
                F.count(F.lit(1)).alias("rows_published"),
                F.lit(0).cast("bigint").alias("rows_quarantined"),
            )
        )
    for name, (layer, _attr, _rules) in Layers.TABLES.items():
        frames.append(
            table_counts(layers.tagged(name), name).select(
                "table_name", F.lit(layer).alias("layer"), "rows_total", "rows_published",
                "rows_quarantined",
            )
        )
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ------------------------------------------------------------------ ad-hoc / ops


@query(
    "adhoc_multi_country",
    """SELECT trim(customer_id) AS customer_id,
              array_to_string(list_sort(list_distinct(list(country) FILTER (WHERE country IS NOT NULL))), '|') AS countries,
              CAST(count(DISTINCT country) AS BIGINT) AS n_countries
       FROM raw_customers WHERE trim(customer_id) <> ''
       GROUP BY trim(customer_id) HAVING count(DISTINCT country) > 1""",
)
def adhoc_multi_country(spark, sf_dir):
    bronze = Layers(spark, sf_dir).bronze("customers")
    return (
        bronze.filter(F.trim("customer_id") != "")
        .groupBy(F.trim("customer_id").alias("customer_id"))
        .agg(F.array_sort(F.collect_set("country")).alias("_countries"))
        .select(
            "customer_id",
            F.array_join("_countries", "|").alias("countries"),
            F.size("_countries").cast("bigint").alias("n_countries"),
        )
        .filter(F.col("n_countries") > 1)
    )


@query(
    "adhoc_note_descriptions",
    """SELECT trim(description) AS description, CAST(count(*) AS BIGINT) AS n
       FROM raw_products WHERE regexp_matches(description, '[a-z]') GROUP BY 1""",
)
def adhoc_note_descriptions(spark, sf_dir):
    bronze = Layers(spark, sf_dir).bronze("products")
    return (
        bronze.filter(F.col("description").rlike("[a-z]"))
        .groupBy(F.trim("description").alias("description"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"))
    )


@query(
    "adhoc_bad_dates",
    """SELECT invoice_date, _source_file, _row_id FROM raw_orders
       WHERE try_strptime(trim(invoice_date), '%m/%d/%Y %H:%M') IS NULL""",
)
def adhoc_bad_dates(spark, sf_dir):
    bronze = Layers(spark, sf_dir).bronze("orders")
    return bronze.filter(lenient_us_timestamp("invoice_date").isNull()).select(
        "invoice_date", "_source_file", "_row_id"
    )


@query(
    "adhoc_duplicate_lines",
    """SELECT CAST(count(*) AS BIGINT) AS lines,
              CAST(count(DISTINCT row(invoice_no, stock_code, quantity, invoice_date, customer_id)) AS BIGINT) AS distinct_lines,
              CAST(count(*) - count(DISTINCT row(invoice_no, stock_code, quantity, invoice_date, customer_id)) AS BIGINT) AS duplicate_lines
       FROM raw_orders""",
)
def adhoc_duplicate_lines(spark, sf_dir):
    bronze = Layers(spark, sf_dir).bronze("orders")
    # one row per distinct line (partial aggregation on the map side), then count
    distinct = bronze.groupBy(*SOURCE_COLS).agg(F.count(F.lit(1)).alias("copies"))
    return distinct.agg(
        F.sum("copies").alias("lines"),
        F.count(F.lit(1)).alias("distinct_lines"),
        (F.sum("copies") - F.count(F.lit(1))).alias("duplicate_lines"),
    )


ALL_TABLES = [t[0] for t in oracle.TABLES]
TAG_TABLES = ("silver.customers", "silver.products", "silver.orders")


@query(
    "ops_last_run_failures",
    "SELECT 'run-2' AS run_id, table_name, rule, severity, failed_rows FROM ("
    + oracle.results_sql(oracle.TABLES)
    + ") WHERE failed_rows > 0",
)
def ops_last_run_failures(spark, sf_dir):
    """The documented question over stored metrics: two runs' results are stored (the first one
    over the first load only), the rules that failed in the last run are asked for."""
    everything = Layers(spark, sf_dir)
    first = Layers(spark, bronze={
        feed: everything.bronze(feed).filter(F.col("_source_file") == f"{feed}_1.csv") for feed in pipeline.FEEDS
    })
    path = scratch(spark, "dq_results")
    runs = {"run-1": (first, list(TAG_TABLES)), "run-2": (everything, ALL_TABLES)}
    for run_id, (layers, names) in runs.items():
        results = _results(layers, names).select(F.lit(run_id).alias("run_id"), "*", F.current_timestamp().alias("checked_at"))
        sinks.append(conform(results, schemas.DQ_RESULTS), path)
    stored = sinks.read_table(spark, path, schemas.DQ_RESULTS)
    return spark.sql(
        """SELECT run_id, table_name, rule, severity, failed_rows FROM {results}
           WHERE run_id = (SELECT MAX(run_id) FROM {results}) AND failed_rows > 0""",
        results=stored,
    )


@query(
    "ops_rule_quarantine",
    """SELECT order_line_id, invoice_no, failed_rules FROM silver_orders_tagged
       WHERE quarantined AND list_contains(string_split(failed_rules, ','), 'invoice_ts_valid')""",
)
def ops_rule_quarantine(spark, sf_dir):
    """The records of one rule, from a stored quarantine of several tables."""
    layers, path = Layers(spark, sf_dir), scratch(spark, "quarantine")
    for attr, table_name in (("tagged_products", "silver.products"), ("tagged_orders", "silver.orders")):
        records = quarantined(getattr(layers, attr), table_name, "run-1")
        sinks.append(conform(records, schemas.DQ_QUARANTINE), path, ["table_name"])
    stored = sinks.read_table(spark, path, schemas.DQ_QUARANTINE)
    return stored.filter(F.array_contains("failed_rules", "invoice_ts_valid")).select(
        record_field("order_line_id", "string"),
        record_field("invoice_no", "string"),
        F.array_join("failed_rules", ",").alias("failed_rules"),
    )


@query(
    "ops_ingested_files",
    """SELECT _source_file, _ingested_at, CAST(count(*) AS BIGINT) AS n
       FROM raw_orders GROUP BY _source_file, _ingested_at""",
)
def ops_ingested_files(spark, sf_dir):
    bronze = Layers(spark, sf_dir).bronze("orders")
    return bronze.groupBy("_source_file", F.col("_ingested_at").cast(NTZ).alias("_ingested_at")).agg(
        F.count(F.lit(1)).alias("n")
    )


# ------------------------------------------------------------------ checks over tables and runs


@query(
    "dq_referential",
    """SELECT 'dim_product' AS referenced, stock_code AS orphan, CAST(count(*) AS BIGINT) AS n
       FROM silver_orders WHERE stock_code NOT IN (SELECT stock_code FROM dim_product) GROUP BY stock_code
       UNION ALL
       SELECT 'dim_customer', CAST(customer_id AS VARCHAR), CAST(count(*) AS BIGINT)
       FROM silver_orders WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM dim_customer)
       GROUP BY customer_id
       UNION ALL
       SELECT 'dim_product of the fact', CAST(product_key AS VARCHAR), CAST(count(*) AS BIGINT)
       FROM fact_sales WHERE product_key NOT IN (SELECT product_key FROM dim_product) GROUP BY product_key""",
)
def dq_referential(spark, sf_dir):
    """Keys of published lines, and of the fact, that a dimension does not have."""
    layers = Layers(spark, sf_dir).share_lines()
    lines, products = layers.lines_for_fact, layers.dim_product_for_gold
    sides = {
        "dim_product": checks.orphans(lines, "stock_code", products, "stock_code"),
        "dim_customer": checks.orphans(lines, "customer_id", layers.dim_customer, "customer_id"),
        "dim_product of the fact": checks.orphans(layers.fact_for_marts, "product_key", products, "product_key"),
    }
    rows = [df.select(F.lit(name).alias("referenced"), F.col("key").cast("string").alias("orphan"), "n") for name, df in sides.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(
    "dq_price_jumps",
    """SELECT stock_code, version, previous_price, unit_price FROM (
         SELECT *, lag(unit_price) OVER (PARTITION BY stock_code ORDER BY version) AS previous_price FROM dim_product)
       WHERE unit_price > 3 * previous_price OR 3 * unit_price < previous_price""", money=["previous_price", "unit_price"],
)
def dq_price_jumps(spark, sf_dir):
    """Price versions over three times, or under a third of, the one before."""
    return checks.price_jumps(Layers(spark, sf_dir).dim_product_for_gold)


@query(
    "dq_volume",
    """SELECT table_name, 'run-2' AS run_id, CAST(new AS BIGINT) AS rows_total, CAST(old AS BIGINT) AS usual_rows,
              new * 100 NOT BETWEEN old * 50 AND old * 200 AS unusual
       FROM (SELECT table_name, count(*) FILTER (WHERE _source_file LIKE '%_2.csv') AS new,
                    count(*) FILTER (WHERE _source_file LIKE '%_1.csv') AS old
             FROM (SELECT 'customers' AS table_name, _source_file FROM raw_customers
                   UNION ALL SELECT 'products', _source_file FROM raw_products
                   UNION ALL SELECT 'orders', _source_file FROM raw_orders) GROUP BY table_name)""",
)
def dq_volume(spark, sf_dir):
    """The rows of the last load of each feed against the loads before, from a stored run log."""
    layers, path = Layers(spark, sf_dir), scratch(spark, "run_log")
    for load in (1, 2):
        for feed in pipeline.FEEDS:
            rows = layers.bronze(feed).filter(F.col("_source_file") == f"{feed}_{load}.csv")
            line = rows.agg(F.count(F.lit(1)).alias("rows_total")).withColumns({"run_id": F.lit(f"run-{load}"), "table_name": F.lit(feed)})
            sinks.append(conform(line, schemas.RUN_LOG), path)
    return checks.volume_changes(sinks.read_table(spark, path, schemas.RUN_LOG))


@query(
    "dq_freshness",
    """SELECT table_name, newest, CAST(date_diff('day', CAST(newest AS DATE), DATE '2024-01-04') AS BIGINT) AS days,
              date_diff('day', CAST(newest AS DATE), DATE '2024-01-04') > 2 AS stale
       FROM (SELECT 'customers' AS table_name, max(_ingested_at) AS newest FROM raw_customers WHERE _source_file = 'customers_1.csv'
             UNION ALL SELECT 'products', max(_ingested_at) FROM raw_products
             UNION ALL SELECT 'orders', max(_ingested_at) FROM raw_orders)""",
)
def dq_freshness(spark, sf_dir):
    """How old each feed's newest load is on 2024-01-04; the customers' second load has not come yet."""
    layers = Layers(spark, sf_dir)
    tables = {feed: layers.bronze(feed) for feed in pipeline.FEEDS}
    tables["customers"] = tables["customers"].filter(F.col("_source_file") == "customers_1.csv")
    found = checks.staleness(tables, F.lit("2024-01-04").cast("date"), 2)
    return found.withColumn("newest", F.col("newest").cast(NTZ))


@query(
    "units_around_median_price",
    """WITH p AS (SELECT *, CAST(avg_unit_price AS DOUBLE) AS price FROM price_vs_volume),
            m AS (SELECT quantile_cont(price, 0.5) AS median FROM p)
       SELECT CASE WHEN price < median THEN 'below' WHEN price > median THEN 'above' ELSE 'median' END AS side,
              CAST(count(*) AS BIGINT) AS products, CAST(sum(units_sold) AS BIGINT) AS units,
              CAST(sign(sum(units_sold)) * ((abs(CAST(sum(units_sold) AS HUGEINT)) * 200 + count(*)) // (2 * count(*))) AS DECIMAL(18,0)) / 100 AS avg_units,
              any_value(median) AS median_price
       FROM p, m GROUP BY 1""", doubles=["avg_units"],
)
def units_around_median_price(spark, sf_dir):
    return marts.units_around_median_price(Layers(spark, sf_dir).share_lines(text=False).price_vs_volume)


@query(
    "recode_by_nation",
    """SELECT c.c_custkey, coalesce(n.n_name, 'none') AS nation, coalesce(r.n_name, CAST(c.c_custkey AS VARCHAR)) AS of_key
       FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey AND n.n_nationkey <> 3
       LEFT JOIN nation r ON r.n_nationkey = c.c_custkey""",
)
def recode_by_nation(spark, sf_dir):
    """A dictionary that is a table, as a map and as a join; one of its names is missing."""
    customers, nation = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), table(spark, sf_dir, "nation")
    known = nation.withColumn("n_name", F.when(F.col("n_nationkey") != 3, F.col("n_name")))
    named = recode_by_table(customers, "c_nationkey", known, "n_nationkey", "n_name", "nation", F.lit("none"))
    named = recode_by_table(named, "c_custkey", nation, "n_nationkey", "n_name", "of_key", most_entries=10)
    return named.select("c_custkey", "nation", "of_key")


@query(
    "ingest_by_listing",
    f"SELECT {cols(SOURCE_COLS)}, _source_file FROM raw_orders",
)
def ingest_by_listing(spark, sf_dir):
    """Two deliveries, three runs: what is new is found by an anti join of the listing with what is noted."""
    layers, landing_dir = Layers(spark, sf_dir), scratch(spark, "landing")
    wh, ws = pipeline.Warehouse(scratch(spark, "warehouse")), session_workspace(spark)
    for load in (1, 2, 3):
        if load < 3:
            deliver(layers, "orders", load, landing_dir)
        pipeline.take_in(spark, wh, "orders", landing_dir, pipeline.now_micros(), ws)
    return wh.read(spark, "bronze.orders").select(*SOURCE_COLS, "_source_file")


# ------------------------------------------------------------------ sinks

UPSERT_FROM = "2000-06-01 00:00:00"
TARGET_BEFORE = "2001-01-01 00:00:00"
ORDERS_PARTITIONED = schemas.ddl(
    "order_line_id string, invoice_no string, stock_code string, quantity int, "
    "invoice_ts timestamp_ntz, customer_id bigint, transaction_type string, "
    "_source_file string, _row_id bigint, invoice_month date"
)


@query(
    "upsert_orders",
    f"""SELECT order_line_id, CAST(date_trunc('month', invoice_ts) AS DATE) AS invoice_month,
               CASE WHEN invoice_ts >= TIMESTAMP '{UPSERT_FROM}' THEN 'merged:' || _source_file
                    ELSE _source_file END AS _source_file,
               quantity, invoice_ts
        FROM silver_orders""", dates=['invoice_month'], doubles=['quantity']
)
def upsert_orders(spark, sf_dir):
    """Silver orders up to 2000 are in the table; lines from 2000-06 on arrive again
    (overlap: updated, rest: inserted). Only the source's months are rewritten."""
    silver = Layers(spark, sf_dir).stored_silver_orders.drop("_ingested_at")
    month_name, month = sinks.month_partition("invoice_ts")
    silver = silver.withColumn(month_name, month)
    ts = F.col("invoice_ts")
    target = silver.filter(ts < F.lit(TARGET_BEFORE).cast(NTZ))
    source = silver.filter(ts >= F.lit(UPSERT_FROM).cast(NTZ)).withColumn(
        "_source_file", F.concat(F.lit("merged:"), "_source_file")
    )
    path = scratch(spark, "silver_orders")
    sinks.append(target, path, [month_name])
    sinks.upsert(spark, source, path, ORDERS_PARTITIONED, ["order_line_id"], month_name, stored=True)
    table = sinks.read_table(spark, path, ORDERS_PARTITIONED)
    return table.select("order_line_id", month_name, "_source_file", "quantity", "invoice_ts")


@query(
    "upsert_customers",
    "SELECT customer_id, country, countries, _source_file FROM silver_customers", doubles=['customer_id']
)
def upsert_customers(spark, sf_dir):
    """Customers of load 1 are in the table; load 2 is merged in on customer_id."""
    layers = Layers(spark, sf_dir)
    bronze = layers.bronze("customers")
    silver_schema = schemas.SILVER_CUSTOMERS

    def load(load_file):
        cleaned = clean.clean_customers(bronze.filter(F.col("_source_file") == load_file))
        return published(evaluate(cleaned, rules.SILVER_CUSTOMERS))

    path = scratch(spark, "silver_customers")
    load("customers_1.csv").write.parquet(path)
    sinks.upsert(spark, load("customers_2.csv"), path, silver_schema, ["customer_id"])
    return sinks.read_table(spark, path, silver_schema).select(
        "customer_id", "country", "countries", "_source_file"
    )


FACT_PARTITIONED = schemas.ddl(
    "order_line_id string, invoice_no string, invoice_ts timestamp_ntz, customer_id bigint, "
    "product_key bigint, quantity int, unit_price decimal(10,2), line_amount decimal(18,2), "
    "transaction_type string, is_revenue boolean, invoice_month date"
)


@query(
    "fact_month_slice",
    """SELECT order_line_id, invoice_ts, line_amount,
              CAST(date_trunc('month', invoice_ts) AS DATE) AS invoice_month
       FROM fact_sales WHERE CAST(date_trunc('month', invoice_ts) AS TIMESTAMP) = (SELECT ms FROM last_month)""", money=['line_amount'], dates=['invoice_month']
)
def fact_month_slice(spark, sf_dir):
    """fact_sales stored partitioned by month; readers of one month prune the rest."""
    layers = Layers(spark, sf_dir).share_lines()
    month_name, month = sinks.month_partition("invoice_ts")
    path = scratch(spark, "fact_sales")
    fact = layers.fact_sales_with_text.withColumn(month_name, month)
    sinks.replace(
        fact, path, [month_name], ["invoice_no", "stock_code", clean.LINE_TEXT],
        lambda rows: clean.with_key(rows).select(*FACT_PARTITIONED.names),
    )
    table = sinks.read_table(spark, path, FACT_PARTITIONED)
    newest = table.select(F.max(month_name)).scalar()
    return table.filter(F.col(month_name) == newest).select(
        "order_line_id", "invoice_ts", "line_amount", month_name
    )


LATE_FILE = "orders_2 late.csv"


@query(
    "ingest_incremental",
    f"""SELECT invoice_no, stock_code, quantity, invoice_date, customer_id,
               replace(_source_file, 'orders_2.csv', '{LATE_FILE}') AS _source_file FROM raw_orders""",
)
def ingest_incremental(spark, sf_dir):
    """Two deliveries, three runs of the availableNow stream: each file is read once. The second
    delivery has a space in its name and files that are a month older than the first ones."""
    layers, landing_dir = Layers(spark, sf_dir), scratch(spark, "landing")
    bronze_path, checkpoint = scratch(spark, "bronze_orders"), scratch(spark, "stream_bronze_orders")

    def ingest():
        ingest_available(spark, landing_dir, "orders_", schemas.BRONZE_ORDERS, bronze_path, checkpoint, 2)

    deliver(layers, "orders", 1, landing_dir)
    ingest()
    deliver(layers, "orders", 2, landing_dir, LATE_FILE)
    month_ago = (pipeline.now_micros() // 1000) - 30 * 24 * 3600 * 1000
    for name in child_names(spark, f"{landing_dir}/{LATE_FILE}"):
        fs, path = fs_path(spark, f"{landing_dir}/{LATE_FILE}/{name}")
        fs.setTimes(path, month_ago, month_ago)
    ingest()
    ingest()
    return read_bronze(spark, bronze_path, schemas.BRONZE_ORDERS).select(*SOURCE_COLS, "_source_file")


@query(
    "price_versions_of_parts",
    "SELECT stock_code, version, description_raw, unit_price FROM prod_versions",
    money=["unit_price"],
)
def price_versions_of_parts(spark, sf_dir):
    """The products snapshot delivered as a folder of very unequal part files: versions follow the
    order of the parts, not the order in which Spark reads them."""
    snap = clean.latest_snapshot(Layers(spark, sf_dir).bronze("products"))
    landing_dir, row = scratch(spark, "landing"), F.col("_row_id")
    most = snap.select(F.max("_row_id")).scalar()
    thirds = {"a": row < most * 0.05, "b": (row >= most * 0.05) & (row < most * 0.2), "c": row >= most * 0.2}
    for part, rows in thirds.items():
        pieces = {"a": 3, "b": 1, "c": 2}[part]
        ordered = snap.filter(rows).repartitionByRange(pieces, "_row_id").sortWithinPartitions("_row_id")
        landing.write_delivery(ordered.select(*source_columns("products")), f"{landing_dir}/products_2.csv", part)
    delivered = landing.read_landing(spark, landing_dir, "products_", schemas.BRONZE_PRODUCTS)
    return clean.price_versions(delivered).select("stock_code", "version", "description_raw", "unit_price")


@query(
    "pipeline_recovers",
    f"SELECT {cols(FACT_COLS)} FROM fact_sales",
    money=["unit_price", "line_amount"],
    doubles=["customer_id", "quantity"],
)
def pipeline_recovers(spark, sf_dir):
    """The stored fact after runs that failed: run 1 loses silver customers; run 2, with
    new prices, customers and lines, loses the fact after it is stored; run 3 makes up for it."""
    layers, landing_dir = Layers(spark, sf_dir), scratch(spark, "landing")
    wh = pipeline.Warehouse(scratch(spark, "warehouse"))

    def attempt(run_id, step=None, phase="start"):
        def fail_at(name, at):
            if (name, at) == (step, phase):
                raise RuntimeError(f"planned failure of {name}")

        try:
            pipeline.run_pipeline(spark, wh.root, landing_dir, run_id, fail_at)
        except RuntimeError:
            if step is None:
                raise

    price = F.col("unit_price").cast("decimal(10,2)")
    dearer = F.when(price == 0, F.col("unit_price")).otherwise((price + 1).cast("decimal(10,2)").cast("string"))
    before = Layers(spark, bronze={
        "products": layers.bronze("products").filter(F.col("_source_file") == "products_2.csv")
        .withColumn("unit_price", dearer).withColumn("_source_file", F.lit("products_1.csv"))
    })
    with shuffles_removed(spark):
        deliver(before, "products", 1, landing_dir)
        deliver(layers, "customers", 1, landing_dir)
        deliver(layers, "orders", 1, landing_dir)
        attempt("run-1", "silver.customers")
        for feed in pipeline.FEEDS:
            deliver(layers, feed, 2, landing_dir)
        attempt("run-2", "gold.fact_sales", "stored")
        attempt("run-3")
    return wh.read(spark, "gold.fact_sales").select(*FACT_COLS)


@query(
    "stream_silver_orders",
    f"SELECT {cols(SILVER_ORDER_COLS[:-1])} FROM silver_orders", doubles=['customer_id', 'quantity']
)
def stream_silver_orders(spark, sf_dir):
    """Two deliveries streamed (availableNow, one run each) into silver orders:
    the replayed lines of the second delivery replace their first copies."""
    layers = Layers(spark, sf_dir)
    landing_dir = scratch(spark, "landing")
    bronze_path = scratch(spark, "bronze_orders")
    silver_path = scratch(spark, "silver_orders")
    checkpoint = scratch(spark, "silver_orders")
    for load in (1, 2):
        with shuffles_removed(spark):
            deliver_orders(spark, layers, landing_dir, load)
        stream_orders_to_silver(spark, landing_dir, bronze_path, silver_path, checkpoint)
    silver = sinks.read_table(spark, silver_path, SILVER_ORDERS_BY_MONTH)
    return silver.select(*SILVER_ORDER_COLS[:-1])


@query(
    "product_key_uniqueness",
    "SELECT CAST(count(*) AS BIGINT) AS versions, CAST(count(*) AS BIGINT) AS distinct_keys FROM dim_product",
)
def product_key_uniqueness(spark, sf_dir):
    dim = Layers(spark, sf_dir).dim_product
    return dim.agg(
        F.count(F.lit(1)).alias("versions"), F.count_distinct("product_key").alias("distinct_keys")
    )


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
