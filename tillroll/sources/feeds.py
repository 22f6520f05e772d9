"""Raw retail feeds derived from the driver tables.

The analytics work on three delivered feeds (customers, products, orders), all
text, with the dirt real deliveries carry: padded and lower-case codes, notes
instead of names, blank names, zero prices, day-first dates, missing customers,
fees, cancellations, adjustments, replayed lines, several countries per customer
and a second delivery (load) of some feeds.

The feeds are a deterministic function of every row of ``customer``/``nation``,
``part`` and ``lineitem``/``orders``: each source row becomes one or more feed
rows. The ``%`` tests below decide *which kind of dirt* a row carries; they never
drop rows. Every feed has the bronze layout: source columns as strings plus
``_source_file``, ``_row_id`` and ``_ingested_at``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import pieces_of
from tillroll.sources.tables import stored_bytes, table

# Parquet bytes of lineitem and orders for a partition of their join (some 350,000 lines).
PIECE_BYTES = 4 << 20

# Stock codes of parts 0..9 (the non-merchandise codes of the feed).
SPECIAL_CODES = ["POST", "DOT", "C2", "D", "M", "BANK CHARGES", "AMAZONFEE", "CRUK", "B", "S"]
# Country spellings the source uses for nation keys 0..4.
SOURCE_COUNTRY_BY_NATION = [" EIRE ", "RSA", "USA", "Unspecified", "European Community"]

LOAD_TS = {1: "2024-01-01 00:00:00", 2: "2024-01-02 00:00:00"}


def files(spark: SparkSession, feed: str) -> DataFrame:
    """The delivered files of a feed, one per load (literal rows, whose size Catalyst knows)."""
    return spark.sql("SELECT explode(:names) AS _source_file", {"names": F.array(*[F.lit(f"{feed}_{load}.csv") for load in LOAD_TS])})


def load_ts(load: Column | int) -> Column:
    """Deterministic ingestion time of a load (one instant per load)."""
    load = F.lit(load) if isinstance(load, int) else load
    return F.when(load == 1, F.lit(LOAD_TS[1])).otherwise(F.lit(LOAD_TS[2])).cast("timestamp")


def product_code(partkey: Column) -> Column:
    """Stock code of a part: special codes, one gift voucher, else ``SKU<key>a``."""
    special = F.array(*[F.lit(c) for c in SPECIAL_CODES])
    return (
        F.when(partkey < len(SPECIAL_CODES), F.try_element_at(special, (partkey + 1).cast("int")))
        .when(partkey == 10, F.lit("gift_0001_10"))
        .otherwise(F.concat(F.lit("SKU"), partkey.cast("string"), F.lit("a")))
    )


def us_datetime_text(ts: Column) -> Column:
    """``M/d/yyyy H:mm`` text of a TIMESTAMP_NTZ, built from its fields (no
    time-zone conversion, unlike ``date_format``)."""
    return F.concat(
        F.month(ts).cast("string"), F.lit("/"), F.dayofmonth(ts).cast("string"), F.lit("/"),
        F.year(ts).cast("string"), F.lit(" "), F.hour(ts).cast("string"), F.lit(":"),
        F.lpad(F.minute(ts).cast("string"), 2, "0"),
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customers feed: one row per customer in load 1, a second-country row for some
    customers in load 1, and a moved-country row for others in load 2."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    key, nk = F.col("c_custkey"), F.col("c_nationkey")

    def branch(kind: int, load: int, name_key: Column, row_id: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            F.lit(load).alias("load"),
            name_key.cast("int").alias("name_key"),
            row_id.cast("long").alias("_row_id"),
        )

    branches = F.array(
        branch(0, 1, nk, key),
        F.when(key % 50 == 3, branch(1, 1, (nk + 5) % 25, F.lit(1_000_000_000) + key)),
        F.when(key % 10 == 1, branch(2, 2, (nk + 7) % 25, key)),
    )
    rows = c.select("c_custkey", "c_nationkey", F.inline(F.filter(branches, lambda b: b.isNotNull())))
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("name_key"), "n_name"
    )
    # nation is the fixed 25-row dimension; Catalyst broadcasts it from its file size.
    rows = rows.join(nation, "name_key", "left")

    text_key = key.cast("string")
    main = F.col("kind") == 0
    source_country = F.try_element_at(
        F.array(*[F.lit(s) for s in SOURCE_COUNTRY_BY_NATION]), (nk + 1).cast("int")
    )
    customer_id = (
        F.when(main & (key % 101 == 0), F.lit(None).cast("string"))
        .when(main & (key % 7 == 0), F.concat(F.lit(" "), text_key, F.lit("  ")))
        .otherwise(text_key)
    )
    country = F.when(main & (nk < len(SOURCE_COUNTRY_BY_NATION)), source_country).otherwise(
        F.col("n_name")
    )
    return rows.select(
        customer_id.alias("customer_id"),
        country.alias("country"),
        F.concat(F.lit("customers_"), F.col("load").cast("string"), F.lit(".csv")).alias(
            "_source_file"
        ),
        F.lit("").alias("_source_part"),  # a plain file
        F.col("_row_id"),
        load_ts(F.col("load")).alias("_ingested_at"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """products feed: load 2 is the full snapshot, each part listed with 1-4 price rows
    (top row = current price); load 1 is an older snapshot for every fifth part."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    pk = F.col("p_partkey")
    # n = -1 is the part's row in the old snapshot (load 1); n >= 0 its rows in load 2.
    first_n = F.when(pk % 5 == 0, F.lit(-1)).otherwise(F.lit(0)).cast("long")
    rows = p.select("p_partkey", "p_name", F.explode(F.sequence(first_n, pk % 4)).alias("n"))
    n = F.col("n")
    old = n < 0
    code = product_code(pk)
    stock_code = F.when(~old & (n % 2 == 1), F.lower(code)).otherwise(code)
    description = (
        F.when(old, F.lit("OLD NAME"))
        .when((pk % 83 == 0) & (pk > 20), F.lit("Gift Voucher "))
        .when(n == pk % 3, F.concat(F.lit(" "), F.upper("p_name"), F.lit(" ")))
        .when(n == 1, F.lit("damaged"))
        .when(n == 2, F.lit("   "))
        .otherwise(F.col("p_name"))
    )
    cents = (pk * 37 + n * (pk % 89) * 5 + n * 13) % 500
    unit_price = F.when(old, F.lit("9.99")).otherwise(
        (cents.cast("decimal(12,0)") / 100).cast("decimal(10,2)").cast("string")
    )
    load = F.when(old, F.lit(1)).otherwise(F.lit(2))
    return rows.select(
        stock_code.alias("stock_code"),
        description.alias("description"),
        unit_price.alias("unit_price"),
        F.concat(F.lit("products_"), load.cast("string"), F.lit(".csv")).alias("_source_file"),
        F.lit("").alias("_source_part"),  # a plain file
        (pk * 10 + F.greatest(n, F.lit(0))).alias("_row_id"),
        load_ts(load).alias("_ingested_at"),
    )


def order_pieces(spark: SparkSession, sf_dir: str) -> int | None:
    """Partitions for exchanges of the orders feed: one for each PIECE_BYTES of its tables, so that what a
    task holds does not grow with them; None for small tables, where Spark's own number does."""
    return pieces_of(spark, stored_bytes(spark, sf_dir, "lineitem", "orders"), PIECE_BYTES)


def replayed(orderkey: Column | str) -> Column:
    """Whether the lines of an order are delivered again in load 2."""
    return (F.col(orderkey) if isinstance(orderkey, str) else orderkey) % 100 == 7


def raw_orders(spark: SparkSession, sf_dir: str, load: int | None = None) -> DataFrame:
    """orders feed: one row per line item (load 1); lines of every hundredth order
    (key % 100 = 7) are replayed in load 2. With ``load`` only the rows of that load are made."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.col("l_quantity").cast("long").alias("qty"),
        ((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")).alias("returned"),
    )
    # Per-order text is built once per order (a quarter of the lines), before the join.
    ok_o = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(ok_o % 503 == 0, F.lit("15/5/2011 14:48"))
        .otherwise(us_datetime_text(F.col("o_orderdate")))
        .alias("invoice_date"),
        F.when(F.col("o_custkey") % 4 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("customer_id"),
    )
    # orders is a fact table (a quarter of lineitem), not a dimension: co-partition
    # both sides by order key (sort-merge join, spills, AQE splits skewed keys) rather
    # than broadcasting it. This also spreads the per-line work below over the
    # shuffle partitions instead of the scan's few input splits. Large tables get a partition for
    # each PIECE_BYTES of them: what a task sorts and aggregates does not grow with the tables.
    pieces = order_pieces(spark, sf_dir)
    if load == 2:
        li, o = li.filter(replayed("l_orderkey")), o.filter(replayed("o_orderkey"))
    if pieces:
        li, o = li.repartition(pieces, "l_orderkey"), o.repartition(pieces, "o_orderkey")
    lines = li.join(o.hint("merge"), li["l_orderkey"] == o["o_orderkey"])
    ok = F.col("l_orderkey")
    copies = F.sequence(F.lit(1), F.when(replayed(ok), F.lit(2)).otherwise(F.lit(1)))
    lines = lines.select("*", (F.explode(copies) if load is None else F.lit(load)).alias("load"))

    code = product_code(F.col("l_partkey"))
    returned, qty = F.col("returned"), F.col("qty")
    invoice_no = (
        F.when(returned, F.concat(F.lit("C"), ok.cast("string")))
        .when(ok % 499 == 0, F.concat(F.lit("A"), ok.cast("string")))
        .otherwise(ok.cast("string"))
    )
    stock_code = F.when(F.col("l_linenumber") % 3 == 0, F.lower(code)).otherwise(
        F.concat(code, F.lit(" "))
    )
    quantity = (
        F.when(ok % 331 == 0, F.lit("0"))
        .when(returned | (ok % 41 == 0), (-qty).cast("string"))
        .otherwise(qty.cast("string"))
    )
    return lines.select(
        invoice_no.alias("invoice_no"),
        stock_code.alias("stock_code"),
        quantity.alias("quantity"),
        "invoice_date",
        "customer_id",
        F.concat(F.lit("orders_"), F.col("load").cast("string"), F.lit(".csv")).alias(
            "_source_file"
        ),
        F.lit("").alias("_source_part"),  # a plain file
        (ok * 100 + F.col("l_linenumber") * 2 + F.col("load")).alias("_row_id"),
        load_ts(F.col("load")).alias("_ingested_at"),
    )


FEEDS = {"customers": raw_customers, "products": raw_products, "orders": raw_orders}
