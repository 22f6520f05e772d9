"""Silver: typed, cleaned, one row per key (before the quality rules are applied).

Each function maps a bronze DataFrame (source text + lineage) to the declared
silver schema. Apply ``operators.quality.evaluate`` + ``published`` to publish.

Scale notes
- customers: the country set is built by aggregation per (customer, load) with
  ``collect_set`` (map-side partial aggregation, bounded by the number of
  countries), then the newest load per customer with ``max_by``. A customer with
  a third of all rows is collapsed before any shuffle.
- orders: replayed lines collapse with ``newest_copies`` (hash aggregation, partial
  on the map side), not a window.
- products: positions inside a stock code's history come from
  ``position_in_group`` (bounded chunks + offsets), names from partial ``min``
  aggregates, so even a stock code with a third of all rows is spread out.
- "newest load" filters compare with a scalar subquery (one-row aggregate),
  never a driver round trip.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.keys import content_hash, joined_text
from tillroll.functions.text import (
    blank_to_null,
    is_name_case,
    lenient_decimal,
    lenient_integer,
    lenient_us_timestamp,
    normalise_code,
    recode,
)
from tillroll.operators.dedup import LINEAGE, line_columns, line_groups, newest_copies, numbered
from tillroll.operators.ranking import chunk_of, position_in_group
from tillroll.operators.schema import conform
from tillroll.plans import schemas

# Source country spellings and their standard names.
COUNTRY_NAMES = {
    "EIRE": "Ireland",
    "RSA": "South Africa",
    "USA": "United States",
    "Unspecified": "Unknown",
}
MULTIPLE = "Multiple"

# Product type of the stock codes that are not merchandise.
PRODUCT_TYPE_BY_CODE = {
    "POST": "SHIPPING",
    "DOT": "SHIPPING",
    "C2": "SHIPPING",
    "D": "ADJUSTMENT",
    "M": "ADJUSTMENT",
    "BANK CHARGES": "NON_REVENUE",
    "AMAZONFEE": "NON_REVENUE",
    "CRUK": "NON_REVENUE",
    "B": "NON_REVENUE",
    "S": "NON_REVENUE",
}
MERCHANDISE = "MERCHANDISE"
NON_REVENUE = "NON_REVENUE"
VOUCHER_CODE_PREFIX = "GIFT_"
VOUCHER_TEXT = "GIFT VOUCHER"

SALE, CANCELLATION, ADJUSTMENT = "SALE", "CANCELLATION", "ADJUSTMENT"

FILE_ORDER = ["_source_file", "_source_part", "_row_id"]


# ---------------------------------------------------------------- customers


def typed_customers(bronze: DataFrame) -> DataFrame:
    """customer_id as bigint, country trimmed and recoded to its standard name."""
    return bronze.select(
        lenient_integer("customer_id", "bigint").alias("customer_id"),
        recode(F.trim("country"), COUNTRY_NAMES).alias("country"),
        *LINEAGE,
    )


def customer_countries_per_load(typed: DataFrame) -> DataFrame:
    """(customer_id, _ingested_at) -> the set of countries listed in that load."""
    return (
        typed.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "_ingested_at")
        .agg(
            F.collect_set("country").alias("country_set"),
            F.min("_source_file").alias("_source_file"),
            F.min("_row_id").alias("_row_id"),
        )
    )


def newest_load_per_customer(typed: DataFrame) -> DataFrame:
    """Only the customer's newest load counts: its country set and lineage."""
    newest = F.max_by(
        F.struct("country_set", "_source_file", "_row_id", "_ingested_at"), F.col("_ingested_at")
    )
    return (
        customer_countries_per_load(typed)
        .groupBy("customer_id")
        .agg(newest.alias("_n"))
        .select("customer_id", "_n.*")
    )


def clean_customers(bronze: DataFrame) -> DataFrame:
    """One row per customer: its country, or ``Multiple`` when its newest load lists
    several; NULL-id rows of the newest NULL-id load pass one by one (quarantined)."""
    typed = typed_customers(bronze)
    known = newest_load_per_customer(typed).withColumn("listed", F.array_sort("country_set")).selectExpr(
        "customer_id",
        f"CASE size(listed) WHEN 0 THEN NULL WHEN 1 THEN listed[0] ELSE '{MULTIPLE}' END AS country",
        "nullif(array_join(listed, ', '), '') AS countries",
        *LINEAGE,
    )
    nameless = typed.where("customer_id IS NULL")
    newest = nameless.agg(F.max("_ingested_at")).scalar()
    unknown = nameless.where(F.col("_ingested_at") == newest).withColumn("countries", F.col("country"))
    return conform(known.unionByName(unknown), schemas.SILVER_CUSTOMERS)


# ---------------------------------------------------------------- products


def latest_snapshot(bronze: DataFrame) -> DataFrame:
    """Each products delivery is a full snapshot: keep the newest load only."""
    newest = bronze.select(F.max("_ingested_at")).scalar()
    return bronze.filter(F.col("_ingested_at") == newest)


def product_type(stock_code: Column, name: Column) -> Column:
    """Exact code > gift voucher (code prefix or name) > merchandise."""
    voucher = stock_code.startswith(VOUCHER_CODE_PREFIX) | F.upper(name).contains(VOUCHER_TEXT)
    by_code = recode(stock_code, PRODUCT_TYPE_BY_CODE, fallback=F.lit(None).cast("string"))
    return F.coalesce(by_code, F.when(voucher, F.lit(NON_REVENUE)), F.lit(MERCHANDISE))


def price_versions(snapshot: DataFrame) -> DataFrame:
    """Number each stock code's rows bottom-up (bottom = version 1 = oldest price)
    and resolve the product name: the first row from the top written in capitals,
    else the first non-blank row.

    File order is ``(_source_file, _source_part, _row_id)``. Positions come from
    ``position_in_group`` (bounded chunks, no window over a whole stock code); the
    two "first from the top" names are ``min`` aggregates of (order, text) structs,
    partial per chunk, then over the code's chunk rows.
    """
    rows = snapshot.select(
        normalise_code("stock_code").alias("stock_code"),
        blank_to_null("description").alias("description_raw"),
        lenient_decimal("unit_price", 10, 2).alias("unit_price"),
        *FILE_ORDER,
        "_ingested_at",
    )
    raw = F.col("description_raw")

    def first_from_top(cond: Column) -> Column:
        return F.min(F.when(cond, F.struct(*FILE_ORDER, raw.alias("text"))))

    ranked = position_in_group(
        rows,
        keys=["stock_code"],
        order=FILE_ORDER,
        chunk=[F.col("_source_file"), F.col("_source_part"), chunk_of(F.col("_row_id"))],
        chunk_aggs=[
            ("_chunk_name", first_from_top(is_name_case(raw))),
            ("_chunk_text", first_from_top(raw.isNotNull())),
        ],
        group_aggs=[("_name", F.min("_chunk_name")), ("_text", F.min("_chunk_text"))],
    )
    return ranked.select(
        *rows.columns,
        (F.col("_group_size") - F.col("_position") + 1).cast("int").alias("version"),
        F.coalesce(F.col("_name.text"), F.col("_text.text")).alias("description"),
    )


def clean_products(bronze: DataFrame) -> DataFrame:
    """One row per (stock_code, version) of the newest snapshot, with its type."""
    versions = price_versions(latest_snapshot(bronze))
    typed = versions.withColumn(
        "product_type", product_type(F.col("stock_code"), F.col("description"))
    )
    return conform(typed, schemas.SILVER_PRODUCTS)


# ---------------------------------------------------------------- orders


def transaction_type(invoice_no: Column, quantity: Column) -> Column:
    """``C`` invoices cancel; ``A`` invoices and negative quantities adjust stock."""
    return (
        F.when(invoice_no.startswith("C"), F.lit(CANCELLATION))
        .when(invoice_no.startswith("A") | (quantity < 0), F.lit(ADJUSTMENT))
        .otherwise(F.lit(SALE))
    )


#: The texts of a line (quantity, date, customer) that its key hashes after invoice and stock code.
LINE_TEXT = "_line_text"


def line_key(of: Callable[[str], Column] = F.col) -> Column:
    """The content hash of a line that still has its text; ``of`` names its columns."""
    return content_hash(of("invoice_no"), of("stock_code"), of(LINE_TEXT))


def with_key(lines: DataFrame) -> DataFrame:
    """Lines with their text, and with ``order_line_id`` and the transaction type, which follow from the
    rest and are made where no more rows have to be exchanged."""
    return lines.withColumns({"order_line_id": line_key(), "transaction_type": transaction_type(F.col("invoice_no"), F.col("quantity"))})


def keyed(lines: DataFrame) -> DataFrame:
    """Lines with their key and type, and without their text."""
    return with_key(lines).drop(LINE_TEXT)


def typed_lines(bronze: DataFrame) -> DataFrame:
    """Every delivered line, normalised and typed, keyed by its content hash.

    The key hashes the normalised *text* of the five fields, so a replayed line has
    the same key (and the same invoice month) as the original.
    """
    return keyed(lines_with_text(bronze)).select(
        "order_line_id", "invoice_no", "stock_code", "quantity", "invoice_ts", "customer_id",
        "transaction_type", *LINEAGE, "_source_part",
    )


def lines_with_text(bronze: DataFrame, pieces: int | None = None) -> DataFrame:
    """``typed_lines`` with the text that is hashed in place of the hash: a third as long to exchange, and the
    same lines are equal (invoice and stock code stand beside it, so the text is the same if and only if
    the hash is). With ``pieces`` the texts go to so many partitions by invoice and stock code before they are
    parsed, in place of an exchange by the session's number after each task has grouped its own lines: for
    feeds that deliver a line, and an invoice's lines of a stock code, a bounded number of times."""
    texts = bronze.select(
        normalise_code("invoice_no").alias("invoice_no"),
        normalise_code("stock_code").alias("stock_code"),
        F.trim("quantity").alias("_quantity"),
        F.trim("invoice_date").alias("_date"),
        F.trim("customer_id").alias("_customer"),
        *LINEAGE,
        "_source_part",
    )
    if pieces:
        texts = texts.repartition(pieces, "invoice_no", "stock_code")
    quantity_text, date_text, customer_text = F.col("_quantity"), F.col("_date"), F.col("_customer")
    return texts.select(
        joined_text(quantity_text, date_text, customer_text).alias(LINE_TEXT),
        "invoice_no",
        "stock_code",
        lenient_integer(quantity_text, "int").alias("quantity"),
        lenient_us_timestamp(date_text).alias("invoice_ts"),
        lenient_integer(customer_text, "bigint").alias("customer_id"),
        *LINEAGE,
        "_source_part",
    )


#: What is parsed from a line's text.
PARSED = ("quantity", "invoice_ts", "customer_id")


def same_parts() -> Column:
    """Equal texts are of equal parts unless a part holds the ``|`` between them: then what was parsed is
    told apart as well."""
    return F.when(F.col(LINE_TEXT).like("%|%|%|%"), F.struct(*PARSED))


def newest_lines(bronze: DataFrame, files: DataFrame | None = None, pieces: int | None = None) -> DataFrame:
    """``clean_orders`` with the text that is hashed in place of what follows from it, key and type."""
    return newest_copies(lines_with_text(bronze, pieces), files, PARSED, same_parts())


def clean_orders(bronze: DataFrame, files: DataFrame | None = None, pieces: int | None = None) -> DataFrame:
    """One row per distinct line: the newest delivery (load, then row) wins. ``files`` lists the
    delivered files (_source_file) where a list of them is at hand."""
    return conform(keyed(newest_lines(bronze, files, pieces)), schemas.SILVER_ORDERS)


#: Ranges of a month's lines: an invoice's lines lie together, and a month with a third of all rows is many ranges.
MONTH_ORDER = ("invoice_no", "stock_code")


def orders_by_month(bronze: DataFrame, month: str, files: DataFrame | None = None, pieces: int | None = None) -> DataFrame:
    """``clean_orders`` with its invoice month as ``month``, in ranges of (month, MONTH_ORDER): one exchange puts
    equal lines together and the lines of a month in few tasks, as a table by month is written. In place
    of names and hashes it carries numbers and texts. Equal lines meet in one task, which keeps one row of them; with
    ``pieces`` there are so many ranges, so that what a task holds does not grow with the lines."""
    lines = lines_with_text(bronze).withColumn(month, F.trunc(F.to_date("invoice_ts"), "MM"))
    ranges = [month, *MONTH_ORDER, LINE_TEXT]
    lines = lines if files is None else numbered(lines)
    laid = lines.repartitionByRange(pieces, *ranges) if pieces else lines.repartitionByRange(*ranges)
    return conform(keyed(newest_copies(laid, files, PARSED, same_parts())), schemas.with_column(schemas.SILVER_ORDERS, month, "date"))


def order_lines(bronze: DataFrame, pieces: int | None = None) -> DataFrame:
    """``clean_orders`` without lineage, for readers that don't ask where a line came from: equal
    lines are one. The text that is hashed stays beside the key, for readers that exchange the lines
    again: they make the key at the end (``line_key``)."""
    lines = lines_with_text(bronze, pieces)
    columns = line_columns(lines)
    groups, followers = line_groups(lines.select(*columns), PARSED, same_parts())
    return with_key(groups.agg(*followers).select(*columns))
