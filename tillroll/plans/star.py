"""Gold star schema: dim_customer (SCD1), dim_product (SCD2), fact_sales.

Price history dating (the products feed has no dates): the current price of a
stock code is valid from the month of the latest order, each older price one
month earlier, the oldest one from the beginning of time. Validity is half-open
``[valid_from, valid_to)``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.keys import packed_hex, surrogate_key
from tillroll.operators.asof import asof_join
from tillroll.operators.ranking import chunk_of, position_in_group
from tillroll.operators.schema import conform
from tillroll.plans import schemas
from tillroll.plans.clean import CANCELLATION, LINE_TEXT, NON_REVENUE, SALE, transaction_type, with_key

# The open ends of every validity interval.
BEGINNING_OF_TIME = "1900-01-01 00:00:00"
END_OF_TIME = "9999-12-31 00:00:00"
REVENUE_TRANSACTION_TYPES = (SALE, CANCELLATION)


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def month_of(ts: Column) -> Column:
    """First day (DATE) of the month of a TIMESTAMP_NTZ, time-zone free."""
    return F.trunc(F.to_date(ts), "MM")


def latest_month(df: DataFrame, ts: str) -> Column:
    """Scalar subquery: first day (DATE) of the month of ``max(ts)``."""
    return df.select(month_of(F.max(ts))).scalar()


def dim_customer(silver_customers: DataFrame) -> DataFrame:
    """One row per customer with its latest country; lineage dropped."""
    return conform(silver_customers, schemas.DIM_CUSTOMER)


def scd2_validity(position: Column, versions: Column, anchor: Column) -> tuple[Column, Column]:
    """(valid_from, valid_to) of version ``position`` of ``versions``.

    Version p starts ``versions - p`` months before the anchor month (p = 1 at the
    beginning of time) and ends where version p + 1 starts (the last one never).
    With no anchor (no dated orders) every version but the first has no start.
    """
    start = F.when(position == 1, ntz(BEGINNING_OF_TIME)).otherwise(
        F.add_months(anchor, (position - versions).cast("int")).cast("timestamp_ntz")
    )
    next_start = F.add_months(anchor, (position + 1 - versions).cast("int")).cast("timestamp_ntz")
    end = F.coalesce(F.when(position < versions, next_start), ntz(END_OF_TIME))
    return start, end


def dim_product(silver_products: DataFrame, silver_orders: DataFrame) -> DataFrame:
    """One row per published price version with its validity period.

    Versions are re-ranked by position (quarantined versions leave gaps in the
    silver version numbers). The anchor month comes from the published orders.
    """
    anchor = latest_month(silver_orders, "invoice_ts")
    ranked = position_in_group(
        silver_products,
        keys=["stock_code"],
        order=["version"],
        chunk=[chunk_of(F.col("version"))],
    )
    valid_from, valid_to = scd2_validity(F.col("_position"), F.col("_group_size"), anchor)
    dated = (
        ranked.withColumn("product_key", surrogate_key("stock_code", "version"))
        .withColumn("valid_from", valid_from)
        .withColumn("valid_to", valid_to)
        .withColumn("is_current", F.col("valid_to") == ntz(END_OF_TIME))
    )
    return conform(dated, schemas.DIM_PRODUCT)


def is_revenue(transaction_type: Column, product_type: Column) -> Column:
    """Sales and cancellations of anything but fees, bad debt, samples, vouchers."""
    return transaction_type.isin(*REVENUE_TRANSACTION_TYPES) & (product_type != NON_REVENUE)


def _priced(
    lines: DataFrame, dim_product_df: DataFrame, kind: Callable[[Callable], Column], *more: str, pieces: int | None = None
) -> DataFrame:
    """``lines`` with the version valid at invoice time; ``kind`` is their transaction type."""
    joined = asof_join(lines, dim_product_df, "stock_code", "invoice_ts", pieces=pieces)
    f, v = (lambda c: F.col(f"f.{c}")), (lambda c: F.col(f"v.{c}"))
    return joined.select(
        *[f(c).alias(c) for c in ("invoice_ts", "customer_id", "quantity", *more)],
        v("product_key").alias("product_key"),
        v("unit_price").alias("unit_price"),
        (f("quantity") * v("unit_price")).try_cast("decimal(18,2)").alias("line_amount"),
        is_revenue(kind(f), v("product_type")).alias("is_revenue"),
    )


def priced_amounts(lines: DataFrame, dim_product_df: DataFrame, pieces: int | None = None) -> DataFrame:
    """The columns of the fact that the marts read and its rules check, of lines without number and key."""
    return _priced(lines, dim_product_df, lambda f: f("transaction_type"), "transaction_type", pieces=pieces)


def priced_lines(lines: DataFrame, dim_product_df: DataFrame, pieces: int | None = None) -> DataFrame:
    """The fact of lines that have their text (``clean.order_lines``), before they get key and type
    (``clean.with_key``): the text is a third as long to exchange as the key."""
    lines = lines.drop("order_line_id", "transaction_type")
    return _priced(lines, dim_product_df, lambda f: transaction_type(f("invoice_no"), f("quantity")), "invoice_no", "stock_code", LINE_TEXT, pieces=pieces)


def fact_sales(
    silver_orders: DataFrame, dim_product_df: DataFrame, pieces: int | None = None, lay_out: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """One row per order line, priced with the version valid at invoice time. ``lay_out`` exchanges the priced
    lines again, of stored lines (without their text) while their keys are packed."""
    if LINE_TEXT in silver_orders.columns:
        return conform(with_key(priced_lines(silver_orders, dim_product_df, pieces)), schemas.FACT_SALES)
    # a key is exchanged as its 32 bytes, any other text as it is
    keys = {"_key": packed_hex("order_line_id"), "order_line_id": F.when(packed_hex("order_line_id").isNull(), F.col("order_line_id"))}
    more = ("invoice_no", "transaction_type", *keys)
    priced = _priced(silver_orders.withColumns(keys), dim_product_df, lambda f: f("transaction_type"), *more, pieces=pieces)
    priced = lay_out(priced) if lay_out else priced
    whole = priced.withColumn("order_line_id", F.coalesce("order_line_id", F.lower(F.hex("_key"))))
    return conform(whole, schemas.FACT_SALES)


def price_at_instant(dim_product_df: DataFrame, instant: Column) -> DataFrame:
    """Each stock code's price version valid just before ``instant``:
    ``valid_from < instant <= valid_to``."""
    return dim_product_df.filter(
        (F.col("valid_from") < instant) & (F.col("valid_to") >= instant)
    )
