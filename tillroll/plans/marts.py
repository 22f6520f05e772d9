"""Gold marts: the four questions.

Every mart aggregates *before* it joins or ranks: fact rows are reduced to one
row per customer / product version with map-side partial aggregation, so the
joins see dimension-sized inputs, NULL or hot keys (a third of all lines without
a customer) collapse to one row per map task, and the global windows (share of
total, dense rank) only ever see the aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.money import avg_half_up, share_pct_half_up
from tillroll.operators.asof import just_before
from tillroll.operators.schema import conform
from tillroll.plans import schemas
from tillroll.plans.clean import CANCELLATION, MERCHANDISE, SALE
from tillroll.plans.star import latest_month

UNKNOWN_COUNTRY = "Unknown"


def customers_per_country(dim_customer_df: DataFrame) -> DataFrame:
    """(country, customers)."""
    return dim_customer_df.groupBy("country").agg(F.count(F.lit(1)).alias("customers"))


def ranked(df: DataFrame, by: str, top: int | None = None) -> DataFrame:
    """Dense rank over the whole (already aggregated) frame, optional top-k with ties."""
    out = df.withColumn("rank", F.dense_rank().over(Window.orderBy(F.desc(by))))
    return out if top is None else out.filter(F.col("rank") <= top)


def top_countries_by_customers(dim_customer_df: DataFrame, top: int = 10) -> DataFrame:
    """Q1: countries with the most customers (dense rank, ties share a rank)."""
    return conform(
        ranked(customers_per_country(dim_customer_df), "customers", top),
        schemas.TOP_COUNTRIES_BY_CUSTOMERS,
    )


def revenue_per_customer(fact: DataFrame) -> DataFrame:
    """(customer_id, revenue) over revenue lines; NULL customer is one group."""
    return (
        fact.filter(F.col("is_revenue"))
        .groupBy("customer_id")
        .agg(F.sum("line_amount").alias("revenue"))
    )


def revenue_per_country(
    fact: DataFrame, dim_customer_df: DataFrame, per_customer: DataFrame | None = None
) -> DataFrame:
    """(country, revenue): missing, unknown and unspecified customers are ``Unknown``.

    ``per_customer`` (customer_id, revenue) replaces the scan of ``fact`` when a
    maintained aggregate is at hand."""
    per_customer = revenue_per_customer(fact) if per_customer is None else per_customer
    per_customer = per_customer.join(
        dim_customer_df.select("customer_id", "country"), "customer_id", "left"
    )
    return per_customer.groupBy(
        F.coalesce("country", F.lit(UNKNOWN_COUNTRY)).alias("country")
    ).agg(F.sum("revenue").cast("decimal(18,2)").alias("revenue"))


def revenue_by_country(
    fact: DataFrame | None, dim_customer_df: DataFrame, per_customer: DataFrame | None = None
) -> DataFrame:
    """Q2: revenue per country, its share of the total (HALF_UP, 2 places), rank."""
    per_country = revenue_per_country(fact, dim_customer_df, per_customer)
    total = F.sum("revenue").over(Window.partitionBy())
    shared = per_country.withColumn("revenue_share_pct", share_pct_half_up(F.col("revenue"), total))
    return conform(ranked(shared, "revenue"), schemas.REVENUE_BY_COUNTRY)


def avg_price_by_product(dim_product_df: DataFrame) -> DataFrame:
    """(stock_code, description, avg_unit_price) over every merchandise version."""
    return (
        dim_product_df.filter(F.col("product_type") == MERCHANDISE)
        .groupBy("stock_code")
        .agg(
            F.max("description").alias("description"),
            avg_half_up("unit_price").cast("decimal(10,2)").alias("avg_unit_price"),
        )
    )


def units_per_version(fact: DataFrame) -> DataFrame:
    """(product_key, units): sales minus cancellations per price version."""
    return (
        fact.filter(F.col("transaction_type").isin(SALE, CANCELLATION))
        .groupBy("product_key")
        .agg(F.sum("quantity").alias("units"))
    )


def units_by_product(
    fact: DataFrame | None, dim_product_df: DataFrame, per_version: DataFrame | None = None
) -> DataFrame:
    """(stock_code, units_sold): sales minus cancellations, any product type."""
    per_version = units_per_version(fact) if per_version is None else per_version
    return (
        per_version.join(dim_product_df.select("product_key", "stock_code"), "product_key")
        .groupBy("stock_code")
        .agg(F.sum("units").alias("units_sold"))
    )


def price_vs_volume(
    fact: DataFrame | None, dim_product_df: DataFrame, per_version: DataFrame | None = None
) -> DataFrame:
    """Q3: average unit price next to units sold, one row per merchandise product."""
    out = avg_price_by_product(dim_product_df).join(
        units_by_product(fact, dim_product_df, per_version), "stock_code", "left"
    )
    return conform(out.fillna(0, ["units_sold"]), schemas.PRICE_VS_VOLUME)


def units_around_median_price(per_product: DataFrame) -> DataFrame:
    """The finding of Q3: products below, at and above the exact median of ``avg_unit_price`` (``percentile``:
    its buffer holds distinct prices, not rows), and the units they sell on average (HALF_UP, 2
    places). ``per_product`` is ``price_vs_volume``; the median is a scalar subquery over it."""
    median = per_product.agg(F.percentile("avg_unit_price", F.lit(0.5)).alias("m")).scalar()
    price = F.col("avg_unit_price").cast("double")
    side = F.when(price < median, "below").when(price > median, "above").otherwise("median")
    groups = per_product.filter("avg_unit_price IS NOT NULL").groupBy(side.alias("side")).agg(
        F.count(F.lit(1)).alias("products"),
        F.sum("units_sold").alias("units"),
        avg_half_up(F.col("units_sold").cast("decimal(18,2)")).alias("avg_units"),
    )
    return groups.withColumn("median_price", median)


def price_drops(fact: DataFrame, dim_product_df: DataFrame, ts: str = "invoice_ts") -> DataFrame:
    """Per merchandise product: price just before the last month and at its end.

    ``fact`` only provides the latest ``ts`` (any frame with that column will do,
    e.g. a monthly aggregate carrying each month's latest invoice time). One pass
    over the versions with conditional aggregates (validity intervals of a
    product never overlap, so each condition matches at most one version).
    """
    month = latest_month(fact, ts)
    start = month.cast("timestamp_ntz")
    end = F.add_months(month, 1).cast("timestamp_ntz")
    before = just_before(start, F.col("valid_from"), F.col("valid_to"))
    after = just_before(end, F.col("valid_from"), F.col("valid_to"))
    per_code = (
        dim_product_df.filter(F.col("product_type") == MERCHANDISE)
        .groupBy("stock_code")
        .agg(
            F.count_if(before).alias("_n_before"),
            F.count_if(after).alias("_n_after"),
            F.max(F.when(before, F.col("unit_price"))).alias("price_before"),
            F.max(F.when(after, F.col("unit_price"))).alias("price_after"),
            F.max(F.when(after, F.col("description"))).alias("description"),
        )
        .filter((F.col("_n_before") > 0) & (F.col("_n_after") > 0))
    )
    return per_code.select(
        "stock_code",
        "description",
        F.date_format(start, "yyyy-MM").alias("month"),
        "price_before",
        "price_after",
        (F.col("price_before") - F.col("price_after")).alias("price_drop"),
    )


def top_price_drops(
    fact: DataFrame, dim_product_df: DataFrame, top: int = 3, ts: str = "invoice_ts"
) -> DataFrame:
    """Q4: products with the largest price drop over the last month (dense rank)."""
    drops = price_drops(fact, dim_product_df, ts).filter(F.col("price_drop") > 0)
    return conform(ranked(drops, "price_drop", top), schemas.TOP_PRICE_DROPS)


# ---------------------------------------------------------------- maintained aggregates


def sales_by_customer_month(fact: DataFrame, month_col: str = "invoice_month") -> DataFrame:
    """(month, customer_id, revenue, last_invoice_ts) over published fact lines.

    Additive per month, so it is maintained incrementally (only touched months are
    recomputed) and the marts read it instead of the whole fact.
    """
    return fact.groupBy(month_col, "customer_id").agg(
        F.sum(F.when(F.col("is_revenue"), F.col("line_amount"))).cast("decimal(38,2)").alias("revenue"),
        F.max("invoice_ts").alias("last_invoice_ts"),
    )


def units_by_version_month(fact: DataFrame, month_col: str = "invoice_month") -> DataFrame:
    """(month, product_key, units) of sales and cancellations."""
    return (
        fact.filter(F.col("transaction_type").isin(SALE, CANCELLATION))
        .groupBy(month_col, "product_key")
        .agg(F.sum("quantity").cast("bigint").alias("units"))
    )
