"""Rule catalogue: SQL predicates that are TRUE for a good row.

Fixed values: rule names, predicates and severities of every published table.
"""

from __future__ import annotations

from tillroll.operators.quality import Rule

WARN = "warn"

SILVER_CUSTOMERS = (
    Rule("customer_id_not_null", "customer_id IS NOT NULL"),
    Rule("country_not_null", "country IS NOT NULL"),
    Rule("country_unambiguous", "country IS NULL OR country <> 'Multiple'", WARN),
    Rule(
        "country_is_specific",
        "country IS NULL OR country NOT IN ('Unknown', 'European Community')",
        WARN,
    ),
)

SILVER_PRODUCTS = (
    Rule("stock_code_not_null", "stock_code IS NOT NULL"),
    Rule("version_not_null", "version IS NOT NULL"),
    Rule("unit_price_not_null", "unit_price IS NOT NULL"),
    Rule("unit_price_positive", "unit_price IS NULL OR unit_price > 0"),
)

SILVER_ORDERS = (
    Rule("order_line_id_not_null", "order_line_id IS NOT NULL"),
    Rule("customer_id_not_null", "customer_id IS NOT NULL", WARN),
    Rule("invoice_no_not_null", "invoice_no IS NOT NULL"),
    Rule("stock_code_not_null", "stock_code IS NOT NULL"),
    Rule("invoice_ts_valid", "invoice_ts IS NOT NULL"),
    Rule("quantity_valid", "quantity <> 0"),
)

DIM_CUSTOMER = (
    Rule("customer_id_not_null", "customer_id IS NOT NULL"),
    Rule("country_not_null", "country IS NOT NULL"),
)

DIM_PRODUCT = (
    Rule("valid_range", "valid_from < valid_to"),
    Rule("unit_price_not_null", "unit_price IS NOT NULL"),
)

FACT_SALES = (
    Rule("product_found", "product_key IS NOT NULL"),
    Rule("line_amount_not_null", "product_key IS NULL OR line_amount IS NOT NULL"),
)

TOP_COUNTRIES_BY_CUSTOMERS = (Rule("customers_positive", "customers > 0"),)

REVENUE_BY_COUNTRY = (
    Rule("country_not_null", "country IS NOT NULL"),
    Rule("revenue_not_null", "revenue IS NOT NULL"),
)

PRICE_VS_VOLUME = (Rule("avg_unit_price_not_null", "avg_unit_price IS NOT NULL"),)

TOP_PRICE_DROPS = (Rule("is_a_drop", "price_drop > 0"),)

BY_TABLE = {
    "silver.customers": SILVER_CUSTOMERS,
    "silver.products": SILVER_PRODUCTS,
    "silver.orders": SILVER_ORDERS,
    "gold.dim_customer": DIM_CUSTOMER,
    "gold.dim_product": DIM_PRODUCT,
    "gold.fact_sales": FACT_SALES,
    "gold.top_countries_by_customers": TOP_COUNTRIES_BY_CUSTOMERS,
    "gold.revenue_by_country": REVENUE_BY_COUNTRY,
    "gold.price_vs_volume": PRICE_VS_VOLUME,
    "gold.top_price_drops": TOP_PRICE_DROPS,
}
