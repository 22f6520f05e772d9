"""Declared schemas of every stored table (DDL strings -> StructType).

Timestamps of the data model are TIMESTAMP_NTZ (wall-clock values, like the
driver tables); ingestion instants are TIMESTAMP.
"""

from __future__ import annotations

import re

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

LINEAGE = "_source_file string, _row_id bigint, _ingested_at timestamp"

_TYPES: dict[str, DataType] = {
    "string": StringType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "timestamp_ntz": TimestampNTZType(),
    "decimal(10,2)": DecimalType(10, 2),
    "decimal(18,2)": DecimalType(18, 2),
    "decimal(38,2)": DecimalType(38, 2),
    "array<string>": ArrayType(StringType()),
}


def ddl(text: str) -> StructType:
    """``"name type, ..."`` -> StructType (the handful of types the model uses;
    needs no running session, unlike ``StructType.fromDDL``)."""
    fields = []
    for item in re.split(r",\s*(?![0-9])", text):
        name, type_name = item.strip().split(" ", 1)
        fields.append(StructField(name, _TYPES[type_name.strip()]))
    return StructType(fields)


def with_column(schema: StructType, name: str, type_name: str) -> StructType:
    return StructType([*schema.fields, StructField(name, _TYPES[type_name])])


# bronze also keeps the part file inside a delivery: (_source_file, _source_part, _row_id) is
# the order of the delivery
BRONZE_LINEAGE = "_source_file string, _source_part string, _row_id bigint, _ingested_at timestamp"
BRONZE_CUSTOMERS = ddl(f"customer_id string, country string, {BRONZE_LINEAGE}")
BRONZE_PRODUCTS = ddl(f"stock_code string, description string, unit_price string, {BRONZE_LINEAGE}")
BRONZE_ORDERS = ddl(
    "invoice_no string, stock_code string, quantity string, invoice_date string, "
    f"customer_id string, {BRONZE_LINEAGE}"
)

SILVER_CUSTOMERS = ddl(f"customer_id bigint, country string, countries string, {LINEAGE}")
SILVER_PRODUCTS = ddl(
    "stock_code string, version int, description string, description_raw string, "
    f"unit_price decimal(10,2), product_type string, {LINEAGE}"
)
SILVER_ORDERS = ddl(
    "order_line_id string, invoice_no string, stock_code string, quantity int, "
    f"invoice_ts timestamp_ntz, customer_id bigint, transaction_type string, {LINEAGE}"
)

DIM_CUSTOMER = ddl("customer_id bigint, country string, countries string")
DIM_PRODUCT = ddl(
    "product_key bigint, stock_code string, version int, description string, "
    "unit_price decimal(10,2), product_type string, valid_from timestamp_ntz, "
    "valid_to timestamp_ntz, is_current boolean"
)
FACT_SALES = ddl(
    "order_line_id string, invoice_no string, invoice_ts timestamp_ntz, customer_id bigint, "
    "product_key bigint, quantity int, unit_price decimal(10,2), line_amount decimal(18,2), "
    "transaction_type string, is_revenue boolean"
)

TOP_COUNTRIES_BY_CUSTOMERS = ddl("rank int, country string, customers bigint")
REVENUE_BY_COUNTRY = ddl(
    "rank int, country string, revenue decimal(18,2), revenue_share_pct double"
)
PRICE_VS_VOLUME = ddl(
    "stock_code string, description string, avg_unit_price decimal(10,2), units_sold bigint"
)
TOP_PRICE_DROPS = ddl(
    "rank int, stock_code string, description string, month string, "
    "price_before decimal(10,2), price_after decimal(10,2), price_drop decimal(10,2)"
)

DQ_RESULTS = ddl(
    "run_id string, table_name string, rule string, severity string, failed_rows bigint, "
    "total_rows bigint, checked_at timestamp"
)
DQ_QUARANTINE = ddl(
    "run_id string, table_name string, failed_rules array<string>, record string, "
    "quarantined_at timestamp"
)
RUN_LOG = ddl(
    "run_id string, table_name string, layer string, status string, rows_total bigint, "
    "rows_published bigint, rows_quarantined bigint, message string, started_at timestamp, "
    "finished_at timestamp"
)

# deliveries that are in bronze; what each table has taken in (JSON)
INGESTED_FILES = ddl("feed string, file string, load_id string, ingested_at timestamp")
STATE = ddl("table_name string, seq bigint, detail string, committed_at timestamp")

# maintained monthly aggregates of the fact (incremental marts)
SALES_BY_CUSTOMER_MONTH = ddl(
    "invoice_month date, customer_id bigint, revenue decimal(38,2), last_invoice_ts timestamp_ntz"
)
UNITS_BY_VERSION_MONTH = ddl("invoice_month date, product_key bigint, units bigint")
