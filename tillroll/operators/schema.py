"""Schema conformance: exactly the declared columns, order and types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` in the shape of ``schema``. What is missing is NULL, what is not declared goes,
    and a value that the declared type can't hold is NULL (no ANSI failure)."""
    absent = set(schema.names).difference(df.columns)
    whole = df.withColumns({name: F.lit(None) for name in absent}) if absent else df
    return whole.selectExpr(
        *(f"try_cast(`{name}` AS {kind}) AS `{name}`" for name, kind in zip(schema.names, _kinds(schema)))
    )


def _kinds(schema: StructType) -> list[str]:
    return [field.dataType.simpleString() for field in schema.fields]


def empty(spark, schema: StructType) -> DataFrame:
    """An empty DataFrame of the schema (a table that does not exist yet)."""
    return spark.createDataFrame([], schema)
