"""Driver tables (TPC-H-like star schema stored as one Parquet file each)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.session import folder_bytes

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one driver table; Catalyst prunes columns and pushes filters."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored_bytes(spark: SparkSession, sf_dir: str, *names: str) -> int:
    """Bytes of the tables' files (a listing, no content is read)."""
    return sum(folder_bytes(spark, f"{sf_dir.rstrip('/')}/{name}.parquet") for name in names)
