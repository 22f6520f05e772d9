"""Checks over whole tables and over the stored history of runs.

Each returns rows that say what is wrong, or how much, so that they can be stored and asked like the
results of row rules. Nothing is collected, and no key's rows stand in one task: keys are aggregated
before they are joined, versions are compared inside bounded chunks, and the history of runs is
aggregated per table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.ranking import chunk_of, previous_in_group


def orphans(table: DataFrame, key: str, referenced: DataFrame, referenced_key: str) -> DataFrame:
    """Referential check: (key, n) of the keys of ``table`` that ``referenced`` does not have. A NULL key
    refers to nothing and is no orphan. Rows are counted per key before the anti join."""
    used = table.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return used.join(referenced.select(F.col(referenced_key).alias("key")).distinct(), "key", "left_anti")


def price_jumps(versions: DataFrame, times: int = 3) -> DataFrame:
    """Versions whose price is over ``times`` the one before, or under a ``times``-th of it."""
    compared = previous_in_group(versions, ["stock_code"], ["version"], [chunk_of(F.col("version"))], "unit_price", "previous_price")
    now, before = F.col("unit_price"), F.col("previous_price")
    return compared.filter((now > before * times) | (now * times < before)).select("stock_code", "version", "previous_price", "unit_price")


def volume_changes(history: DataFrame, lowest_pct: int = 50, highest_pct: int = 200) -> DataFrame:
    """Volume against the stored runs: (table_name, run_id, rows_total, usual_rows, unusual) of each table's
    last run in ``history`` (run_id, table_name, rows_total); ``usual_rows`` is the mean of its earlier
    runs, rounded down, NULL (and not unusual) if there are none. Both limits themselves are usual."""
    known = history.filter(F.col("rows_total").isNotNull())
    last = known.groupBy("table_name").agg(F.max("run_id").alias("run_id"))
    now = known.join(last, ["table_name", "run_id"], "left_semi").groupBy("table_name", "run_id").agg(F.max("rows_total").alias("rows_total"))
    earlier = known.join(last, ["table_name", "run_id"], "left_anti").groupBy("table_name").agg(
        F.call_function("div", F.sum("rows_total"), F.count(F.lit(1))).cast("bigint").alias("usual_rows")
    )
    rows, usual = F.col("rows_total") * 100, F.col("usual_rows")
    unusual = F.coalesce((rows < usual * lowest_pct) | (rows > usual * highest_pct), F.lit(False))
    return now.join(earlier, "table_name", "left").select("table_name", "run_id", "rows_total", "usual_rows", unusual.alias("unusual"))


def staleness(tables: dict[str, DataFrame], at: Column, most_days: int) -> DataFrame:
    """Freshness: (table_name, newest, days, stale) of each table by its newest ``_ingested_at``; a table
    without rows is stale."""
    parts = [df.agg(F.max("_ingested_at").alias("newest")).select(F.lit(name).alias("table_name"), "newest") for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    days = F.date_diff(F.to_date(at), F.to_date("newest")).cast("bigint")
    return out.select("table_name", "newest", days.alias("days"), F.coalesce(days > most_days, F.lit(True)).alias("stale"))

