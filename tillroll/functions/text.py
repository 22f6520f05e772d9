"""Column helpers for lenient typing and cleaning of text feeds.

Everything here is a built-in Spark expression (whole-stage codegen, no Python
workers). Spark 4 runs with ANSI semantics, where a plain ``cast`` of junk text
raises; all lenient conversions therefore use ``try_*`` forms and yield NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Integer text, optionally with a fraction that is truncated ("3.7" -> 3, "-3.9" -> -3).
INTEGER_TEXT = r"^([+-]?[0-9]+)([.][0-9]*)?$"
# month/day/year hour:minute, one or two digits for month, day and hour.
US_DATETIME_TEXT = r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4}) ([0-9]{1,2}):([0-9]{2})$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_code(c: Column | str) -> Column:
    """Codes are case-insensitive and may be padded: ``upper(trim(x))``."""
    return F.upper(F.trim(col(c)))


def blank_to_null(c: Column | str) -> Column:
    """Trimmed text, NULL when blank."""
    t = F.trim(col(c))
    return F.when(t != "", t)


def lenient_integer(c: Column | str, type_name: str = "int") -> Column:
    """Text -> integer type; junk and overflow -> NULL, fractions truncated."""
    digits = F.regexp_extract(F.trim(col(c)), INTEGER_TEXT, 1)
    return digits.try_cast(type_name)


def lenient_decimal(c: Column | str, precision: int = 10, scale: int = 2) -> Column:
    """Text -> decimal(p,s), HALF_UP; junk and overflow -> NULL."""
    return F.trim(col(c)).try_cast(f"decimal({precision},{scale})")


def lenient_us_timestamp(c: Column | str) -> Column:
    """``M/d/yyyy H:mm`` text -> TIMESTAMP_NTZ, NULL when malformed or impossible.

    Built from the parts so the result never depends on the session time zone
    (no DST gaps) and impossible values (month 15, minute 90) become NULL.
    """
    t = F.trim(col(c))
    # One regex checks the shape; the parts are cut with (regex-free) substring_index.
    date_part, time_part = F.substring_index(t, " ", 1), F.substring_index(t, " ", -1)
    month = F.substring_index(date_part, "/", 1)
    day = F.substring_index(F.substring_index(date_part, "/", 2), "/", -1)
    year = F.substring_index(date_part, "/", -1)
    hour, minute = F.substring_index(time_part, ":", 1), F.substring_index(time_part, ":", -1)
    y, mo, d, h, mi = [p.try_cast("int") for p in (year, month, day, hour, minute)]
    return F.when(t.rlike(US_DATETIME_TEXT), F.try_make_timestamp_ntz(y, mo, d, h, mi, F.lit(0)))


def recode(c: Column | str, mapping: Mapping[str, str], fallback: Column | None = None) -> Column:
    """Dictionary recode: ``mapping[x]``, else ``fallback`` (default: x itself)."""
    c = col(c)
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(lookup[c], c if fallback is None else fallback)


def recode_by_table(
    df: DataFrame, column: str, dictionary: DataFrame, key: str, value: str, name: str, fallback: Column | None = None, most_entries: int = 256
) -> DataFrame:
    """P5 with a dictionary that is a table: ``df`` with the value of ``column`` as ``name``.

    The entries are counted first, up to ``most_entries`` + 1. Up to ``most_entries`` they become a map
    (a scalar subquery: no join, no exchange); more are joined, and Catalyst broadcasts them only by
    their size. Defined cases: of a key's repeated values the smallest non-NULL one counts; a NULL
    key of the dictionary matches nothing, and a NULL in ``column``, a missing key and a NULL value
    give ``fallback`` (default: the column itself, as text)."""
    entries = dictionary.select(F.col(key).alias("_key"), F.col(value).alias("_value")).dropna()
    entries = entries.groupBy("_key").agg(F.min("_value").alias("_value"))
    other = F.col(column).cast("string") if fallback is None else fallback
    if entries.limit(most_entries + 1).count() <= most_entries:
        lookup = entries.agg(F.map_from_entries(F.collect_list(F.struct("_key", "_value"))).alias("m")).scalar()
        return df.withColumn(name, F.coalesce(F.try_element_at(lookup, F.col(column).cast(entries.schema["_key"].dataType)), other))
    joined = df.join(entries, F.col(column) == F.col("_key"), "left")
    return joined.withColumn(name, F.coalesce("_value", other)).drop("_key", "_value")


def is_name_case(c: Column | str) -> Column:
    """Written in capitals: has an upper-case letter and no lower-case letter."""
    c = col(c)
    return c.rlike("[A-Z]") & ~c.rlike("[a-z]")
