"""Interval (as-of) joins: match each fact row to the version valid at its instant.

Two plans of the same join, for versions with half-open validity ``[from, to)``:

``asof_join`` cuts time into calendar months. A version stands in every month it touches, a fact in
the month of its instant, and the join is an equi-join on (key, month) with the exact interval as
residual. Months are clamped to those between the first end and the last start of any version:
outside them nothing changes, so an open end costs no copies. The month is arithmetic on the date's
fields (generated code) and is never NULL, so that nothing is inferred from it and pushed below what
made the facts. Versions of one key may overlap. No hint is forced: the optimizer broadcasts by
checked size, else joins by sort-merge, where AQE can split the fact side. ``piece_rows`` splits
the (key, month) pairs that have more facts than that by a salt, at the cost of counting them.

``asof_merge`` expands no version: facts and versions are laid out together by (key, time) in ranges
of even size and the last version seen is carried over them. It is for long histories (a version
that touches hundreds of months, or thousands of versions of a key inside one month), and versions of
a key must not overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.operators.staging import session_workspace

SLOT, SALT = "_slot", "_salt"


def half_open(at: Column, start: Column, end: Column) -> Column:
    """``start <= at < end``: the version valid AT the instant."""
    return (at >= start) & (at < end)


def just_before(at: Column, start: Column, end: Column) -> Column:
    """``start < at <= end``: the version valid just before the instant."""
    return (start < at) & (end >= at)


def month_number(ts: Column | str) -> Column:
    """Months since year 0; NULL for NULL."""
    return F.year(ts) * 12 + F.month(ts)


def slotted(facts: DataFrame, versions: DataFrame, at: str, valid_from: str, valid_to: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with their slots: facts one row each, versions one row per slot they touch."""
    last = F.col(valid_to) - F.expr("INTERVAL '0.000001' SECOND")
    first_end = versions.agg(F.min(month_number(last))).scalar()
    last_start = versions.agg(F.max(month_number(valid_from))).scalar()

    def slot(month: Column) -> Column:
        return F.coalesce(F.greatest(F.col("_low"), F.least(F.col("_high"), month)), F.lit(0))

    def edged(df: DataFrame) -> DataFrame:
        return df.withColumns({"_low": F.coalesce(first_end, F.lit(0)), "_high": F.coalesce(last_start, F.lit(0))})

    first_slot = slot(month_number(valid_from))
    touched = F.sequence(first_slot, F.greatest(first_slot, slot(month_number(last))))
    f = edged(facts).withColumn(SLOT, slot(month_number(at))).drop("_low", "_high")
    v = edged(versions).withColumn(SLOT, F.explode(touched)).drop("_low", "_high")
    return f, v


def _salted(f: DataFrame, v: DataFrame, key: str, piece_rows: int) -> tuple[DataFrame, DataFrame]:
    """Facts of a (key, slot) with over ``piece_rows`` rows are dealt over several salts, and the
    versions of such a pair are repeated for each. The hot pairs are at most rows / piece_rows."""
    hot = (
        f.groupBy(key, SLOT).agg(F.ceil(F.count(F.lit(1)) / piece_rows).cast("int").alias("_pieces"))
        .filter((F.col("_pieces") > 1) & F.col(key).isNotNull())
    )
    f = f.join(hot, [key, SLOT], "left").withColumn(SALT, F.pmod(F.monotonically_increasing_id(), F.coalesce("_pieces", F.lit(1))).cast("int"))
    salts = F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)
    v = v.join(hot, [key, SLOT], "left").withColumn(SALT, F.explode(salts))
    return f.drop("_pieces"), v.drop("_pieces")


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    how: str = "left",
    piece_rows: int | None = None,
    pieces: int | None = None,
) -> DataFrame:
    """J1: ``facts`` with the ``versions`` row of the same key valid at ``facts.at``. With ``pieces`` both sides
    are dealt over so many partitions (AQE splits no hot pair of those: ``piece_rows`` does).

    Returns the aliases ``f`` (facts) and ``v`` (versions) for the caller's select.
    """
    f, v = slotted(facts, versions, at, valid_from, valid_to)
    on = [key, SLOT]
    if piece_rows is not None:
        f, v = _salted(f, v, key, piece_rows)
        on.append(SALT)
    if pieces:
        f, v = f.repartition(pieces, *on), v.repartition(pieces, *on)
    cond = half_open(F.col(f"f.{at}"), F.col(f"v.{valid_from}"), F.col(f"v.{valid_to}"))
    for c in on:
        cond &= F.col(f"f.{c}") == F.col(f"v.{c}")
    return f.alias("f").join(v.alias("v"), cond, how)


def asof_merge(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    pieces: int | None = None,
) -> DataFrame:
    """J1 by merging: as ``asof_join`` (left), for versions of a key that don't overlap.

    1. Facts and versions, each one row, are laid out in ``pieces`` (default: the session's
       shuffle partitions) ranges of (key, time, kind, tie), stored with the number of their range.
       The tie is a hash of the row, so that a key, or one instant of it, with a third of all rows
       spans many ranges.
    2. A window inside each range carries the last version seen over the facts after it.
    3. The last version of each range is carried over the ranges (one row a range), and a fact with
       no version before it in its own range takes that one.
    4. What was carried counts only if it is of the fact's key and valid at its instant.

    A NULL key or instant matches nothing; a version without a start is never valid.
    Returns the aliases ``f`` and ``v``, as ``asof_join`` does.
    """
    spark = facts.sparkSession
    ranges = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    fact, version = F.struct(*facts.columns), F.struct(*versions.columns)
    key_type, kinds = facts.schema[key].dataType, (F.lit(None).cast(versions.schema), F.lit(None).cast(facts.schema))
    rows = versions.filter(F.col(valid_from).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).cast(key_type).alias("_key"), F.col(valid_from).alias("_at"), F.lit(0).alias("_kind"),
        F.lit(0).cast("long").alias("_tie"), kinds[1].alias("_f"), version.alias("_v"),
    ).unionByName(
        facts.select(
            F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_kind"),
            F.xxhash64(*facts.columns).alias("_tie"), fact.alias("_f"), kinds[0].alias("_v"),
        )
    )
    order = ["_key", "_at", "_kind", "_tie"]
    laid = rows.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id())
    laid = session_workspace(spark).stage(laid, "merged")

    last_of_range = (
        laid.filter("_kind = 0").groupBy("_range").agg(F.max_by("_v", F.struct("_key", "_at")).alias("_last"))
        .join(laid.select("_range").distinct(), "_range", "right")
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    carried = last_of_range.select("_range", F.last("_last", ignorenulls=True).over(before).alias("_carried"))

    so_far = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = laid.withColumn("_seen", F.last("_v", ignorenulls=True).over(so_far)).filter("_kind = 1").drop("_v")
    found = seen.join(carried, "_range", "left").withColumn("_v", F.coalesce("_seen", "_carried"))
    valid = (F.col(f"_v.{key}") == F.col("_key")) & half_open(F.col("_at"), F.col(f"_v.{valid_from}"), F.col(f"_v.{valid_to}"))
    return _two_sides(found.withColumn("_v", F.when(valid, F.col("_v"))))


def _two_sides(found: DataFrame) -> DataFrame:
    """The structs ``_f`` and ``_v`` under the names ``f`` and ``v``, so that ``f.x`` and ``v.x`` work as after a join."""
    return found.select(F.col("_f").alias("f"), F.col("_v").alias("v"))
