"""Keep the newest row per key.

Both forms are aggregations, not ``row_number`` windows: a key that was replayed millions of
times (one group with a third of all rows) is collapsed by every map task before the
shuffle instead of being sorted in a single task. Rows are ordered by (load, row id).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

NEWEST_BY = ("_ingested_at", "_row_id")
LINEAGE = ("_source_file", "_row_id", "_ingested_at")


def copy_order(lines: DataFrame) -> Column:
    """Which copy is newer, as one fixed-width number: load (microseconds), then place in the part
    file, then a hash of the part file (places are only unique inside one, and the choice between
    equal places must not depend on how Spark reads the files)."""
    names = [c for c in ("_source_file", "_source_part") if c in lines.columns]
    part = F.col("_part") if "_part" in lines.columns else F.xxhash64(*names)
    numbers = (F.unix_micros("_ingested_at"), F.col("_row_id"), F.pmod(part, F.lit(1 << 24)))
    load, place, tie = (n.cast("decimal(16,0)") for n in numbers)
    return ((load * F.lit(1 << 50).cast("decimal(16,0)") + place) * F.lit(1 << 24).cast("decimal(8,0)") + tie).cast("decimal(38,0)")


def line_columns(lines: DataFrame) -> list[str]:
    """What makes a line: all columns but the lineage."""
    return [c for c in lines.columns if c not in (*LINEAGE, "_source_part", "_file", "_part")]


def numbered(lines: DataFrame) -> DataFrame:
    """The lines with their file and part file as hashes, for an exchange before ``newest_copies`` is given ``files``."""
    names = [c for c in ("_source_file", "_source_part") if c in lines.columns]
    return lines.withColumns({"_file": F.xxhash64("_source_file"), "_part": F.xxhash64(*names)}).drop(*names)


def line_groups(lines: DataFrame, follow: Sequence[str] = (), same: Column | None = None) -> tuple[GroupedData, list[Column]]:
    """The lines grouped by what makes them, and the aggregates that give ``follow`` back: columns that follow
    from the rest (and from ``same``, where given), which are not grouped by. A predicate on them stays above the
    groups; on grouped columns Catalyst pushes it below the lines' joins and parses their text there again."""
    line = [c for c in line_columns(lines) if c not in follow]
    keys = [F.col(c) for c in line] + ([same.alias("_same")] if same is not None else [])
    return lines.groupBy(*keys), [F.max(c).alias(c) for c in follow]


def newest_copies(
    lines: DataFrame, files: DataFrame | None = None, follow: Sequence[str] = (), same: Column | None = None
) -> DataFrame:
    """One row per distinct line, with the lineage of its newest copy (``follow``, ``same``: ``line_groups``).

    All columns but the lineage are the line (the key determines them), so they are the group, and
    lines are exchanged by it and never by their file. With ``files`` (_source_file: the delivered
    files, a table or literal rows small enough for Catalyst to broadcast) the lineage is aggregated
    as fixed-width numbers, a file by its hash, which keeps the plan on hash aggregates without
    sorts; ``files`` gives the names back. Without it the lineage is aggregated as it is.
    """
    line, order = line_columns(lines), copy_order(lines)
    groups, followers = line_groups(lines, follow, same)
    if files is None:
        best = F.max_by(F.struct(*LINEAGE), order).alias("_best")
        return groups.agg(*followers, best).select(*line, "_best.*")
    file = F.col("_file") if "_file" in lines.columns else F.xxhash64("_source_file")
    newest = groups.agg(
        *followers,
        F.max_by(file, order).alias("_file"),
        F.max_by("_row_id", order).alias("_row_id"),
        F.max("_ingested_at").alias("_ingested_at"),
    )
    names = files.select(F.xxhash64("_source_file").alias("_file"), "_source_file").distinct()
    return newest.join(names, "_file", "left").select(*line, *LINEAGE)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = NEWEST_BY, row_identity: Sequence[str] = LINEAGE
) -> DataFrame:
    """W1: of each key the row with the greatest ``order``. Rows whose key has a NULL are no
    duplicates of each other: each is a group of its own, told apart by ``row_identity``."""
    known = F.lit(True)
    for key in keys:
        known &= F.col(key).isNotNull()
    alone = F.when(~known, F.struct(*row_identity)).alias("_alone")
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_best")
    return df.groupBy(*keys, alone).agg(best).select(*keys, "_best.*").select(*df.columns)
