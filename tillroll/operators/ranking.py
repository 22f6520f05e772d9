"""Position of each row within its group, without a window over the whole group.

``row_number().over(partitionBy(key).orderBy(...))`` puts every row of a key in
one task. For a key holding a third of all rows that is one serial sort of a
third of the table. ``position_in_group`` gets the same numbers in bounded
pieces:

1. rows are cut into chunks of a key that follow the sort order (e.g. the file
   and ``chunk_of(_row_id)``), so no (key, chunk) holds more than a bounded number
   of rows; a window numbers rows inside each (key, chunk);
2. an aggregate counts rows per (key, chunk) (and can carry per-chunk partial
   aggregates, e.g. the first name seen);
3. a running sum over that small table gives each chunk's offset (a hot key has
   one row per chunk there, not one per row);
4. an equi-join on (key, chunk) (NULL-safe, so NULL keys keep their group) adds
   the offset and the group size back to the rows.

Exact and deterministic; everything is a shuffle on (key, chunk) or on the small
count table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_BITS = 20  # a chunk has at most 2**20 consecutive row ids


def chunk_of(row_number: Column) -> Column:
    """Chunk of a number that follows the sort order."""
    return F.shiftright(row_number, CHUNK_BITS)


def position_in_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    chunk: Sequence[Column],
    position: str = "_position",
    size: str = "_group_size",
    chunk_aggs: Sequence[tuple[str, Column]] = (),
    group_aggs: Sequence[tuple[str, Column]] = (),
) -> DataFrame:
    """Add ``position`` (1-based, ascending ``order``) and ``size`` (rows in group).

    ``order`` must be unique within a group; ``chunk`` must be non-decreasing
    along ``order`` within a group. ``chunk_aggs`` are (name, aggregate) pairs per
    (key, chunk); ``group_aggs`` are (name, aggregate over the group's chunk rows)
    pairs computed on the small table and joined back with the offsets.

    The per-chunk count and aggregates are window aggregates over the same
    (key, chunk) partitioning as the numbering (each bounded by the chunk size);
    the small per-chunk table is then a ``distinct`` of that clustered output.
    """
    chunk_names = [f"_chunk{i}" for i in range(len(chunk))]
    rows = df.select("*", *[c.alias(n) for c, n in zip(chunk, chunk_names)])
    in_chunk = Window.partitionBy(*keys, *chunk_names)
    rows = rows.withColumns(
        {
            "_local": F.row_number().over(in_chunk.orderBy(*order)),
            "_n": F.count(F.lit(1)).over(in_chunk),
            **{name: agg.over(in_chunk) for name, agg in chunk_aggs},
        }
    )
    per_chunk = rows.select(*keys, *chunk_names, "_n", *[n for n, _ in chunk_aggs]).distinct()
    in_key = Window.partitionBy(*keys)
    before = in_key.orderBy(*chunk_names).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_chunk.select(
        *keys,
        *chunk_names,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(in_key).alias(size),
        *[agg.over(in_key).alias(name) for name, agg in group_aggs],
    )
    r, o = rows.alias("r"), offsets.alias("o")
    cond = None
    for k in [*keys, *chunk_names]:
        c = F.col(f"r.{k}").eqNullSafe(F.col(f"o.{k}"))
        cond = c if cond is None else cond & c
    joined = r.join(o, cond, "inner")
    extra = [size, *[name for name, _ in group_aggs]]
    return joined.select(
        *[F.col(f"r.{c}") for c in df.columns],
        (F.col("o._offset") + F.col("r._local")).alias(position),
        *[F.col(f"o.{c}") for c in extra],
    )


def previous_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Sequence[Column], value: str, previous: str = "_previous"
) -> DataFrame:
    """Adds ``previous``: ``value`` of the row before in its group (NULL for the first), as ``lag`` over the
    whole group would, in the bounded chunks of ``position_in_group``. The first row of a chunk takes the
    last value of the nearest chunk before, from the table of one row per (key, chunk)."""
    chunk_names = [f"_chunk{i}" for i in range(len(chunk))]
    rows = df.select("*", *[c.alias(n) for c, n in zip(chunk, chunk_names)])
    in_chunk = Window.partitionBy(*keys, *chunk_names).orderBy(*order)
    rows = rows.withColumns({"_inside": F.lag(F.struct(F.col(value).alias("v"))).over(in_chunk)})
    last = F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order)).alias("_last")
    in_key = Window.partitionBy(*keys).orderBy(*chunk_names)
    before = rows.groupBy(*keys, *chunk_names).agg(last).withColumn("_before", F.lag("_last").over(in_key))
    r, b = rows.alias("r"), before.alias("b")
    on = F.lit(True)
    for k in [*keys, *chunk_names]:
        on &= F.col(f"r.{k}").eqNullSafe(F.col(f"b.{k}"))
    joined = r.join(b, on, "inner")
    return joined.select(*[F.col(f"r.{c}") for c in df.columns], F.coalesce(F.col("r._inside"), F.col("b._before"))["v"].alias(previous))
