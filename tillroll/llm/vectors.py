"""Vectors as whole numbers: what the clustering and the search share.

A component x becomes floor(scale * x), x as a double. A vector that is null or holds a null or
non-finite component takes no part. Components beyond ``MOST`` are an error that says so: squared
distances and products of such vectors do not fit a 64-bit integer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import slices

#: Greatest absolute value of a whole component (products of 256 components stay below 2**62).
MOST = 1 << 27
STORED = "vec_id long, x array<long>"


def whole_rows(column: pa.Array, scale: int, width: int | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places of the rows that take part, and their whole components (``width``: only rows of it)."""
    lists = column.cast(pa.list_(pa.float64()))
    many = np.asarray(pc.fill_null(pc.list_value_length(lists), -1))
    values = pc.fill_null(lists.flatten(), float("nan")).to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.maximum(many, 0))
    odd = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    starts = ends - np.maximum(many, 0)
    good = (many >= 0) & (odd[ends] == odd[starts])
    if width is not None:
        good &= many == width
    rows = np.flatnonzero(good)
    found = [np.floor(values[starts[i] : ends[i]] * scale) for i in rows]
    if any(len(x) and np.abs(x).max() > MOST for x in found):
        raise OverflowError(f"a component times {scale} is beyond {MOST}: scores would not fit 64 bits")
    return rows, [x.astype(np.int64) for x in found]


def whole_vectors(embeddings: DataFrame, vec_id: str, vector: str, scale: int, width: int | None = None) -> DataFrame:
    """(vec_id, x) of the rows that take part; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "x"):
            rows, found = whole_rows(b.column("x"), scale, width)
            yield pa.RecordBatch.from_arrays([b.column("vec_id").take(pa.array(rows)), pa.array(found, pa.list_(pa.int64()))], ["vec_id", "x"])

    source = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("x"))
    return source.mapInArrow(run, STORED)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal width as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
