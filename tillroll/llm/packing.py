"""Packing by power-of-two decomposition.

A document of T tokens is cut into ``T // max_len`` pieces of ``max_len`` tokens and then
into one piece per set bit of the rest, longest first. Every piece is a sequence of its
own whose length is a power of two, so no sequence crosses documents and nothing is
padded; batches are drawn from buckets of equal length (``bucket``).

Nothing is shuffled: tokens go from the scan to the pieces in one pass. A lost executor
repeats its own splits.

Defined cases: a null or empty text still has its end-of-document id and gives one piece of
length 1; repeated rows and repeated or null ``doc_id`` are documents of their own; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import slices
from tillroll.llm.wordpiece_cache import cache

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long"


def pieces(total: int, max_len: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``total`` tokens."""
    out = [(s, max_len) for s in range(0, total - max_len + 1, max_len)]
    at, rest = total - total % max_len, total % max_len
    while rest:
        length = 1 << (rest.bit_length() - 1)
        out.append((at, length))
        at, rest = at + length, rest - length
    return out


def pack(documents: DataFrame, tokenizer_path: str, max_len: int = 2048, end_id: int = 1, cache_bytes: int = 256 << 20) -> DataFrame:
    """One row per sequence: doc_id, start, length, ids (little-endian uint32), doc_tokens,
    bucket (= length), sequence_id, offset. A worker keeps words and their ids up to ``cache_bytes``."""
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = cache(tokenizer_path, cache_bytes)
        for b in slices(batches, "text", keep=True):
            texts = [t or b"" for t in b.column("text").to_pylist()]
            rows: list[tuple] = []
            for doc, ids in zip(b.column("doc_id").to_pylist(), tok.ids(texts)):
                ids += end
                total = len(ids) // 4
                rows += [(doc, s, n, ids[4 * s : 4 * (s + n)], total) for s, n in pieces(total, max_len)]
            cols = list(zip(*rows))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds)], ["doc_id", "start", "length", "ids", "doc_tokens"]
            )

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return (
        source.mapInArrow(cut, PIECES)
        .withColumn("bucket", F.col("length").cast("int"))
        .withColumn("sequence_id", F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("long"))
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """One folder per length. Rows are spread by (bucket, hash of the sequence), so a length
    that holds most sequences is written by many tasks."""
    (
        packed.withColumn("_part", F.pmod(F.xxhash64("sequence_id"), F.lit(64)))
        .repartition("bucket", "_part").drop("_part")
        .write.partitionBy("bucket").parquet(path)
    )
