"""Benchmark decontamination as a prefix-filtered set join with exact containment.

A benchmark item gives a window for every ``window`` consecutive words (one window if it is
shorter). A window's set is its word shingles. Containment must be whole, so the necessary
prefix of a window is one shingle: a document can hold the window only if it holds the
window's rarest shingle.

1. One pass over the documents hashes their shingles and keeps those whose hash is in a
   fixed-size bit table of the benchmark's shingles, with the words around them.
2. Shingles are ordered by their frequency in the corpus; the rarest of each window is joined
   with the kept places of the documents. Both sides carry a salt, so that a passage that a
   third of all documents hold is joined by many tasks.
3. Positional and length bounds: the window must start and end inside the document.
4. The words at the place must equal the window's words.

Nothing but the bit table (a fixed number of bytes) and a handful of shingle sizes passes
through the driver. The places are staged in the shared folder, so later steps don't read
texts again.

Defined cases: null or empty texts have no words and are clean; a null ``item_id`` marks words
as hit but is not listed; repeated items and repeated documents are handled as rows; other
columns are ignored; an empty benchmark marks nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import bit_table, in_table, letters_and_digits, ngram_hashes, row_key, session_workspace, slices, word_spans

WINDOWS = "item_id long, words string, n int, shingles array<long>"
PLACES = "uid long, doc_id long, n_words long, places array<struct<pos:int,hash:long,first:int,words:string>>"


def _shingle_hashes(joined: bytes, k: int, spans) -> np.ndarray:
    """Hashes of k-word shingles; k is part of the hash."""
    return (ngram_hashes(joined, k, spans) ^ np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)).view(np.int64)


def benchmark_windows(benchmark: DataFrame, window: int, shingle: int) -> DataFrame:
    """One row per window of an item: its words and the hashes of its shingles in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 1 << 20):
            rows = []
            for item, text in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist()):
                joined = letters_and_digits(text or b"")
                spans = word_spans(joined)
                words = joined.decode().split(" ") if joined else []
                n = min(window, len(words))
                k = min(shingle, n)
                if not n:
                    continue
                hashes = _shingle_hashes(joined, k, spans)
                for i in range(len(words) - n + 1):
                    rows.append((item, " ".join(words[i : i + n]), n, hashes[i : i + n - k + 1].tolist()))
            cols = list(zip(*rows)) or [[]] * 4
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["item_id", "words", "n", "shingles"])

    source = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(run, WINDOWS)


def document_places(
    documents: DataFrame, table: np.ndarray, sizes: list[int], window: int, shingle: int, uid: str | None = None
) -> DataFrame:
    """Per document its number of words and the places whose shingle may be a benchmark's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = pa.list_(pa.struct([("pos", pa.int32()), ("hash", pa.int64()), ("first", pa.int32()), ("words", pa.string())]))
        for b in slices(batches, "text"):
            counts, places = [], []
            for text in b.column("text").to_pylist():
                joined = letters_and_digits(text or b"")
                starts, ends = spans = word_spans(joined)
                total, found = len(starts), []
                for k in sizes:
                    hashes = _shingle_hashes(joined, k, spans)
                    for pos in np.flatnonzero(in_table(table, hashes)).tolist():
                        first = max(0, pos - (window - shingle))
                        last = min(total, pos + window) - 1
                        around = joined[starts[first] : ends[last]].decode()
                        found.append({"pos": pos, "hash": int(hashes[pos]), "first": first, "words": around})
                counts.append(total)
                places.append(found)
            yield pa.RecordBatch.from_arrays(
                [b.column("uid"), b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(places, place)],
                ["uid", "doc_id", "n_words", "places"],
            )

    source = documents.select(row_key(uid), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(run, PLACES)


def contamination(
    spark: SparkSession,
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = 13,
    shingle: int = 5,
    salts: int = 32,
    share: int = 20,
    uid: str | None = None,
) -> DataFrame:
    """Per document row: uid (its key in the column ``uid``, else a number of its own), doc_id, n_words, n_hit (words inside a window's occurrence), items
    (ids whose windows occur, as sorted strings), contaminated (``share * n_hit >= n_words``)."""
    ws = session_workspace(spark)
    items = ws.stage(benchmark_windows(benchmark, window, shingle), "items")
    windows = ws.stage(
        items.groupBy("words", "n", "shingles").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")),
        "windows",
    )
    shingles = windows.select("words", "n", "items", F.posexplode("shingles").alias("offset", "hash"))
    sizes = [r[0] for r in windows.select(F.least(F.col("n"), F.lit(shingle))).distinct().collect()]  # at most `shingle` values
    table = bit_table(shingles, "hash")

    docs = ws.stage(document_places(documents, table, sorted(sizes), window, shingle, uid), "places")
    places = docs.filter(F.size("places") > 0).select("uid", F.explode("places").alias("p")).select("uid", "p.*")
    seen = places.groupBy("hash").agg(F.count(F.lit(1)).alias("freq"))
    rarest = (
        shingles.join(seen, "hash", "left").fillna(0, ["freq"])
        .groupBy("words", "n", "items")
        .agg(F.min(F.struct("freq", "hash", "offset")).alias("r"))
        .filter(F.col("r.freq") > 0)
        .select(F.col("words").alias("window"), "n", "items", "r.hash", "r.offset")
    )
    prefixes = ws.stage(rarest, "prefixes").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    start = F.col("pos") - F.col("offset")
    there = F.slice(F.split("words", " "), start - F.col("first") + 1, F.col("n"))
    found = (
        places.withColumn("salt", F.pmod(F.xxhash64("uid"), F.lit(salts)).cast("int"))
        .join(prefixes, ["hash", "salt"])
        .filter((start >= F.col("first")) & (start - F.col("first") + F.col("n") <= F.size(F.split("words", " "))))
        .filter(F.array_join(there, " ") == F.col("window"))
        .groupBy("uid")
        .agg(F.collect_set(F.struct(start.alias("at"), F.col("n"))).alias("spans"), F.collect_set("items").alias("items"))
        .select(
            "uid",
            F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["n"] - 1))))).cast("long").alias("n_hit"),
            F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"),
        )
    )
    return (
        docs.select("uid", "doc_id", "n_words").join(found, "uid", "left")
        .select(
            "uid", "doc_id", "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
        .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))
    )
