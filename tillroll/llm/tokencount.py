"""Token counts with overlap resynchronisation for huge documents.

A document of up to ``chunk_chars`` characters is counted whole. A longer one is cut into
chunks that overlap their neighbours; the chunks are spread over the cluster, encoded with
offsets, and counted between splice points. A splice point is a position of the overlap at
which both encodings have a token boundary and which is proven stable: white space stands
there, or a digit ends there. No normalizer step, pre-token pattern or merge of the supported
vocabulary files reaches across either (a digit is a pre-token of its own), so the ids
before it depend only on text before it, and those after it only on text after it. Between
the common boundaries of an overlap both encodings must hold equally many tokens.

Overlaps are widened fourfold in two places: from the text, until an overlap has a stable
position or its chunk reaches the end of the document; and after encoding, where two chunks
share no boundary or differ between boundaries. The documents that failed are then cut and
encoded again, round by round, until their overlaps agree or reach over the whole document,
which is one chunk then.

Defined cases: null and empty texts have 0 tokens; every row is counted, repeated ones and
null ``doc_id`` too; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import session_workspace, slices
from tillroll.llm.wordpiece_cache import cache

STABLE = re.compile(r"[ \t\n\v\f\r]|(?<=[0-9])")
COUNTS = "doc_id long, n_bytes long, n_tokens long"
SPLICED = "doc_id long, text_key string, n_bytes long, n_tokens long"
CHUNKS = "uid long, doc_id long, text_key string, n_bytes long, k int, start long, left long, right long, piece string"
ENCODED = (
    "uid long, doc_id long, text_key string, n_bytes long, k int, total long,"
    "left_at array<long>, left_n array<long>, right_at array<long>, right_n array<long>"
)


def cut_points(text: str, chunk_chars: int, overlap: int) -> list[tuple[int, int]]:
    """(lower, upper) ends of the overlaps between chunks, each with a stable position inside;
    none if an overlap would reach over the whole text."""
    out, at = [], chunk_chars if overlap < len(text) else len(text)
    while at < len(text):
        half = overlap
        while True:
            lo, hi = max(0, at - half), min(len(text), at + half)
            if out:
                lo = max(lo, out[-1][1])
            hit = STABLE.search(text, lo + 1, hi - 1) if hi - lo > 2 else None
            if hit or hi == len(text):
                break
            half *= 4
        if not hit:  # no stable position up to the end: the last chunk takes the rest
            break
        out.append((lo, hi))
        at = max(at, hi) + chunk_chars
    return out


def stable_counts(text: str, offsets: list[tuple[int, int]], lo: int, hi: int) -> tuple[list[int], list[int]]:
    """Stable positions strictly inside [lo, hi) of ``text`` that are token boundaries, and the
    number of tokens that start before each."""
    starts = np.array([o[0] for o in offsets], np.int64)
    ends = np.array([o[1] for o in offsets], np.int64)
    at = np.array([m.start() for m in STABLE.finditer(text, lo + 1, hi - 1)], np.int64)
    before = np.searchsorted(starts, at, "left")
    ended = np.searchsorted(ends, at, "right")
    good = before == ended  # every token that starts before the position also ends there
    return at[good].tolist(), before[good].tolist()


def splice(chunks: pd.DataFrame) -> int | None:
    """Tokens of a document from the chunks' counts at common stable positions; None where two
    chunks' encodings don't agree."""
    chunks = chunks.sort_values("k")
    total, carried = 0, 0
    rows = list(chunks.itertuples())
    for this, after in zip(rows, rows[1:]):
        r = dict(zip(this.right_at, this.right_n))
        l_ = dict(zip(after.left_at, after.left_n))
        common = sorted(r.keys() & l_.keys())
        if len({r[p] - l_[p] for p in common}) != 1:
            return None
        p = common[len(common) // 2]
        total += int(r[p]) - carried
        carried = int(l_[p])
    return total + int(rows[-1].total) - carried


def spliced_counts(documents: DataFrame, tokenizer_path: str, chunk_chars: int, overlap: int) -> DataFrame:
    """doc_id, text_key, n_bytes and n_tokens of (doc_id, text_key, text) rows with a text, from
    overlapping chunks; n_tokens is null where an overlap's encodings don't agree."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, text_kind = pa.int64(), pa.string()
        kinds = (whole, whole, text_kind, whole, pa.int32(), whole, whole, whole, text_kind)
        names = ["uid", "doc_id", "text_key", "n_bytes", "k", "start", "left", "right", "piece"]
        for batch in batches:
            for b in (batch.slice(i, 1) for i in range(batch.num_rows)):
                uid, doc, key, text = (b.column(c)[0].as_py() for c in ("uid", "doc_id", "text_key", "text"))
                n_bytes, cuts = len(text.encode()), cut_points(text, chunk_chars, overlap)
                lows, highs = [0, *(lo for lo, _ in cuts)], [*(hi for _, hi in cuts), len(text)]
                for k, (lo, hi) in enumerate(zip(lows, highs)):
                    left = cuts[k - 1][1] if k else lo  # the overlaps are [lo, left) and [right, hi)
                    right = cuts[k][0] if k < len(cuts) else hi
                    row = (uid, doc, key, n_bytes, k, lo, left, right, text[lo:hi])
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = cache(tokenizer_path).library
        for b in slices(batches, "piece", 1 << 20, keep=True):
            rows = []
            pieces = b.column("piece").to_pylist()
            for r, e in zip(b.to_pylist(), library.encode_batch(pieces, add_special_tokens=False)):
                text, lo = r["piece"], r["start"]
                la, ln = stable_counts(text, e.offsets, 0, r["left"] - lo)
                ra, rn = stable_counts(text, e.offsets, r["right"] - lo, len(text))
                same = (r["uid"], r["doc_id"], r["text_key"], r["n_bytes"], r["k"])
                rows.append((*same, len(e.ids), [p + lo for p in la], ln, [p + lo for p in ra], rn))
            whole, many = pa.int64(), pa.list_(pa.int64())
            kinds = (whole, whole, pa.string(), whole, pa.int32(), whole, many, many, many, many)
            names = ["uid", "doc_id", "text_key", "n_bytes", "k", "total", "left_at", "left_n", "right_at", "right_n"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    def join_up(chunks: pd.DataFrame) -> pd.DataFrame:
        one = chunks.iloc[0]
        found = {"doc_id": [one.doc_id], "text_key": [one.text_key], "n_bytes": [one.n_bytes], "n_tokens": [splice(chunks)]}
        return pd.DataFrame(found).astype({"doc_id": "Int64", "n_tokens": "Int64"})

    chunked = documents.withColumn("uid", F.monotonically_increasing_id()).mapInArrow(cut, CHUNKS).repartition("uid", "k")
    return chunked.mapInArrow(encode, ENCODED).groupBy("uid").applyInPandas(join_up, SPLICED)


def token_counts(
    documents: DataFrame, tokenizer_path: str, chunk_chars: int = 32_768, overlap: int = 256
) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens as the library's encoding of the whole text has."""
    ws = session_workspace(documents.sparkSession)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    long = F.length("text") > chunk_chars

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = cache(tokenizer_path)
        for b in slices(batches, "text", keep=True):
            texts = [t or b"" for t in b.column("text").to_pylist()]
            n = [len(i) // 4 for i in tok.ids(texts)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(n, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    short = docs.filter(~long | F.col("text").isNull()).select("doc_id", F.col("text").cast("binary").alias("text"))
    counts = short.mapInArrow(whole, COUNTS)
    # equal texts fail alike, so a failed document is found again by its text, not by a row number
    huge = docs.filter(long).withColumn("text_key", F.sha2("text", 256))
    todo, width = huge, overlap
    while True:
        got = ws.stage(spliced_counts(todo, tokenizer_path, chunk_chars, width), "spliced")
        counts = counts.unionByName(got.filter(F.col("n_tokens").isNotNull()).drop("text_key"))
        failed = got.filter(F.col("n_tokens").isNull()).select("text_key").distinct()
        if failed.isEmpty():
            return counts
        todo, width = huge.join(failed, "text_key", "left_semi").select("doc_id", "text", "text_key"), width * 4
