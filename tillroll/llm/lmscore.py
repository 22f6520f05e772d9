"""Language-model scoring by cross-entropy difference.

Two word bigram models share one vocabulary (every word of the corpus, as 64-bit hashes) and one
recipe (absolute discounting interpolated with add-one unigrams): the target model counts the
documents of a target set, the background model all documents. A document's score is the mean
over its tokens of

    -ln p_target(token) + ln p_background(token)

so the lower, the more it is like the target (Moore and Lewis 2010). No word is left out and none
is made ``<unk>``, however rare. The add-one share has a cell for each word (``VOCABULARY`` cells
in a corpus of fewer words).

Nothing that grows with the corpus passes through the driver or is broadcast:

1. The documents' words are staged once, compressed, in slices of some megabytes.
2. Every slice sends its distinct bigrams with their counts, as arrays, to the bucket of the word
   before; those of the mark before each document, and of words that occur so often that they would
   fill a good part of a bucket, are spread over all buckets by the word after. There are a few
   such words for each bucket at most (8 bytes each). The words after one word are told apart by
   48 bits of their hashes (a chance of m * m / 2**49 that two of m are taken for one). A bucket adds the counts up over the corpus, returns
   the sums to the slices in the order they asked, and adds up each word's figures. The end of a
   document counts as a bigram here, so that these give a word's whole count too.
3. Every slice asks for its distinct words' figures in the same way.
4. Slices and answers meet, and the documents are scored.

Defined cases: a null, empty or wordless text has no tokens and null costs; an empty target
set leaves the target model to its uniform part; labels without a document are ignored;
repeated rows are rows; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import letters_and_digits, mix, ngram_hashes, session_workspace, slices, word_spans

#: Least number of cells of the add-one unigrams; a corpus with more words has one for each.
VOCABULARY = 1 << 12
UNK, BOS, FIRST = 0, 1, 2
DISCOUNT = 0.75
SLICE_BYTES = 8 << 20
#: Tokens a bucket of bigrams.
BUCKET = 1 << 20
#: Words of more than this part of a bucket's tokens are spread over all buckets.
HEAVY = 4
#: Bytes of a word after another on its way to a bucket.
AFTER_BYTES = 6
#: Hashes of the marks before and after a document's words, and their places in a slice's words.
MARKS = np.array([0x5BD1E995A5A5A5A5, 0x27D4EB2F165667C5], np.uint64)
START, END = 0, 1
LOW = np.uint64((1 << 8 * AFTER_BYTES) - 1)

SLICES = "doc_ids array<long>, lens array<int>, tokens long, words binary"
REQUESTS = "bucket int, slice long, before binary, runs binary, after binary, n binary, target binary"
#: kind 0: sums for a slice; kind 1: figures of words for a bucket of words.
SUMS = "kind int, slice long, bucket int, keys binary, data binary"
#: kind 0: figures for a slice; kind 1: the bucket's totals.
FIGURES = "kind int, slice long, bucket int, data binary, background long, target long, words long"
SCORES = "doc_id long, n_tokens long, ce_target double, ce_background double, ce_diff double"


def _pack(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, codec="zstd", asbytes=True) if size else b""


def _figures(data: bytes, many: int) -> np.ndarray:
    """Packed int64 figures, a row for each kind."""
    return np.frombuffer(_unpack(data), np.int64).reshape(many, -1)


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
             "array<int>": pa.list_(pa.int32())}
    fields = [f.split(" ") for f in schema.split(", ")]
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields)], [n for n, _ in fields])


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[list[dict]]:
    """Rows sorted by ``key``, those of each of its values together."""
    held: list[dict] = []
    for b in batches:
        for i in range(b.num_rows):
            row = {n: b.column(n)[i].as_py() for n in b.schema.names}
            if held and held[0][key] != row[key]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def document_slices(documents: DataFrame) -> DataFrame:
    """The words of some megabytes of documents a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", SLICE_BYTES):
            texts = [letters_and_digits(t or b"") for t in b.column("text").to_pylist()]
            lens = [t.count(b" ") + 1 if t else 0 for t in texts]
            joined = b" ".join(t for t in texts if t)
            yield _batch(SLICES, [(b.column("doc_id").to_pylist(), lens, sum(lens), _pack(joined))])

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return source.mapInArrow(run, SLICES).withColumn("slice", F.monotonically_increasing_id())


def _word_hashes(joined: bytes) -> np.ndarray:
    return ngram_hashes(joined, 1, word_spans(joined))


def heavy_words(texts: DataFrame, many: int) -> np.ndarray:
    """Hashes of the words with more than 1 / ``HEAVY`` of a bucket's tokens, and some with half of that.

    A slice counts those that have half such a share of its own words: a word's occurrences
    elsewhere are less than half of all, so half of the limit is asked of the sum. The found words are
    at most 2 * ``HEAVY`` for each bucket."""
    if many == 1:
        return np.empty(0, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for packed in b.column("words").to_pylist():
                words, n = np.unique(_word_hashes(_unpack(packed)), return_counts=True)
                often = n * (2 * HEAVY * many) >= n.sum()
                yield _batch("word long, n long", [*zip(words[often].view(np.int64).tolist(), n[often].tolist())])

    counts = texts.select("words").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = counts.filter(F.col("n") * (2 * HEAVY) > BUCKET).select("word").collect()
    return np.array([r["word"] for r in found], np.int64).view(np.uint64)


def _short(words: np.ndarray) -> bytes:
    """The low bytes of the hashes."""
    return np.ascontiguousarray(words.view(np.uint8).reshape(-1, 8)[:, :AFTER_BYTES]).tobytes()


def _long(rows: list[dict], column: str) -> np.ndarray:
    low = _join(rows, column, np.uint8).reshape(-1, AFTER_BYTES)
    out = np.zeros((len(low), 8), np.uint8)
    out[:, :AFTER_BYTES] = low
    return out.reshape(-1).view(np.uint64)


def word_buckets(words: np.ndarray, many: int) -> np.ndarray:
    return (mix(words) % np.uint64(many)).astype(np.int64)


@dataclass(frozen=True)
class Slice:
    """A slice's distinct words (the marks first) and its distinct bigrams, ordered by bucket and word before."""

    words: np.ndarray
    before: np.ndarray  # places in words
    after: np.ndarray
    bucket: np.ndarray
    tokens: np.ndarray  # each token's bigram, then that of each document's end
    lens: np.ndarray  # of the documents that have words

    @classmethod
    def of(cls, packed: bytes, lens: list[int], hot: np.ndarray, many: int) -> Slice:
        at, kinds = pd.factorize(_word_hashes(_unpack(packed)))
        words, at = np.concatenate([MARKS, kinds.astype(np.uint64)]), at + len(MARKS)
        full = np.array([n for n in lens if n], np.int64)
        ends = np.cumsum(full)
        before = np.concatenate([[START], at[:-1]])[: len(at)]
        before[ends - full] = START
        code = np.concatenate([before * len(words) + at, at[ends - 1] * len(words) + END])
        gram, codes = pd.factorize(code)
        before, after = codes // len(words), codes % len(words)
        spread = np.isin(words, hot)[before]
        key = words[before]
        key[spread] = mix(key[spread] + words[after[spread]])
        bucket = word_buckets(key, many)
        order = np.argsort(bucket * len(words) + before, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return cls(words, before[order], after[order], bucket[order], place[gram], full)


def requests(packed: bytes, lens: list[int], wanted: list[int], hot: np.ndarray, many: int) -> Iterator[tuple]:
    """bucket, then the arrays of a slice's bigrams for it: words before and how many bigrams each
    has, words after, counts in all documents and in the ``wanted`` ones."""
    s = Slice.of(packed, lens, hot, many)
    chosen = np.zeros(len(lens), bool)
    chosen[wanted] = True
    chosen = chosen[np.array(lens, np.int64) > 0]
    n = np.bincount(s.tokens, minlength=len(s.before)).astype(np.int32)
    target = np.bincount(s.tokens[np.concatenate([np.repeat(chosen, s.lens), chosen])], minlength=len(s.before)).astype(np.int32)
    edges = np.flatnonzero(np.diff(s.bucket)) + 1
    for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(s.bucket)]):
        if hi > lo:
            heads = np.concatenate([[0], np.flatnonzero(np.diff(s.before[lo:hi])) + 1])
            runs = np.diff(np.concatenate([heads, [hi - lo]])).astype(np.int32)
            counts = (n[lo:hi].tobytes(), target[lo:hi].tobytes())
            yield int(s.bucket[lo]), s.words[s.before[lo + heads]].tobytes(), runs.tobytes(), _short(s.words[s.after[lo:hi]]), *counts


def _join(rows: list[dict], column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(r[column] for r in rows), kind)


def bucket_sums(rows: list[dict], many_words: int) -> Iterator[tuple]:
    """Rows of SUMS from all requests to a bucket."""
    before, b = pd.factorize(np.repeat(_join(rows, "before", np.uint64), _join(rows, "runs", np.int32)))
    after, a = pd.factorize(_long(rows, "after"))
    gram, codes = pd.factorize(before * len(a) + after)
    n, target = (np.bincount(gram, weights=_join(rows, c, np.int32)).astype(np.int64) for c in ("n", "target"))
    lo = 0
    for r in rows:
        mine = gram[lo : lo + len(r["after"]) // AFTER_BYTES]
        lo += len(mine)
        yield 0, r["slice"], r["bucket"], None, _pack(np.stack([n[mine], target[mine]]).tobytes())
    before, inside = codes // len(a), a[codes % len(a)] != MARKS[END] & LOW
    sums = np.stack([
        np.bincount(before, weights=w, minlength=len(b)).astype(np.int64)
        for w in (n, target, n * inside, target * inside, inside, inside & (target > 0))
    ])
    at = word_buckets(b, many_words)
    for k in np.unique(at).tolist():
        yield 1, -1, k, b[at == k].tobytes(), _pack(np.ascontiguousarray(sums[:, at == k]).tobytes())


def word_figures(rows: list[dict]) -> Iterator[tuple]:
    """Rows of FIGURES from all sums of a bucket's words and all requests for them."""
    at, words = pd.factorize(_join(rows, "keys", np.uint64))
    total, lo = np.zeros((6, len(words)), np.int64), 0
    for r in rows:
        mine = at[lo : lo + len(r["keys"]) // 8]
        lo += len(mine)
        if r["slice"] < 0:
            total[:, mine] += _figures(r["data"], 6)  # a word once in each of these rows
    lo = 0
    for r in rows:
        mine = at[lo : lo + len(r["keys"]) // 8]
        lo += len(mine)
        if r["slice"] >= 0:
            yield 0, r["slice"], r["bucket"], _pack(np.ascontiguousarray(total[:, mine]).tobytes()), 0, 0, 0
    real = (words != MARKS[START]) & (total[0] > 0)
    yield 1, -1, rows[0]["bucket"], None, int(total[0, real].sum()), int(total[1, real].sum()), int(real.sum())


def word_order(words: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a slice's words (but for the end mark), and the order in which it asks for them."""
    at = word_buckets(words, many)
    order = np.argsort(at, kind="stable")
    return at, order[order != END]


def costs(n: np.ndarray, before: np.ndarray, after: np.ndarray, word: np.ndarray, seen: np.ndarray, kinds: np.ndarray, total: int) -> np.ndarray:
    """-ln p of bigrams: their counts, their words' places, and by word how often it occurs, how
    often it comes before another and how many kinds follow; ``total`` is the sum of the unigrams."""
    back = np.where(seen > 0, DISCOUNT * kinds / np.maximum(seen, 1), 1.0)
    return -np.log(np.maximum(n - DISCOUNT, 0) / np.maximum(seen, 1)[before] + back[before] * ((word + 1) / total)[after])


def scores(s: Slice, doc_ids: list, lens: list[int], grams: np.ndarray, figures: np.ndarray, totals: tuple[int, int]) -> list[tuple]:
    """Rows of SCORES of a slice's documents."""
    means = []
    for k in (1, 0):
        cost = costs(grams[k], s.before, s.after, figures[k], figures[2 + k], figures[4 + k], totals[k])
        of_tokens = cost[s.tokens[: int(s.lens.sum())]]
        means.append(iter((np.add.reduceat(of_tokens, np.cumsum(s.lens) - s.lens) / s.lens).tolist() if len(s.lens) else ()))
    rows = []
    for doc, n in zip(doc_ids, lens):
        t, b = (next(m) if n else None for m in means)
        rows.append((doc, n, t, b, t - b if n else None))
    return rows


def _dealt(rows: DataFrame, key: str, many: int, run: Callable, schema: str) -> DataFrame:
    """``run`` on the rows of each value of ``key``, in ``many`` partitions."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, key):
            for row in run(group):
                yield _batch(schema, row if isinstance(row, list) else [row])

    order = [c for c in (key, "slice", "kind", "bucket") if c in rows.columns]
    return rows.repartition(many, key).sortWithinPartitions(*dict.fromkeys(order)).mapInArrow(work, schema)


def cross_entropy_difference(spark: SparkSession, documents: DataFrame, target_ids: DataFrame) -> DataFrame:
    """Scores all documents; the target set is the documents whose doc_id is in ``target_ids``.
    Per document row: doc_id, n_tokens, ce_target, ce_background, ce_diff (nats a token)."""
    ws = session_workspace(spark)
    texts = ws.stage(document_slices(documents), "slices")
    size = texts.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    many = max(1, -(-(size[0] or 0) // BUCKET))
    many_words, many_slices = max(1, many // 4), max(1, size[1])
    hot = np.concatenate([MARKS[[START]], heavy_words(texts, many)])  # every document begins with the mark

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "slice"):
            for r in group:
                for bucket, *arrays in requests(r["words"], r["lens"], r["wanted"] or [], hot, many):
                    yield _batch(REQUESTS, [(bucket, r["slice"], *arrays)])

    ids = texts.select("slice", F.posexplode("doc_ids").alias("at", "doc_id"))
    wanted = ids.join(target_ids.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("slice").agg(F.collect_list("at").alias("wanted"))
    asked = texts.select("slice", "lens", "words").join(wanted, "slice", "left").mapInArrow(ask, REQUESTS)
    sums = ws.stage(_dealt(asked, "bucket", many, lambda g: bucket_sums(g, many_words), SUMS), "sums")

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "slice"):
            for r in group:
                words = np.concatenate([MARKS, pd.unique(_word_hashes(_unpack(r["words"])))])
                at, order = word_order(words, many_words)
                for k in np.unique(at[order]).tolist():
                    yield _batch(SUMS, [(0, r["slice"], k, words[order[at[order] == k]].tobytes(), None)])

    asked_words = texts.select("slice", "words").mapInArrow(ask_words, SUMS).union(sums.filter("kind = 1"))
    figures = ws.stage(_dealt(asked_words, "bucket", many_words, word_figures, FIGURES), "figures")
    n, n_target, n_words = figures.filter("kind = 1").agg(F.sum("background"), F.sum("target"), F.sum("words")).first()
    cells = max(VOCABULARY, FIRST + (n_words or 0)) - 1  # the start mark never follows
    totals = ((n or 0) + cells, (n_target or 0) + cells)

    def put_together(group: list[dict]) -> Iterator[list[tuple]]:
        first, rest = group[0], group[1:]
        s = Slice.of(first["data"], first["lens"], hot, many)
        grams = [_figures(r["data"], 2) for r in rest if r["kind"] == 1]
        by_word = np.zeros((6, len(s.words)), np.int64)
        by_word[:, word_order(s.words, many_words)[1]] = np.concatenate([_figures(r["data"], 6) for r in rest if r["kind"] == 2], axis=1)
        yield scores(s, first["doc_ids"], first["lens"], np.concatenate(grams, axis=1) if grams else np.zeros((2, 0), np.int64), by_word, totals)

    nothing = [F.lit(None).cast("array<long>").alias("doc_ids"), F.lit(None).cast("array<int>").alias("lens")]
    answers = sums.filter("kind = 0").select("slice", F.lit(1).alias("kind"), "bucket", *nothing, "data").union(
        figures.filter("kind = 0").select("slice", F.lit(2).alias("kind"), "bucket", *nothing, "data")
    )
    own = texts.select("slice", F.lit(0).alias("kind"), F.lit(0).alias("bucket"), "doc_ids", "lens", F.col("words").alias("data"))
    return _dealt(own.union(answers), "slice", many_slices, put_together, SCORES)
