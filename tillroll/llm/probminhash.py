"""Near-duplicate groups by ProbMinHash, banding and verification.

A text is the weighted set of its five-word shingles (a shorter text is one shingle), with
weight ``1 + ln(times it occurs)``. Similarity is the probability Jaccard

    J_P(x, y) = sum over d in both of 1 / sum over e of max(x_e / x_d, y_e / y_d)

which is the plain Jaccard where no shingle repeats. A register of the signature matches with
just this probability: the shingles are Poisson processes of rate weight whose arrivals fall
into registers at random, a register keeps its earliest arrival, and a shingle stops as soon
as its next arrival comes after the latest register (early termination).

1. Texts with the same words are one class; only classes go on.
2. Bands of ``rows`` registers; classes that share a band are candidates. Each bucket is first
   joined in a star to its least class (rows, not pairs) and verified on the words; links make
   components.
3. Buckets that still hold several components are compared in blocks of bounded size, so that no
   task gets a whole hot bucket. Inside a pair of blocks texts are compared exactly, and only
   the links that join components are emitted (never the pairs). Components are made anew.

Every candidate that two classes' bands give is thus verified or lies inside one component:
no link between different texts is dropped beyond the banding's own chance (1.5e-4 at a
similarity of 0.8, less above).

Components are found by rounds of minimum labels with pointer jumping over staged tables.
Nothing of the documents passes through the driver but a fixed-size bit table and counts.

Defined cases: texts without words (null, empty, signs only) are groups of their own;
repeated rows and repeated or null ``doc_id`` are documents of their own, ties go to the least
row; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import (
    Workspace,
    bit_table,
    in_table,
    letters_and_digits,
    mix,
    ngram_hashes,
    row_key,
    session_workspace,
    slices,
    word_spans,
)

SHINGLE, THRESHOLD, BANDS, ROWS = 5, 0.8, 50, 8
BLOCK, BLOCK_BYTES = 256, 8 << 20
#: Partners of a star's centre that a task verifies with one copy of the centre's text.
PIECE = 256
SIGNATURES = "uid long, doc_id long, words_hash binary, signature binary"


def weighted_shingles(joined: bytes, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (sorted) and weights."""
    spans = word_spans(joined)
    if not len(spans[0]):
        return np.empty(0, np.uint64), np.empty(0)
    hashes, times = np.unique(ngram_hashes(joined, min(n, len(spans[0])), spans), return_counts=True)
    return hashes, 1.0 + np.log(times)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact J_P of two weighted sets."""
    (ha, wa), (hb, wb) = a, b
    if not len(ha) or not len(hb):
        return 0.0
    union = np.union1d(ha, hb)
    x, y = np.zeros(len(union)), np.zeros(len(union))
    x[np.searchsorted(union, ha)] = wa
    y[np.searchsorted(union, hb)] = wb
    both = (x > 0) & (y > 0)
    ratios, which = np.unique(x[both] / y[both], return_inverse=True)
    sums = np.array([np.maximum(x, r * y).sum() for r in ratios])
    return float((x[both] / sums[which]).sum()) if len(ratios) else 0.0


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], registers: int) -> np.ndarray:
    """ProbMinHash signatures (low byte of the winning shingle) of a batch of weighted sets.

    Round i gives every shingle that is still alive its i-th arrival; shingles whose arrival
    is later than the latest register of their document are done.
    """
    many = len(sets)
    first = np.full(many * registers, np.inf)
    winner = np.zeros(many * registers, np.uint8)
    latest = np.full(many, np.inf)
    doc = np.repeat(np.arange(many), [len(h) for h, _ in sets])
    h = np.concatenate([h for h, _ in sets]) if many else np.empty(0, np.uint64)
    w = np.concatenate([w for _, w in sets]) if many else np.empty(0)
    seed, at, i = mix(h), np.zeros(len(h)), 0
    while len(h):
        i += 1
        draw = mix(seed + np.uint64(i * 0xD1342543DE82EF95 & (1 << 64) - 1))
        at = at - np.log(((draw >> np.uint64(32)).astype(np.float64) + 0.5) * 2.0**-32) / w
        alive = at < latest[doc]
        if not alive.all():
            h, w, seed, at, doc, draw = h[alive], w[alive], seed[alive], at[alive], doc[alive], draw[alive]
        slot = doc * registers + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(registers)) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(first, slot, at)
        won = first[slot] == at
        winner[slot[won]] = (h[won] >> np.uint64(8)).astype(np.uint8)
        if i % 4 == 0 or i < 4:
            latest = first.reshape(many, registers).max(axis=1)
    return winner.reshape(many, registers)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated J_P of rows of signatures of one byte a register."""
    same = (a == b).mean(axis=-1)
    return (same - 1 / 256) / (1 - 1 / 256)


def document_signatures(documents: DataFrame, registers: int, uid: str | None = None) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            keys, sets, at = [], [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                joined = letters_and_digits(text or b"")
                keys.append(xxhash.xxh3_128_digest(joined) if joined else None)
                if joined:
                    sets.append(weighted_shingles(joined))
                    at.append(i)
            rows: list = [None] * len(keys)
            for i, s in zip(at, signatures(sets, registers)):
                rows[i] = s.tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column("uid"), b.column("doc_id"), pa.array(keys, pa.binary()), pa.array(rows, pa.binary())],
                ["uid", "doc_id", "words_hash", "signature"],
            )

    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")]
    return documents.select(row_key(uid), *columns).mapInArrow(run, SIGNATURES)


def class_words(documents: DataFrame, wanted: np.ndarray) -> DataFrame:
    """words_hash, words of the texts whose hash may be wanted; one row per hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            texts = [letters_and_digits(t or b"") for t in b.column("text").to_pylist()]
            keys = [xxhash.xxh3_128_digest(t) for t in texts]
            low = np.frombuffer(b"".join(keys), ">i8")[1::2].astype(np.int64)
            rows = dict((keys[i], texts[i]) for i in np.flatnonzero(in_table(wanted, low)).tolist() if texts[i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(rows), pa.binary()), pa.array(list(rows.values()), pa.binary())], ["words_hash", "words"]
            )

    texts = documents.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "words_hash binary, words binary")
    return texts.groupBy("words_hash").agg(F.first("words").alias("words"))


def verified(pairs: DataFrame, words: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts' exact similarity reaches the threshold.

    The partners of an ``a`` are dealt to pieces of some ``PIECE``; a piece gets the text of ``a`` once and
    that of each partner once, in order, so that a task holds two texts at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre: tuple = (None, None)
        for batch in slices(batches, "words"):
            found = []
            for a, c, w in zip(*(batch.column(name).to_pylist() for name in ("a", "class", "words"))):
                if c == a:
                    centre = (a, weighted_shingles(w))
                elif centre[0] != a:
                    raise ValueError("a piece begins with the text of its first class")
                elif probability_jaccard(centre[1], weighted_shingles(w)) >= threshold:
                    found.append((a, c))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    pieces = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PIECE).alias("pieces"))
    partners = pairs.join(pieces, "a").select("a", F.pmod(F.xxhash64("b"), F.col("pieces")).alias("piece"), F.col("b").alias("class"))
    centres = partners.select("a", "piece").distinct().withColumn("class", F.col("a"))
    return (
        partners.union(centres).join(words, "class").select("a", "piece", "class", "words")
        .repartition("a", "piece").sortWithinPartitions("a", "piece", F.col("class") != F.col("a"), "class")
        .select("a", "class", "words").mapInArrow(run, "a long, b long")
    )


def components(ws: Workspace, links: DataFrame) -> DataFrame:
    """node, label (least node of its component) for the nodes of ``links`` (a, b)."""
    both = ws.stage(links.union(links.select("b", "a")).toDF("node", "other"), "links")
    labels = ws.stage(
        both.groupBy("node").agg(F.min("other").alias("o")).select("node", F.least("node", "o").alias("label")), "labels"
    )
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("m"))
        lower = ws.stage(
            labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label")), "lower"
        )
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        labels_now = ws.stage(lower.join(jump, "label").select("node", "old", F.least("label", "next").alias("label")), "labels")
        if labels_now.filter(F.col("old") != F.col("label")).isEmpty():
            return labels_now.select("node", "label")
        labels = labels_now.select("node", "label")


def block_links(cls: np.ndarray, label: np.ndarray, own: np.ndarray, i: int, j: int, texts: list[bytes], threshold: float):
    """Links (a, b) of a similarity of ``threshold`` or more between block i and block j that join
    different components; a pair that other links of the blocks have joined already is left out.

    A text is compared with all of a block at once: its shingles are marked in a table of all
    the blocks' shingles, and the marks are summed per text. Where no shingle repeats this
    gives the exact similarity; elsewhere it decides which pairs are computed in full.
    """
    sets = [weighted_shingles(t) for t in texts]
    _, place = np.unique(np.concatenate([h for h, _ in sets]), return_inverse=True)
    ends = np.cumsum([len(h) for h, _ in sets])
    starts = ends - np.array([len(h) for h, _ in sets])
    sizes = (ends - starts).astype(float)
    plain = np.array([bool((w == 1.0).all()) for _, w in sets])
    mark = np.zeros(len(place) + 1, np.int64)
    group = {x: x for x in label.tolist()}

    def find(x: int) -> int:
        while group[x] != x:
            group[x] = group[group[x]]
            x = group[x]
        return x

    left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    for x in left.tolist():
        to = right[(label[right] != label[x]) & ((cls[right] > cls[x]) if i == j else True)]
        if not len(to):
            continue
        mine = place[starts[x] : ends[x]]
        mark[mine] = 1
        shared = np.add.reduceat(mark[place], starts)[to]
        mark[mine] = 0
        jaccard = shared / (sizes[x] + sizes[to] - shared)
        exact = plain[x] & plain[to]
        for y, similar, known in zip(to.tolist(), jaccard.tolist(), exact.tolist()):
            if known and similar < threshold or similar == 0 or find(int(label[x])) == find(int(label[y])):
                continue
            if known or probability_jaccard(sets[x], sets[y]) >= threshold:
                group[find(int(label[x]))] = find(int(label[y]))
                yield int(min(cls[x], cls[y])), int(max(cls[x], cls[y]))


def _links_of_blocks(threshold: float):
    """Rows sorted by (bucket, i, j) -> verified links. A group holds two blocks; one that Arrow
    batches cut apart is put together first."""

    def links(group: pa.Table) -> pa.RecordBatch:
        cls, label, own = (group.column(c).to_numpy() for c in ("class", "label", "block"))
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        found = list(block_links(cls, label, own, i, j, group.column("words").to_pylist(), threshold))
        a, b = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]).combine_chunks() if held is not None else rows
            key = np.stack([rows.column(c).to_numpy() for c in ("bucket", "i", "j")])
            edges = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *edges[:-1].tolist()], edges.tolist()):
                yield links(rows.slice(lo, hi - lo))
            held = rows.slice(int(edges[-1]) if len(edges) else 0)
        if held is not None:
            yield links(held)

    return run


def near_duplicates(
    spark: SparkSession, documents: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
    uid: str | None = None,
) -> DataFrame:
    """One row per document row: uid (its key in the column ``uid``, else a number of its own),
    doc_id, class_id (the least doc_id of its group), group_size, kept (true for one row of each
    group)."""
    ws = session_workspace(spark)
    docs = ws.stage(document_signatures(documents, bands * rows, uid), "signatures")
    classes = ws.stage(
        docs.filter(F.col("words_hash").isNotNull()).groupBy("words_hash")
        .agg(F.min("uid").alias("class"), F.first("signature").alias("signature")), "classes",
    )
    band = F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda k: F.xxhash64(k, F.substring("signature", k * rows + 1, F.lit(rows))),
    ))
    banded = classes.select("class", band.alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("class").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = ws.stage(banded.join(shared, "bucket"), "members")

    stars = members.filter(F.col("class") != F.col("least")).select(F.col("least").alias("a"), F.col("class").alias("b")).distinct()
    near = ws.stage(stars, "near")

    key = F.conv(F.hex(F.substring("words_hash", 9, 8)), 16, -10).cast("long")

    def words_of(pairs: DataFrame, name: str) -> DataFrame:
        nodes = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
        named = ws.stage(classes.join(nodes, "class").select("class", "words_hash", key.alias("low")), f"{name}-nodes")
        return ws.stage(
            class_words(documents, bit_table(named, "low")).join(named, "words_hash").select("class", "words"), f"{name}-words"
        )

    links = ws.stage(verified(near, words_of(near, "star"), threshold), "verified")
    labels = components(ws, links)

    labelled = (
        members.filter(F.col("n") > 2).join(labels.select(F.col("node").alias("class"), "label"), "class", "left")
        .withColumn("label", F.coalesce("label", "class"))
    )
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("bucket")
    left = ws.stage(
        labelled.filter(F.col("class") != F.col("least")).join(mixed, "bucket").select("bucket", "class", "label"), "mixed"
    )
    if not left.isEmpty():
        words = words_of(left.select(F.col("class").alias("a"), F.col("class").alias("b")), "mixed")
        in_bytes = left.join(words.select("class", F.length("words").alias("bytes")), "class")
        blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("bytes") / BLOCK_BYTES)).cast("int")
        bucket_blocks = in_bytes.groupBy("bucket").agg(blocks.alias("blocks"))
        spread = (
            left.join(bucket_blocks, "bucket")
            .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
            .join(words, "class").select("bucket", "i", "j", "class", "label", "block", "words")
            .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
        )
        more = ws.stage(spread.mapInArrow(_links_of_blocks(threshold), "a long, b long"), "more")
        if not more.isEmpty():
            labels = components(ws, links.union(more).distinct())

    named = classes.join(labels.withColumnRenamed("node", "class"), "class", "left").select(
        "words_hash", F.coalesce("label", "class").alias("group")
    )
    grouped = ws.stage(
        docs.select("uid", "doc_id", "words_hash").join(named, "words_hash", "left")
        .select("uid", "doc_id", F.coalesce("group", "uid").alias("group")), "grouped",
    )
    sizes = ws.stage(
        grouped.groupBy("group").agg(
            F.min("doc_id").alias("class_id"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "uid")).alias("first"),
            F.count(F.lit(1)).alias("group_size"),
        ).select("group", "class_id", F.col("first.uid").alias("kept_uid"), "group_size"), "sizes",
    )
    return grouped.join(sizes, "group").select(
        "uid", "doc_id", "class_id", "group_size", (F.col("uid") == F.col("kept_uid")).alias("kept")
    )
