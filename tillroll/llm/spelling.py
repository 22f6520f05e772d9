"""Spelling variants of a corpus' words, found with k-d trees over letter counts.

A word's letters, counted, are a point. One inserted or deleted letter moves the point by an L1
distance of exactly 1, one replaced letter by exactly 2, and words of the same letters are never one
edit apart. So the near words of a word of length L are looked for in the trees of length L (radius 2)
and L + 1 (radius 1): a range search prunes every box that is farther away, and of the points
that are left the words' letter order is verified. Words that differ by a deletion are found from the
shorter one and reported for both.

On Spark:

1. Tasks count the runs of whole texts (cut between runs where a text is very long) in a table of
   bounded size; Spark adds the counts up. A word that is a third of all rows is one row a task.
2. A k-d tree over all letters is fitted per length to a bounded sample of the words (``SAMPLE``; only the
   cells' borders depend on it). Its leaves are cells of some ``CELL_WORDS`` words; cells with more
   (many words of the same letters can't be parted) are dealt over pieces, and so are the queries.
3. Each word is stored in its own cell, and goes as a query to the cells within reach of it.
4. A task builds the k-d tree of a piece of a cell (over distinct letter counts) and searches it with
   all queries that came, in batches: whole groups of queries go down the tree together.
5. Near words are counted per word; of the forms a word's own is the most frequent. A word's root is
   found by doubling the steps along the forms, each of which is five times as frequent as the one before.

Defined cases: a null or empty text has no words; a null ``doc_id`` counts as an empty one in the key of
a run; repeated rows are rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import session_workspace, slices

RUN = re.compile("[A-Za-zÀ-ÿ]+")
BREAK = re.compile("[^A-Za-zÀ-ÿ]")
LOWER = {c: c + 32 for c in range(65, 91)}
#: Every 199th (word, document) loses a letter; words of at least 6 letters and 5 occurrences take part;
#: a form is at least 5 times as frequent.
DROP_EVERY, LEAST_LETTERS, LEAST_N, TIMES = 199, 6, 5, 5
PIECE_CHARS, HELD_WORDS = 1 << 20, 1 << 17
SAMPLE, CELL_WORDS, CELL_QUERIES = 1 << 14, 1 << 14, 1 << 17
LEAF, BATCH = 16, 1 << 12
#: Points: counts of the letters a-z and U+00C0-U+00FF.
LETTERS = 26 + 64
COUNTED = "word string, n long"
SIDES = "width int, cell int, piece int, part int, kind int, word string, n long"
NEAR = "word string, n_near long, best_n long, best string"


def pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces of some ``size`` characters, cut where no run is."""
    lo = 0
    while lo < len(text):
        found = BREAK.search(text, lo + size)
        hi = found.start() if found else len(text)
        yield text[lo:hi]
        lo = hi


def words_of(doc_id: int | None, text: str) -> Iterator[tuple[str, int]]:
    """(word, count) of a text, after the deletions; a word may come several times."""
    key = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for piece in pieces(text):
        for run, n in Counter(RUN.findall(piece.translate(LOWER))).items():
            h = zlib.crc32(run.encode(), key)
            if h % DROP_EVERY == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= LEAST_LETTERS:
                yield run, n


def vocabulary(documents: DataFrame) -> DataFrame:
    """(word, n): the words of at least ``LEAST_LETTERS`` letters that occur ``LEAST_N`` times or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def emptied() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for b in slices(batches, "text"):
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                for word, n in words_of(doc_id, text or ""):
                    held[word] += n
                    if len(held) >= HELD_WORDS:
                        yield emptied()
        yield emptied()

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, COUNTED).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_N)


# ---------------------------------------------------------------- points and trees


def points(words: list[str]) -> np.ndarray:
    """A row of letter counts for each word."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
    letter = np.where(codes < 128, codes - 97, codes - 0xC0 + 26)
    of = np.repeat(np.arange(len(words)), [len(w) for w in words])
    # capital A-Z never occur here: they were lower-cased
    return np.bincount(of * LETTERS + letter, minlength=len(words) * LETTERS).reshape(-1, LETTERS).astype(np.int16 if max(map(len, words), default=0) < 1 << 14 else np.int32)


def box_distance(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """L1 distance of each row of ``q`` to a box."""
    return (np.maximum(low - q, 0) + np.maximum(q - high, 0)).sum(axis=1)


def split_at(x: np.ndarray) -> tuple[int, int] | None:
    """(letter, count) that parts rows most evenly into ``<= count`` and the rest; None if all are equal."""
    best, found = 0, None
    for d in np.flatnonzero(x.min(axis=0) != x.max(axis=0)).tolist():
        count = int(np.sort(x[:, d])[(len(x) - 1) // 2])
        for c in (count - 1, count):
            below = int((x[:, d] <= c).sum())
            if min(below, len(x) - below) > best:
                best, found = min(below, len(x) - below), (d, c)
    return found


@dataclass(frozen=True)
class Node:
    """A box, and either its two halves or (a leaf) the rows in it."""

    low: np.ndarray
    high: np.ndarray
    halves: tuple[Node, Node] | None
    rows: np.ndarray | None


def kd_tree(x: np.ndarray, rows: np.ndarray | None = None) -> Node:
    """Tree over distinct points; boxes are the least ones that hold the rows."""
    rows = np.arange(len(x)) if rows is None else rows
    mine = x[rows]
    low, high = mine.min(axis=0), mine.max(axis=0)
    cut = split_at(mine) if len(rows) > LEAF else None
    if cut is None:
        return Node(low, high, None, rows)
    below = mine[:, cut[0]] <= cut[1]
    return Node(low, high, (kd_tree(x, rows[below]), kd_tree(x, rows[~below])), None)


def range_pairs(tree: Node, x: np.ndarray, q: np.ndarray, radius: int, active: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of q, rows of x) at an L1 distance of exactly ``radius``."""
    active = np.arange(len(q)) if active is None else active
    active = active[box_distance(q[active], tree.low, tree.high) <= radius]
    if not len(active):
        return
    if tree.halves is not None:
        for half in tree.halves:
            yield from range_pairs(half, x, q, radius, active)
        return
    for lo in range(0, len(active), BATCH):
        some = active[lo : lo + BATCH]
        apart = np.abs(q[some][:, None, :] - x[tree.rows][None, :, :]).sum(axis=2)
        at, to = np.nonzero(apart == radius)
        yield some[at], tree.rows[to]


def edits(word: str, gone: str, come: str) -> Iterator[str]:
    """The words made of ``word`` by replacing one ``gone`` by ``come``, or by inserting ``come`` where
    ``gone`` is empty. Each result once."""
    if gone:
        at = word.find(gone)
        while at >= 0:
            yield word[:at] + come + word[at + 1 :]
            at = word.find(gone, at + 1)
    else:
        for at in range(len(word) + 1):
            if at == len(word) or word[at] != come:  # before an equal letter is the same as after it
                yield word[:at] + come + word[at:]


def letter(d: int) -> str:
    return chr(97 + d) if d < 26 else chr(0xC0 + d - 26)


class Cell:
    """The words of a piece of a cell, by their letter counts."""

    def __init__(self, words: list[str], n: list[int]):
        self.n = dict(zip(words, n))
        self.x = np.unique(points(words), axis=0)
        self.tree = kd_tree(self.x)

    def near(self, words: list[str]) -> Iterator[tuple[str, str]]:
        """(query, word of the cell) one edit apart; queries of one length, that of the cell or one less."""
        length = int(self.x[0].sum())
        by_point = {}
        for w in words:
            by_point.setdefault("".join(sorted(w)), []).append(w)
        groups = list(by_point.values())
        for lo in range(0, len(groups), BATCH):
            some = groups[lo : lo + BATCH]
            q = points([g[0] for g in some])
            radius = 1 if len(some[0][0]) < length else 2
            for at, to in range_pairs(self.tree, self.x, q, radius):
                moved = self.x[to] - q[at]
                come = moved.argmax(axis=1)
                gone = moved.argmin(axis=1) if radius == 2 else None
                for i, g in enumerate(at.tolist()):
                    if radius == 2 and moved[i, come[i]] != 1:
                        continue  # two letters more for two fewer is no single edit
                    minus = letter(int(gone[i])) if radius == 2 else ""
                    for w in some[g]:
                        for made in edits(w, minus, letter(int(come[i]))):
                            if made in self.n:
                                yield w, made


# ---------------------------------------------------------------- cells


class Borders:
    """Half-space trees of the lengths, fitted to a sample: which cell a point is in, and which are within reach."""

    def __init__(self, sample: dict[int, np.ndarray], cells: dict[int, int]):
        self.trees = {length: self._fit(x, cells.get(length, 1), [0]) for length, x in sample.items()}

    @classmethod
    def _fit(cls, x: np.ndarray, cells: int, counter: list[int]):
        cut = split_at(x) if cells > 1 and len(x) > 1 else None
        if cut is None:
            counter[0] += 1
            return counter[0] - 1
        below = x[:, cut[0]] <= cut[1]
        return cut[0], cut[1], cls._fit(x[below], cells // 2, counter), cls._fit(x[~below], cells - cells // 2, counter)

    def homes(self, length: int, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for rows, cell in self._down(self.trees.get(length, 0), x, np.arange(len(x)), None, 0):
            out[rows] = cell
        return out

    def reached(self, length: int, x: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, int]]:
        """(rows, cell) for the cells of ``length`` whose half-spaces are within ``radius``."""
        yield from self._down(self.trees.get(length, 0), x, np.arange(len(x)), np.zeros((len(x), LETTERS), np.int32), radius)

    def _down(self, node, x: np.ndarray, rows: np.ndarray, gaps: np.ndarray | None, radius: int):
        if not len(rows):
            return
        if isinstance(node, int):
            yield rows, node
            return
        d, c, below, above = node
        for side, away in ((below, np.maximum(x[rows, d] - c, 0)), (above, np.maximum(c + 1 - x[rows, d], 0))):
            if gaps is None:
                yield from self._down(side, x, rows[away == 0], None, 0)
            else:
                there = gaps.copy()
                there[:, d] = np.maximum(there[:, d], away)
                stay = there.sum(axis=1) <= radius
                yield from self._down(side, x, rows[stay], there[stay], radius)


def fit_borders(words: DataFrame) -> Borders:
    """Cells of the lengths: as many as their words ask for, cut by a sample of at most ``SAMPLE`` words."""
    sizes = {r["width"]: r["count"] for r in words.groupBy("width").count().filter(F.col("count") > CELL_WORDS).collect()}
    if not sizes:
        return Borders({}, {})
    rows = words.filter(F.col("width").isin(list(sizes))).orderBy(F.xxhash64("word")).limit(SAMPLE).select("word").collect()
    by_length: dict[int, list[str]] = {}
    for r in rows:
        by_length.setdefault(len(r["word"]), []).append(r["word"])
    return Borders({k: points(v) for k, v in by_length.items()}, {k: min(-(-n // CELL_WORDS), SAMPLE // 16) for k, n in sizes.items()})


def placed(words: DataFrame, borders: Borders) -> DataFrame:
    """(width, cell, kind, word, n): each word in its cell (kind 0), and where it goes as a query (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "word", 1 << 20):
            rows = b.to_pandas()
            for length, some in rows.groupby(rows["word"].str.len()):
                x, word, n = points(some["word"].to_list()), some["word"].to_numpy(), some["n"].to_numpy(np.int64)
                homes = borders.homes(length, x)
                yield _side(np.full(len(x), length), homes, 0, word, n)
                for width, radius in ((length, 2), (length + 1, 1)):
                    for at, cell in borders.reached(width, x, radius):
                        yield _side(np.full(len(at), width), np.full(len(at), cell), 1, word[at], n[at])

    return words.select("word", "n").mapInArrow(run, "width int, cell int, kind int, word string, n long")


def _side(width, cell, kind, word, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(width, pa.int32()), pa.array(cell, pa.int32()), pa.array(np.full(len(width), kind), pa.int32()), pa.array(word, pa.string()), pa.array(n, pa.int64())],
        ["width", "cell", "kind", "word", "n"],
    )


def near_words(spark: SparkSession, words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of the words that have a near word."""
    ws = session_workspace(spark)
    at = ws.stage(placed(words, fit_borders(words)), "cells")
    sizes = at.groupBy("width", "cell").agg(F.count_if(F.col("kind") == 0).alias("members"), F.count_if(F.col("kind") == 1).alias("queries"))
    many, parts = (F.greatest(F.ceil(F.col(c) / size), F.lit(1)).cast("int").alias(a) for c, size, a in (
        ("members", CELL_WORDS * 2, "pieces"), ("queries", CELL_QUERIES, "parts")))
    sizes = sizes.filter("members > 0").select("width", "cell", many, parts)
    dealt = at.join(sizes, ["width", "cell"])  # cells without words of their own need no queries
    own_piece, own_part = (F.pmod(F.xxhash64("word", F.lit(s)), F.col(c)).cast("int") for s, c in ((1, "pieces"), (2, "parts")))
    everywhere = [F.sequence(F.lit(0), F.col(c) - 1) for c in ("pieces", "parts")]
    dealt = dealt.withColumn("_pieces", F.when(F.col("kind") == 0, F.array(own_piece)).otherwise(everywhere[0]))
    dealt = dealt.withColumn("_parts", F.when(F.col("kind") == 1, F.array(own_part)).otherwise(everywhere[1]))
    dealt = dealt.withColumn("piece", F.explode("_pieces")).withColumn("part", F.explode("_parts"))
    keys = ["width", "cell", "piece", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, members, cell, waiting = None, {}, None, {}
        for b in batches:
            rows = b.to_pandas()
            for key, some in rows.groupby(keys, sort=False):
                if key != met:
                    yield from _searched(cell, members, waiting)
                    met, members, cell, waiting = key, {}, None, {}
                own = some["kind"] == 0
                members.update(zip(some["word"][own], some["n"][own]))
                waiting.update(zip(some["word"][~own], some["n"][~own]))
                if len(waiting) >= BATCH * 4:  # members are sorted first, so the cell is complete
                    cell = cell or (Cell(list(members), list(members.values())) if members else None)
                    yield from _searched(cell, members, waiting)
                    waiting = {}
        yield from _searched(cell, members, waiting)

    searched = dealt.select(*keys, "kind", "word", "n").repartition(*keys).sortWithinPartitions(*keys, "kind").mapInArrow(run, NEAR)
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("_best")
    return searched.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("_best.n")).alias("best_n"), F.col("_best.word").alias("best")
    )


def _searched(cell: Cell | None, members: dict[str, int], queries: dict[str, int]) -> Iterator[pa.RecordBatch]:
    """NEAR rows of the queries, and of the members that are near a shorter query, one for each word."""
    if not members or not queries:
        return
    cell = cell or Cell(list(members), list(members.values()))
    found: dict[str, tuple[int, int, str]] = {}

    def add(word: str, n: int, other: str) -> None:
        many, best_n, best = found.get(word, (0, n, other))
        found[word] = many + 1, *((n, other) if (-n, other) < (-best_n, best) else (best_n, best))

    by_length: dict[int, list[str]] = {}
    for w in queries:
        by_length.setdefault(len(w), []).append(w)
    for same in by_length.values():
        for word, other in cell.near(same):
            add(word, members[other], other)
            if len(word) < len(other):
                add(other, queries[word], word)
    if found:
        cols = [list(found), *zip(*found.values())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()))], ["word", "n_near", "best_n", "best"])


def roots(spark: SparkSession, forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): the last word along the forms, by doubling the steps.
    Counts grow fivefold a step, so 64-bit counts allow 27 steps: five doublings reach them all."""
    ws = session_workspace(spark)
    steps = ws.stage(forms.select("word", F.col("form").alias("root")), "steps")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("_ahead"))
        longer = steps.join(ahead, "root", "left").select("word", F.coalesce("_ahead", "root").alias("root"), F.col("_ahead").isNotNull().alias("_moved"))
        longer = ws.stage(longer, "steps")
        steps = longer.select("word", "root")
        if longer.filter("_moved").isEmpty():
            return steps


def variants(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    ws = session_workspace(spark)
    words = ws.stage(vocabulary(documents).withColumn("width", F.char_length("word")), "words")
    near = words.join(near_words(spark, words.select("word", "n", "width")), "word", "left")
    has_form = F.col("best_n") >= TIMES * F.col("n")
    known = ws.stage(
        near.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has_form, F.col("best")).alias("form"),
            F.when(has_form, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    last = roots(spark, known.filter("form IS NOT NULL").select("word", "form"))
    return known.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
