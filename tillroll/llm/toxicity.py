"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts (P) and unlabelled texts (U) train a linear classifier on hashed words
and word beginnings, in numpy, with the class-prior corrected risk of Kiryo et al. (2017):

    prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)])        l(z) = 1 / (1 + exp(z))

When the second term would turn negative, the step goes against it (as published), so that the
classifier cannot fit U as all negative. The prior is the share of toxic rows among the
labelled training rows, counted by Spark over all of them. A feature's value is
``ln(1 + times)``; only features whose means in P and U differ by ``least_z`` standard errors
get a weight.

Only the fit uses a sample, bounded by ``most_positive`` and ``most_unlabelled`` documents (those
with the least hash of their id); texts are then scored whole and all.

Defined cases: null, empty and wordless texts get the score of no words (the intercept);
without positives, or without texts, every score is 0; labels without a document and
documents without a label are fine; repeated rows are rows; other columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import fresh, letters_and_digits, ngram_hashes, prefix_hashes, slices, word_spans

CELLS = 1 << 20
BEGINNINGS = (4, 5, 6, 7)
Features = tuple[np.ndarray, np.ndarray]  # cells (sorted), times


def word_cells(text: bytes | None) -> Features:
    """Cells of the words of a text and of their beginnings, and how often each occurs."""
    joined = letters_and_digits(text or b"")
    spans = word_spans(joined)
    hashes = [ngram_hashes(joined, 1, spans), *prefix_hashes(joined, BEGINNINGS, spans)]
    cells, times = np.unique((np.concatenate(hashes) & np.uint64(CELLS - 1)).astype(np.int32), return_counts=True)
    return cells, times.astype(np.min_scalar_type(int(times.max(initial=0))))  # the narrowest type that holds them


def _value(times: np.ndarray) -> np.ndarray:
    return np.log1p(times, dtype=np.float64).astype(np.float32)


@dataclass(frozen=True)
class ToxicityModel:
    weights: np.ndarray
    intercept: float

    def score(self, text: bytes | None) -> float:
        cells, times = word_cells(text)
        z = self.intercept + float(self.weights[cells] @ _value(times))
        if z == -np.inf:  # there was nothing to learn from
            return 0.0
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -50, 50))))


NEVER = ToxicityModel(np.zeros(CELLS, np.float32), -np.inf)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -50, 50)))


def differing(positive: list[Features], unlabelled: list[Features], least_z: float, least: int) -> np.ndarray:
    """Cells seen in ``least`` texts or more whose mean value differs between P and U."""
    seen, sums, squares = np.zeros(CELLS), [], []
    for group in (positive, unlabelled):
        cells, values = np.concatenate([c for c, _ in group]), _value(np.concatenate([t for _, t in group])).astype(float)
        seen += np.bincount(cells, minlength=CELLS)
        sums.append(np.bincount(cells, weights=values, minlength=CELLS))
        squares.append(np.bincount(cells, weights=values**2, minlength=CELLS))
    n_p, n_u = len(positive), len(unlabelled)
    mean = (sums[0] + sums[1]) / (n_p + n_u)
    spread = np.maximum((squares[0] + squares[1]) / (n_p + n_u) - mean**2, 1e-12)
    z = (sums[0] / n_p - sums[1] / n_u) / np.sqrt(spread * (1 / n_p + 1 / n_u))
    return np.flatnonzero((seen >= least) & (np.abs(z) >= least_z))


def fit(
    positive: list[Features], unlabelled: list[Features], prior: float, steps: int = 1200, batch: int = 256,
    rate: float = 0.05, decay: float = 1e-5, least: int = 8, least_z: float = 5.0, seed: int = 7,
) -> ToxicityModel:
    """nnPU with Adam on batches of ``batch`` positive and twice as many unlabelled texts."""
    used = differing(positive, unlabelled, least_z, least)
    place = np.full(CELLS, -1)
    place[used] = np.arange(len(used))

    def chosen(group: list[Features]) -> list[tuple[np.ndarray, np.ndarray]]:
        return [((p := place[c])[p >= 0], _value(t[p >= 0]).astype(float)) for c, t in group]

    pos, unl = chosen(positive), chosen(unlabelled)
    rng = np.random.default_rng(seed)
    w, b = np.zeros(len(used)), -1.0
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0

    def draw(group: list, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        picked = [group[i] for i in rng.integers(0, len(group), n)]
        cells, values = (np.concatenate([x[k] for x in picked]) for k in (0, 1))
        return cells, values, np.repeat(np.arange(n), [len(x[0]) for x in picked]), n

    def outputs(part: tuple) -> np.ndarray:
        return np.bincount(part[2], weights=w[part[0]] * part[1], minlength=part[3]) + b

    def slope(part: tuple, by_doc: np.ndarray) -> tuple[np.ndarray, float]:
        return np.bincount(part[0], weights=by_doc[part[2]] * part[1], minlength=len(used)).astype(float), float(by_doc.sum())

    for step in range(1, steps + 1):
        p, u = draw(pos, batch), draw(unl, 2 * batch)
        fp, fu = outputs(p), outputs(u)
        sp, su = _sigmoid(fp), _sigmoid(fu)
        negative = su.mean() - prior * sp.mean()
        gu, gub = slope(u, su * (1 - su) / u[3])
        gn, gnb = slope(p, prior * sp * (1 - sp) / p[3])
        if negative >= 0:  # the loss of P as positive has the slope -gn
            g, gb = gu - 2 * gn, gub - 2 * gnb
        else:
            g, gb = gn - gu, gnb - gub
        g += decay * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        lr = rate * (1 - (step - 1) / steps) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        w -= lr * m / (np.sqrt(v) + 1e-8)
        b -= lr * mb / (np.sqrt(vb) + 1e-8)
    weights = np.zeros(CELLS, np.float32)
    weights[used] = w
    return ToxicityModel(weights, float(b))


def _sample(documents: DataFrame, ids: DataFrame, most: int) -> list[Features]:
    """Features of the documents of at most ``most`` ids, those with the least hash."""
    picked = ids.distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            rows = [word_cells(t) for t in b.column("text").to_pylist()]
            cells = pa.array([c for c, _ in rows], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([cells, pa.array([t.tobytes() for _, t in rows], pa.binary())], ["cells", "times"])

    texts = documents.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(picked), "doc_id")
    got = texts.select("text").mapInArrow(run, "cells array<int>, times binary").limit(2 * most).toArrow()
    return [
        (cells := c.values.to_numpy(), np.frombuffer(raw := t.as_py(), f"u{len(raw) // max(len(cells), 1) or 1}"))
        for c, t in zip(got.column("cells"), got.column("times"))
    ]


def train(
    documents: DataFrame, labels: DataFrame, learn_from: Column, most_positive: int = 4_000, most_unlabelled: int = 8_000
) -> ToxicityModel:
    """Fit on rows (of documents and of labels) where ``learn_from``, a test of doc_id, holds."""
    known = labels.filter(learn_from & F.col("toxic").isNotNull()).select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    share = known.agg(F.avg("toxic").alias("prior"), F.sum("toxic").alias("n")).first()
    if not share["n"]:
        return NEVER
    positive = _sample(documents, known.filter("toxic = 1").select("doc_id"), most_positive)
    unlabelled = _sample(documents, documents.filter(learn_from).select("doc_id"), most_unlabelled)
    if not positive or not unlabelled:
        return NEVER
    prior = min(max(float(share["prior"]), 1e-4), 0.9)
    return fit(positive, unlabelled, prior)


def score(spark: SparkSession, documents: DataFrame, model: ToxicityModel, into: str = "score") -> DataFrame:
    """The documents' columns with the score; only ``text`` is looked at."""
    sent = spark.sparkContext.broadcast(model)

    own = fresh("_text", [*documents.columns, into])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in slices(batches, own):
            got = pa.array([m.score(t) for t in b.column(own).to_pylist()], pa.float64())
            rest = b.select([n for n in b.schema.names if n != own])
            yield pa.RecordBatch.from_arrays([*rest.columns, got], [*rest.schema.names, into])

    kept = documents.select(*[F.col(f"`{c}`") for c in documents.columns if c != into])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    source = documents.select(*[F.col(f"`{c}`") for c in kept.columns], F.col("text").cast("binary").alias(own))
    return source.mapInArrow(run, f"{fields}, `{into}` double")
