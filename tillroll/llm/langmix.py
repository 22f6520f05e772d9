"""Language identification as a mixture of languages, fitted by expectation-maximisation.

Per language a model of letter trigrams (hashed into a fixed number of cells) is counted by
Spark over all labelled texts and smoothed. A document's trigrams are taken as draws from a
mixture of the languages' models; EM estimates the proportions. The language set is the one
of the nested sets (largest proportion first) with the best penalised likelihood

    2 * log-likelihood / order - penalty * |set| * ln(trigrams)

(divided by the order, as overlapping trigrams tell the same letters that many times). The
prediction is the largest language of the chosen set, its score its proportion there.

Counts are added up per task in dense arrays and merged by Spark; what reaches the driver is
bounded by languages x cells, whatever the input.

Defined cases: a null text or one without a letter is ``und`` with score 0 and no languages;
without any labelled text every text is ``und``; rows with null ``lang`` or null ``doc_id`` are
not learnt from; repeated rows are rows; ties go to the language that sorts first; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import fresh, mix, slices

ORDER, CELLS = 3, 1 << 14
_HELD = 32


def held_out(doc_id: Column, modulus: int, value: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(modulus)) == value, F.lit(False))


class _Letters:
    """Which code points are letters (one byte each), built once per process."""

    table: np.ndarray | None = None

    @classmethod
    def get(cls) -> np.ndarray:
        if cls.table is None:
            cls.table = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
        return cls.table


def cells(text: str) -> np.ndarray | None:
    """Cells of the text's trigrams of lower-case letters, runs of anything else being one gap;
    None if there is no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _Letters.get()[points]
    if not letter.any():
        return None
    points = np.where(letter, points, 0)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first of a run of other characters
    kept = np.concatenate([[0], points[keep], [0]]).astype(np.uint64)
    code = (kept[:-2] << np.uint64(42)) | (kept[1:-1] << np.uint64(21)) | kept[2:]
    return (mix(code) & np.uint64(CELLS - 1)).astype(np.int64)


@dataclass(frozen=True)
class LanguageModels:
    languages: tuple[str, ...]
    logp: np.ndarray  # cells x languages, float32
    penalty: float = 1.0

    def mixture(self, text: str | None) -> tuple[str, float, list[tuple[str, float]]]:
        """Prediction, score, and the chosen languages with their proportions."""
        found = cells(text) if text and self.languages else None
        if found is None:
            return "und", 0.0, []
        kinds, times = np.unique(found, return_counts=True)
        logp = self.logp[kinds].astype(np.float64)
        total = times.sum()
        price = self.penalty * np.log(total + 1.0)
        alone = times @ logp
        best_one = int(np.argmax(alone))
        every = len(self.languages)
        if every == 1:
            return self.languages[0], 1.0, [(self.languages[0], 1.0)]
        p = np.exp(logp - logp.max(axis=1, keepdims=True))
        base = float(times @ logp.max(axis=1))
        share, most = em(p, times, np.full(every, 1.0 / every))
        order = np.argsort(-share, kind="stable")
        chosen, best = (best_one,), 2 * alone[best_one] / ORDER - price
        weight = np.ones(1)
        for k in range(2, every + 1):
            if 2 * (most + base) / ORDER - price * k <= best:  # no set of k or more languages fits better than all do
                break
            subset = order[:k]
            fitted, like = em(p[:, subset], times, share[subset] / share[subset].sum())
            value = 2 * (like + base) / ORDER - price * k
            if value > best:
                chosen, best, weight = tuple(subset.tolist()), value, fitted
        rank = sorted(zip(chosen, weight.tolist()), key=lambda x: (-x[1], x[0]))
        top, score = rank[0]
        return self.languages[top], min(1.0, float(score)), [(self.languages[i], float(v)) for i, v in rank]


def em(p: np.ndarray, times: np.ndarray, share: np.ndarray, rounds: int = 40, tol: float = 1e-4) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood of draws with likelihoods ``p`` (draws x components)."""
    total, tiny = times.sum(), 1e-300
    for _ in range(rounds):
        mixed = p @ share + tiny
        new = share * ((times / mixed) @ p) / total
        done = np.abs(new - share).max() < tol
        share = new
        if done:
            break
    share = share / max(share.sum(), tiny)
    return share, float(times @ np.log(p @ share + tiny))


def count_cells(labelled: DataFrame) -> DataFrame:
    """lang, cell, n over all rows of (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for lang, c in counts.items():
                at = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(c[at], pa.int64())],
                    ["lang", "cell", "n"],
                )
            counts.clear()

        for b in slices(batches, "text"):
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                found = cells(text)
                if found is None:
                    continue
                if lang not in counts:
                    if len(counts) == _HELD:
                        yield from out()
                    counts[lang] = np.zeros(CELLS, np.int64)
                counts[lang] += np.bincount(found, minlength=CELLS)
        yield from out()

    return labelled.select("lang", "text").mapInArrow(run, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))


def train(documents: DataFrame, learn_from: Column, smoothing: float = 0.5) -> LanguageModels:
    """Models from the rows where ``learn_from`` holds and doc_id, text and lang are there."""
    there = F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    labelled = documents.filter(learn_from & there)
    got = count_cells(labelled).toPandas()
    languages = sorted(got["lang"].unique())
    logp = np.zeros((CELLS, len(languages)), np.float32)
    for i, lang in enumerate(languages):
        rows = got[got["lang"] == lang]
        n = np.full(CELLS, smoothing)
        n[rows["cell"].to_numpy()] += rows["n"].to_numpy()
        logp[:, i] = np.log(n / n.sum())
    return LanguageModels(tuple(languages), logp)


def predict(spark: SparkSession, documents: DataFrame, models: LanguageModels) -> DataFrame:
    """The documents' columns with lang_pred, score, languages (code, proportion); only ``text``
    is looked at."""
    sent = spark.sparkContext.broadcast(models)
    added = "lang_pred string, score double, languages array<struct<code:string,share:double>>"

    own = fresh("_text", documents.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        share = pa.list_(pa.struct([("code", pa.string()), ("share", pa.float64())]))
        for b in slices(batches, own):
            got = [m.mixture(t) for t in b.column(own).to_pylist()]
            more = [
                pa.array([g[0] for g in got], pa.string()),
                pa.array([g[1] for g in got], pa.float64()),
                pa.array([[{"code": c, "share": v} for c, v in g[2]] for g in got], share),
            ]
            rest = b.select([n for n in b.schema.names if n != own])
            yield pa.RecordBatch.from_arrays([*rest.columns, *more], [*rest.schema.names, "lang_pred", "score", "languages"])

    clash = {"lang_pred", "score", "languages"}
    kept = [c for c in documents.columns if c not in clash]
    source = documents.select(*[F.col(f"`{c}`") for c in kept], F.col("text").alias(own))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*[F.col(f"`{c}`") for c in kept]).schema)
    return source.mapInArrow(run, f"{fields}, {added}")
