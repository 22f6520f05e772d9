"""Quality rules with an n-gram perplexity band per language.

The model is a modified Kneser-Ney model of four symbols, one model per language. A symbol is a
UTF-16 unit in lower case (``symbols``), so no two characters are one symbol, and a four-gram
packs into 64 bits. Spark counts the four-grams of all texts that pass the base rules, and
makes the lower orders' continuation counts, discounts, probabilities and back-off weights from
the counts by aggregates and joins (``kneser_ney``): the model is a Spark table and grows with
the corpus.

For scoring, languages are dealt to packs of at most ``pack`` entries. One pack at a time is broadcast
as sorted arrays of hashed keys with the log-probabilities and back-off weights beside
them, looked up by the hash's leading bits (the hash is a bijection of 64 bits, so nothing collides). A language
with more entries than a pack holds is scored by joins: its corpus' distinct four-grams get
their costs from the table, and its words get theirs from them. Both ways give the same costs.

A text's log-perplexity is its cost per word (a run of letters and digits; signs and spaces
count towards the word before them), in steps of 1/4096, so that Spark takes exact quartiles from a
histogram per language that doesn't grow with the texts; a text is rejected beyond

    median +- width * sqrt(spread**2 + noise / words)

where spread is the interquartile range / 1.349 and noise the variance of the cost of single
words, so that a short text isn't rejected for being short. Perplexity is too high for
gibberish and symbol runs, too low for text that keeps saying the same.

Defined cases: null and empty texts have no words and fail the base rules; a null ``lang`` is
a language of its own; a text without letters or digits, or of a language none of whose texts passes
the base rules, has no perplexity and is kept if the base rules pass; repeated rows are rows;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm.common import Workspace, mix, session_workspace, slices

ORDER, BITS, BLANK = 4, 16, 32
_MASKS = [0] + [(1 << BITS * n) - 1 for n in range(1, ORDER + 1)]
MARKS = b"#*$%&|<>"
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
#: Entries of the models that are broadcast at once (20 to 24 bytes each, and as much again on the way).
PACK = 1 << 22
#: Kinds of a model's entries: 1 to ORDER are log-probabilities, these the others.
UNKNOWN, BACKOFF = 0, 10
#: Steps of a log-perplexity to one.
STEPS = 4096


def _unit_tables() -> tuple[np.ndarray, np.ndarray]:
    """Per UTF-16 unit: its symbol (lower case, white space as blanks), and whether it stands in words."""
    lower, letter = np.arange(1 << 16, dtype=np.uint16), np.zeros(1 << 16, bool)
    for c in range(1 << 16):
        ch = chr(c)
        low = ch.lower()
        if ch.isspace() or c == 0:
            lower[c] = BLANK
        elif len(low) == 1 and ord(low) < 1 << 16:
            lower[c] = ord(low)
        kind = unicodedata.category(ch)
        letter[c] = kind[0] in "LNM" or kind == "Cs"
    return lower, letter


class _Units:
    tables: tuple[np.ndarray, np.ndarray] | None = None

    @classmethod
    def get(cls) -> tuple[np.ndarray, np.ndarray]:
        if cls.tables is None:
            cls.tables = _unit_tables()
        return cls.tables


def symbols(text: str) -> np.ndarray:
    """Symbols of a text, white space runs as one."""
    s = _Units.get()[0][np.frombuffer(text.encode("utf-16-le", "surrogatepass"), np.uint16)]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != BLANK) | (s[:-1] != BLANK)
    return s[keep]


def fourgrams(s: np.ndarray) -> np.ndarray:
    """Keys of the four-grams that end at each symbol; a text begins after three blanks."""
    x = np.concatenate([np.full(ORDER - 1, BLANK, np.uint64), s.astype(np.uint64)])
    n, out = len(s), np.zeros(len(s), np.uint64)
    for k in range(ORDER):
        out = (out << np.uint64(BITS)) | x[k : k + n]
    return out


def word_of_symbol(s: np.ndarray) -> tuple[np.ndarray, int]:
    """The word that each symbol counts towards (what stands before the first counts to it), and the number of words."""
    letter = _Units.get()[1][s]
    begins = letter.copy()
    begins[1:] &= ~letter[:-1]
    return np.maximum(np.cumsum(begins) - 1, 0), int(begins.sum())


def word_costs(s: np.ndarray, model: KneserNey) -> np.ndarray:
    """Cost of each word of a text's symbols (empty if it has none)."""
    word, words = word_of_symbol(s)
    if not words:
        return np.empty(0)
    return np.bincount(word, weights=model.cost(fourgrams(s)), minlength=words)


def base_stats(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    words = text.split()
    chars = len(text.translate(None, b" \t\n\v\f\r").decode("utf-8", "surrogatepass"))
    marks = sum(text.count(bytes([m])) for m in MARKS)
    dup = 0
    if b"\n" in text:
        lines = [line for line in text.split(b"\n") if line.split()]
        dup = len(lines) - len(set(lines))
    return len(words), chars, marks, dup, repeated_words(words)


def repeated_words(words: list[bytes], n: int = 5) -> int:
    """Words inside n-word windows that the text holds twice or more."""
    total = len(words) - n + 1
    if total < 2:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.uint64, len(words))
    h = np.zeros(total, np.uint64)
    for k in range(n):
        h = (h + w[k : k + total] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(total, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    # the hash only selects: windows that seem repeated are compared as words
    seen: dict[tuple, int] = {}
    at = np.flatnonzero(again).tolist()
    for i in at:
        key = tuple(w[i : i + n].tolist())
        seen[key] = seen.get(key, 0) + 1
    mark = np.zeros(len(words) + 1, np.int64)
    for i in at:
        if seen[tuple(w[i : i + n].tolist())] > 1:
            mark[i] += 1
            mark[i + n] -= 1
    return int((np.cumsum(mark[:-1]) > 0).sum())


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 10 or 100 * n_repeat_words > 20 * n_words


def count_fourgrams(documents: DataFrame) -> DataFrame:
    """lang, gram, n over the texts that pass the base rules. Each task adds up sorted arrays and
    passes them on when they reach a fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def merge(lang: str) -> None:
            grams, n = np.unique(np.concatenate(held.pop(lang)), return_counts=True)
            if lang in sums:
                old, m = sums[lang]
                both, where = np.unique(np.concatenate([old, grams]), return_inverse=True)
                grams, n = both, np.bincount(where, weights=np.concatenate([m, n])).astype(np.int64)
            sums[lang] = (grams, n)

        def out() -> Iterator[pa.RecordBatch]:
            for lang in list(held):
                merge(lang)
            for lang, (g, n) in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(g), pa.string()), pa.array(g.view(np.int64)), pa.array(n, pa.int64())],
                    ["lang", "gram", "n"],
                )
            sums.clear()

        for b in slices(batches, "text"):
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                words = text.encode("utf-8", "surrogatepass").split()
                if not base_failed(len(words), repeated_words(words)):
                    held.setdefault(lang, []).append(fourgrams(symbols(text)))
            if sum(len(g) for some in held.values() for g in some) > 1 << 21:
                for lang in list(held):
                    merge(lang)
            if sum(len(g) for g, _ in sums.values()) > 1 << 21:
                yield from out()
        yield from out()

    source = documents.filter(F.col("text").isNotNull()).select(F.coalesce("lang", F.lit("")).alias("lang"), "text")
    return source.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _suffix(gram: Column | str, order: int) -> Column:
    """The last ``order`` symbols of a key."""
    key = F.col(gram) if isinstance(gram, str) else gram
    return key if order == ORDER else key.bitwiseAND(F.lit(_MASKS[order]))


def _context(gram: Column | str) -> Column:
    """A key without its last symbol."""
    return F.shiftrightunsigned(gram, BITS)


def _discounts(grams: DataFrame) -> DataFrame:
    """lang, d1, d2, d3 (what is taken off counts of one, two, and three or more) and types."""
    of = [F.count_if(F.col("n") == i).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)]
    y = F.when((F.col("n1") > 0) & (F.col("n2") > 0), F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)

    def off(i: int) -> Column:
        got = i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}")
        inside = F.least(F.greatest(got, F.lit(0.05)), F.lit(i - 0.05))
        return F.when((F.col(f"n{i}") > 0) & (F.col(f"n{i + 1}") > 0), inside).otherwise(0.5).alias(f"d{i}")

    return grams.groupBy("lang").agg(*of, F.count(F.lit(1)).alias("types")).select("lang", "types", off(1), off(2), off(3))


def kneser_ney(ws: Workspace, counted: DataFrame) -> DataFrame:
    """lang, kind, key, value: the interpolated modified Kneser-Ney models of (lang, gram, n).

    ``kind`` 1 to ORDER: log-probability of the last symbol of the n-gram ``key``; BACKOFF + order:
    log of the weight that the context ``key`` leaves to the next lower order; UNKNOWN: log-probability of a
    symbol that the language doesn't have.
    """
    grams = {ORDER: ws.stage(counted, "grams")}
    for k in range(ORDER - 1, 0, -1):  # continuation counts: distinct symbols to the left
        lower = grams[k + 1].groupBy("lang", _suffix("gram", k).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        grams[k] = ws.stage(lower, f"grams{k}")
    out, below = [], None
    for k in range(1, ORDER + 1):
        of = [F.count_if(F.col("n") == 1).alias("c1"), F.count_if(F.col("n") == 2).alias("c2"), F.count_if(F.col("n") > 2).alias("c3")]
        left = (F.col("d1") * F.col("c1") + F.col("d2") * F.col("c2") + F.col("d3") * F.col("c3")) / F.col("total")
        contexts = (
            grams[k].groupBy("lang", _context("gram").alias("context")).agg(F.sum("n").alias("total"), *of)
            .join(_discounts(grams[k]), "lang").select("lang", "context", "total", "types", "d1", "d2", "d3", left.alias("left"))
        )
        contexts = ws.stage(contexts, f"contexts{k}")
        own = (F.col("n") - F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))) / F.col("total")
        rows = grams[k].withColumn("context", _context("gram")).join(contexts, ["lang", "context"])
        if below is None:  # order 0: all symbols of the language and the unknown one alike
            rows = rows.withColumn("lower", 1.0 / (F.col("types") + 1))
            unknown = F.log(F.col("left") / (F.col("types") + 1))
            out.append(contexts.select("lang", F.lit(UNKNOWN).alias("kind"), F.lit(0).cast("long").alias("key"), unknown.alias("value")))
        else:
            rows = rows.withColumn("key", _suffix("gram", k - 1)).join(below, ["lang", "key"])
            out.append(contexts.select("lang", F.lit(BACKOFF + k).alias("kind"), F.col("context").alias("key"), F.log("left").alias("value")))
        below = ws.stage(rows.select("lang", F.col("gram").alias("key"), (own + F.col("left") * F.col("lower")).alias("lower")), f"order{k}")
        out.append(below.select("lang", F.lit(k).alias("kind"), "key", F.log("lower").alias("value")))
    model = out[0]
    for more in out[1:]:
        model = model.unionByName(more)
    return ws.stage(model, "model")


@dataclass(frozen=True)
class SortedHashes:
    """Sorted hashes, the values beside them, and where the hashes with given leading bits begin: about one
    to a beginning, as a hash is spread evenly, so that a key is found in a step or a few."""

    hashes: np.ndarray
    values: np.ndarray
    starts: np.ndarray
    shift: int

    @classmethod
    def of(cls, hashes: np.ndarray, values: np.ndarray) -> SortedHashes:
        bits = max(1, len(hashes).bit_length())
        edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
        return cls(hashes, values, np.minimum(np.searchsorted(hashes, edges), len(hashes) - 1).astype(np.int32), 64 - bits)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the keys, and which of them there are."""
        want = mix(keys)
        at = self.starts[(want >> np.uint64(self.shift)).astype(np.intp)]
        behind = np.flatnonzero(self.hashes[at] < want)
        while len(behind):
            behind = behind[at[behind] < len(self.hashes) - 1]
            at[behind] += 1
            behind = behind[self.hashes[at[behind]] < want[behind]]
        return self.values[at], self.hashes[at] == want


@dataclass(frozen=True)
class KneserNey:
    """One language's model, per kind of entry."""

    entries: dict[int, SortedHashes]

    def cost(self, grams: np.ndarray) -> np.ndarray:
        """Negative log-probability of the last symbol of each four-gram."""
        total, todo, out = np.zeros(len(grams)), np.arange(len(grams)), np.empty(len(grams))
        for n in range(ORDER, 0, -1):
            key = grams[todo] & np.uint64(_MASKS[n])
            logp, hit = self.entries[n].find(key)
            if n == ORDER and hit.all():
                return -logp
            out[todo[hit]] = -(total[todo[hit]] + logp[hit])
            todo, key = todo[~hit], key[~hit]
            if not len(todo):
                return out
            if n > 1:
                weight, known = self.entries[BACKOFF + n].find(key >> np.uint64(BITS))
                total[todo] += np.where(known, weight, 0.0)
        out[todo] = -(total[todo] + self.entries[UNKNOWN].values[0])
        return out


def sorted_arrays(model: DataFrame) -> dict[str, KneserNey]:
    """The models of the languages in ``model``, on the driver: callers bound its rows."""
    rows = model.toArrow()
    lang = rows.column("lang").combine_chunks().dictionary_encode()
    code, kind = np.asarray(lang.indices), rows.column("kind").to_numpy()
    hashes, value = mix(rows.column("key").to_numpy().view(np.uint64)), rows.column("value").to_numpy()
    order = np.lexsort((hashes, kind, code))
    code, kind, hashes, value = code[order], kind[order], hashes[order], value[order]
    edges = np.flatnonzero((np.diff(code) != 0) | (np.diff(kind) != 0)) + 1
    found: dict[str, dict] = {}
    for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(code)]):
        if hi > lo:
            found.setdefault(lang.dictionary[int(code[lo])].as_py(), {})[int(kind[lo])] = SortedHashes.of(hashes[lo:hi], value[lo:hi])
    return {name: KneserNey(entries) for name, entries in found.items()}


SCORED = f"doc_id long, lang string, {STATS}, lm_words long, cost double, cost_sq double"


def _source(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("lang"), "text")


def measure(spark: SparkSession, documents: DataFrame, models: dict[str, KneserNey]) -> DataFrame:
    """doc_id, lang, the base figures, lm_words, cost (mean per word, in steps) and cost_sq (variance
    over the words + cost squared)."""
    sent = spark.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lm_words", "cost", "cost_sq"]
        kinds = [pa.int64()] * 6 + [pa.float64()] * 2
        for b in slices(batches, "text"):
            rows = []
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                text = text or ""
                stats = base_stats(text.encode("utf-8", "surrogatepass"))
                costs = word_costs(symbols(text), m[lang]) if lang in m else np.empty(0)
                cost = float(np.rint(costs.mean() * STEPS) / STEPS) if len(costs) else None
                rows.append((*stats, len(costs), cost, float(costs.var() + cost**2) if len(costs) else None))
            more = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("lang"), *more], ["doc_id", "lang", *names])

    return _source(documents).mapInArrow(run, SCORED)


def costs_by_joins(grams: DataFrame, model: DataFrame) -> DataFrame:
    """lang, gram, cost of distinct (lang, gram): ``KneserNey.cost`` as left joins with the model's table."""
    unknown = model.filter(F.col("kind") == UNKNOWN).select("lang", F.col("value").alias("u"))
    rows, cost = grams.join(unknown, "lang"), F.col("u")
    for k in range(1, ORDER + 1):
        kinds = {f"p{k}": (k, _suffix("gram", k))} | ({f"b{k}": (BACKOFF + k, _context(_suffix("gram", k)))} if k > 1 else {})
        for name, (kind, key) in kinds.items():
            part = model.filter(F.col("kind") == kind).select("lang", F.col("key").alias("_key"), F.col("value").alias(name))
            rows = rows.withColumn("_key", key).join(part, ["lang", "_key"], "left").drop("_key")
        lower = cost if k == 1 else F.coalesce(F.col(f"b{k}"), F.lit(0.0)) + cost
        cost = F.coalesce(F.col(f"p{k}"), lower)
    return rows.select("lang", "gram", (-cost).alias("gram_cost"))


def measure_by_joins(ws: Workspace, documents: DataFrame, model: DataFrame) -> DataFrame:
    """As ``measure``, for languages with models of any size: nothing is broadcast whole. The words'
    four-grams, one row for each that a word holds, are staged beside the rows of the texts."""
    schema = f"uid long, doc_id long, lang string, {STATS}, lm_words long, word long, gram long, times long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 9]
        names = [c.split()[0] for c in schema.split(", ")]
        for b in slices(batches, "text", 1 << 18):
            texts = [t or "" for t in b.column("text").to_pylist()]
            rows = []
            for uid, doc_id, lang, text in zip(*(b.column(c).to_pylist() for c in ("uid", "doc_id", "lang")), texts):
                s = symbols(text)
                word, words = word_of_symbol(s)
                rows.append((uid, doc_id, lang, *base_stats(text.encode("utf-8", "surrogatepass")), words, None, None, None))
                if words:
                    pairs, times = np.unique(np.stack([word.astype(np.uint64), fourgrams(s)]), axis=1, return_counts=True)
                    nothing = pa.nulls(len(times), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([uid] * len(times), pa.int64()), nothing, pa.array([lang] * len(times), pa.string()), *[nothing] * 6,
                         *(pa.array(x.astype(np.int64)) for x in (pairs[0], pairs[1].view(np.int64), times))], names,
                    )
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    staged = ws.stage(_source(documents).withColumn("uid", F.monotonically_increasing_id()).mapInArrow(run, schema), "words")
    held = staged.filter(F.col("gram").isNotNull()).select("uid", "lang", "word", "gram", "times")
    costs = ws.stage(costs_by_joins(held.select("lang", "gram").distinct(), model), "costs")
    words = held.join(costs, ["lang", "gram"]).groupBy("uid", "word").agg(F.sum(F.col("times") * F.col("gram_cost")).alias("c"))
    cost = F.round(F.avg("c") * STEPS) / STEPS
    texts = words.groupBy("uid").agg(cost.alias("cost"), F.var_pop("c").alias("_var"))
    return (
        staged.filter(F.col("gram").isNull()).join(texts, "uid", "left")
        .withColumn("cost_sq", F.col("_var") + F.col("cost") * F.col("cost")).select(*[c.split()[0] for c in SCORED.split(", ")])
    )


def packs_of(model: DataFrame, pack: int) -> DataFrame:
    """lang, pack: languages dealt in order to packs of at most twice ``pack`` entries; -1 for a language with more
    entries than ``pack``."""
    sizes = model.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    small = F.when(F.col("n") <= pack, F.col("n")).otherwise(0)
    before = F.sum(small).over(Window.orderBy("lang").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - small
    return sizes.select("lang", F.when(F.col("n") > pack, F.lit(-1)).otherwise(F.floor(before / pack)).cast("int").alias("pack"))


def scored_texts(spark: SparkSession, documents: DataFrame, pack: int = PACK) -> DataFrame:
    """``measure`` of all texts by the models of these texts, a pack of languages at a time."""
    ws = session_workspace(spark)
    model = kneser_ney(ws, count_fourgrams(documents))
    packs = ws.stage(packs_of(model, pack), "packs")
    names = sorted(r["pack"] for r in packs.select("pack").distinct().collect())
    if names in ([], [0]):
        return ws.stage(measure(spark, documents, sorted_arrays(model)), "scored")
    dealt = documents.select("doc_id", "lang", "text").join(packs.withColumnRenamed("lang", "_lang"), F.coalesce("lang", F.lit("")) == F.col("_lang"), "left")
    parts = []
    for i in sorted({0, *names}):  # texts of languages without a model go with the first pack
        texts, those = dealt.filter(F.coalesce("pack", F.lit(0)) == i), model.join(packs.filter(F.col("pack") == i), "lang", "left_semi")
        got = measure_by_joins(ws, texts, those) if i < 0 else measure(spark, texts, sorted_arrays(those))
        parts.append(ws.stage(got, "scored"))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def quality(spark: SparkSession, documents: DataFrame, width: float = 5.0, pack: int = PACK) -> DataFrame:
    """Per document row: the base figures, base_failed, log_perplexity, low, high, kept."""
    ws = session_workspace(spark)
    scored = scored_texts(spark, documents, pack).withColumn(
        "base_failed", (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    )
    usual = scored.filter(~F.col("base_failed") & F.col("cost").isNotNull())
    steps = usual.groupBy("lang", "cost").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("cost_sq") - F.col("cost") * F.col("cost")).alias("var")
    )
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("cost"))
    whole = F.sum("n").over(Window.partitionBy("lang"))
    quartiles = [F.min(F.when(F.col("upto") >= F.ceil(q * F.col("whole")), F.col("cost"))).alias(a) for q, a in ((0.25, "q1"), (0.5, "middle"), (0.75, "q3"))]
    band = (
        steps.withColumns({"upto": upto, "whole": whole}).groupBy("lang").agg(*quartiles, (F.sum("var") / F.sum("n")).alias("noise"))
        .select("lang", "middle", ((F.col("q3") - F.col("q1")) / 1.349).alias("spread"), "noise")
    )
    half = width * F.sqrt(F.col("spread") * F.col("spread") + F.col("noise") / F.greatest(F.col("lm_words"), F.lit(1)))
    out = scored.join(ws.stage(band, "bands"), "lang", "left").withColumn("low", F.col("middle") - half).withColumn("high", F.col("middle") + half)
    inside = F.coalesce(F.col("cost").between(F.col("low"), F.col("high")), F.lit(True))
    return out.withColumn("kept", ~F.col("base_failed") & inside).withColumnRenamed("cost", "log_perplexity")
