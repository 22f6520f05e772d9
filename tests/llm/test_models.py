"""Language mixture, toxicity, quality and language-model scoring."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import langmix, lmscore, quality_lm, queries, toxicity
from tillroll.llm.common import session_workspace

SF = "/root/testdata/sf0.01"


def frame(spark, rows, schema="doc_id long, text string, lang string"):
    return spark.createDataFrame(rows, schema)


# ---- languages ----


def test_em_finds_the_proportions():
    r = np.random.default_rng(1)
    p = r.dirichlet(np.ones(50), 3).T
    times = np.round(20_000 * (p @ [0.6, 0.4, 0.0])).astype(int)
    share, like = langmix.em(p, times, np.full(3, 1 / 3), rounds=3000, tol=1e-9)
    assert share == pytest.approx([0.6, 0.4, 0], abs=0.02)
    assert like == pytest.approx(float(times @ np.log(p @ share)))


def test_held_out_is_crc32_of_the_id_as_text(spark):
    rows = spark.range(-3, 200).select("id", langmix.held_out(F.col("id"), 4, 2).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)


def test_languages_of_held_out_documents_and_of_mixtures(spark):
    got = queries.op7_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text")
    hit = got.filter("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert hit > 0.99
    models = langmix.train(docs, ~langmix.held_out(F.col("doc_id"), 4, 2))
    long = {lang: t for lang, t in docs.filter("length(text) > 3000").select("lang", "text").collect()}
    pred, score, languages = models.mixture(long["fr"][:2000] + "\n" + long["de"][:1000])
    assert pred == "fr" and [c for c, _ in languages] == ["fr", "de"] and 0.55 < score < 0.8


def test_odd_rows_of_languages(spark):
    rows = [(1, "abc abc", "xx"), (2, None, "xx"), (3, "123 !!", None), (4, "", None), (None, "abc", None), (1, "abc abc", "xx")]
    df = spark.createDataFrame([(*r, 0.5, "c") for r in rows], "doc_id long, text string, lang string, score double, _text string")
    models = langmix.train(df, F.lit(True))
    got = langmix.predict(spark, df, models).collect()
    assert sorted((r["lang_pred"], r["score"]) for r in got) == [("und", 0.0)] * 3 + [("xx", 1.0)] * 3
    assert set(got[0].asDict()) == {"doc_id", "text", "lang", "_text", "lang_pred", "score", "languages"}
    none = langmix.train(df.filter("false"), F.lit(True))
    assert {r["lang_pred"] for r in langmix.predict(spark, df, none).collect()} == {"und"}
    assert langmix.predict(spark, df.filter("false"), models).count() == 0


def test_the_chosen_set_is_the_best_of_all_nested_sets():
    r = random.Random(12)
    syllables = {c: ["".join(r.choice(letters) for _ in range(3)) for _ in range(25)] for c, letters in zip("pqrs", ("abcde", "cdefg", "ghijk", "jklab"))}

    def write(lang, n):
        return " ".join(r.choice(syllables[lang]) + r.choice(syllables[lang]) for _ in range(n))

    logp = np.zeros((langmix.CELLS, 4), np.float32)
    for i, c in enumerate("pqrs"):
        n = np.full(langmix.CELLS, 0.5) + np.bincount(langmix.cells(write(c, 5000)), minlength=langmix.CELLS)
        logp[:, i] = np.log(n / n.sum())
    models = langmix.LanguageModels(tuple("pqrs"), logp)

    def likelihood(draws, some):
        p = [[math.exp(float(logp[d, i])) for i in some] for d in draws]
        share = [1 / len(some)] * len(some)
        for _ in range(300):
            got = [0.0] * len(some)
            for row in p:
                mixed = sum(a * s for a, s in zip(row, share))
                got = [g + a * s / mixed for g, a, s in zip(got, row, share)]
            share = [g / len(p) for g in got]
        return sum(math.log(sum(a * s for a, s in zip(row, share))) for row in p), share

    sizes = set()
    for k in (1, 1, 2, 2, 3, 4, 2, 3, 1, 4):
        langs = r.sample("pqrs", k)
        text = " ".join(write(c, r.choice([3, 12, 25])) for c in langs)
        draws = langmix.cells(text).tolist()
        price = math.log(len(draws) + 1)
        order = sorted(range(4), key=lambda i: -likelihood(draws, range(4))[1][i]) if k > 1 else None
        value = {(i,): 2 * likelihood(draws, (i,))[0] / 3 - price for i in range(4)}
        if order:
            value |= {tuple(order[:m]): 2 * likelihood(draws, order[:m])[0] / 3 - price * m for m in (2, 3, 4)}
        _, score, chosen = models.mixture(text)
        got = {tuple(sorted(v)): x for v, x in value.items()}[tuple(sorted("pqrs".index(c) for c, _ in chosen))]
        assert got >= max(value.values()) - 0.5 and score == chosen[0][1]
        sizes.add(len(chosen))
    assert {1, 2, 3} <= sizes


def test_rows_without_an_id_are_not_learnt_from(spark):
    rows = [(1, "abc abc", "xx"), (None, "def def", "yy"), (2, None, "zz"), (3, "ghi", None)]
    assert langmix.train(frame(spark, rows), ~langmix.held_out(F.col("doc_id"), 4, 2) | F.col("doc_id").isNull()).languages == ("xx",)


# ---- toxicity ----


def toxic_rows(seed, many):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    common = [word() for _ in range(60)]
    rows, labels = [], []
    for i in range(many):
        bad = r.random() < 0.12
        words = [r.choice(common) if r.random() < 0.7 else word() for _ in range(40)]
        if bad:
            words[r.randrange(40)] = r.choice(["vile", "scumbag"])
        rows.append((i, " ".join(words), None))
        if r.random() < 0.5:
            labels.append((i, 1, int(bad)))
    return rows, labels, [int("vile" in t or "scumbag" in t) for _, t, _ in rows]


def test_toxicity_learns_from_positives_and_unlabelled_texts(spark):
    rows, labels, truth = toxic_rows(3, 3000)
    docs = frame(spark, rows)
    lab = frame(spark, labels, "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, lab, ~langmix.held_out(F.col("doc_id"), 5, 0))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark, docs, model).collect()}
    assert sum((got[i] >= 0.5) == bool(y) for i, y in enumerate(truth)) / len(truth) > 0.98


def test_toxic_documents_of_the_tables(spark):
    got = queries.op8_toxicity(spark, "/root/testdata/sf0.1").filter("held_out")
    rows = got.join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").select("toxic", "predicted").collect()
    hits = sum(t and p for t, p in rows)
    assert hits / sum(p for _, p in rows) > 0.9 and hits / sum(t for t, _ in rows) > 0.85


def test_fit_follows_the_slope_of_the_corrected_risk():
    """The steps of ``fit`` against finite differences of the risk, both of its branches."""
    r = random.Random(8)
    texts = lambda words, n: [toxicity.word_cells(" ".join(r.choice(words) for _ in range(6)).encode()) for _ in range(n)]
    positive, unlabelled = texts(["vile", "bad", "the", "cat"], 30), texts(["the", "cat", "dog", "bad"], 60)
    prior, steps, batch, rate, decay = 0.8, 25, 8, 0.3, 1e-5
    model = toxicity.fit(positive, unlabelled, prior, steps, batch, rate, decay, least=1, least_z=0.0)
    used = toxicity.differing(positive, unlabelled, 0.0, 1).tolist()

    def output(x, doc):
        return x[-1] + sum(x[used.index(c)] * math.log1p(t) for c, t in zip(doc[0].tolist(), doc[1].tolist()) if c in used)

    def sigmoid(z):
        return 1 / (1 + math.exp(-z))

    rng, x = np.random.default_rng(7), np.array([0.0] * len(used) + [-1.0])
    m, v, branches = np.zeros(len(x)), np.zeros(len(x)), set()
    for step in range(1, steps + 1):
        p = [positive[i] for i in rng.integers(0, len(positive), batch)]
        u = [unlabelled[i] for i in rng.integers(0, len(unlabelled), 2 * batch)]

        def parts(x):
            as_positive = prior * np.mean([sigmoid(-output(x, d)) for d in p])
            return as_positive, np.mean([sigmoid(output(x, d)) for d in u]) - prior * np.mean([sigmoid(output(x, d)) for d in p])

        plain = parts(x)[1] >= 0
        branches.add(plain)
        risk = lambda x: sum(parts(x)) if plain else -parts(x)[1]  # noqa: B023, E731
        g = np.array([(risk(x + e) - risk(x - e)) / 2e-5 for e in np.eye(len(x)) * 1e-5])
        g[:-1] += decay * x[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x - rate * (1 - (step - 1) / steps) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    assert branches == {True, False}
    assert [*model.weights[used].tolist(), model.intercept] == pytest.approx(x.tolist(), abs=2e-3)


def test_odd_rows_of_toxicity(spark):
    docs = spark.createDataFrame([(1, None, 7), (2, "", 7), (None, "!!", 7), (2, "a b", 7)], "doc_id long, text string, score int")
    lab = frame(spark, [(1, 1, 1), (9, 1, 1), (None, None, None), (2, 0, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, lab, F.lit(True))
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(spark, docs, model).collect())
    never = toxicity.train(docs, lab.filter("false"), F.lit(True))
    assert [r["score"] for r in toxicity.score(spark, docs, never).collect()] == [0.0] * 4
    assert toxicity.score(spark, docs.filter("false"), model).count() == 0


def test_every_occurrence_counts_in_fit_and_scoring(spark):
    text = "vile " * 70_000 + "word " * 2_000 + "once"
    cells, times = toxicity.word_cells(text.encode())
    assert sorted(times.tolist()) == [1, 2_000, 70_000]  # words of four letters have no beginnings
    weights = np.zeros(toxicity.CELLS, np.float32)
    weights[cells[times == 2_000]] = 0.25
    model = toxicity.ToxicityModel(weights, -1.0)
    docs = frame(spark, [(1, text, None), (2, None, None), (3, "a b b", None)])
    got = {r["doc_id"]: r["score"] for r in toxicity.score(spark, docs, model).collect()}
    assert got[1] == pytest.approx(1 / (1 + math.exp(1.0 - 0.25 * math.log(2_001))))
    sample = toxicity._sample(docs, docs.select("doc_id"), 10)
    assert sorted(sorted(t.tolist()) for _, t in sample) == [[], [1, 2], [1, 2_000, 70_000]]


# ---- quality ----


def brute_base(text):
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if x.strip("\x20\x09\x0a\x0b\x0c\x0d")]
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again)


def test_base_figures(spark):
    r = random.Random(4)
    texts = [" ".join(r.choice(["a", "bé", "c#", "|", "<d>", " x"]) for _ in range(n)) for n in (0, 1, 4, 5, 6, 9, 50, 300)]
    texts += ["a b c d e\na b c d e\n\n \t\na b c d e", "x\x0by\x0cz\r\n", "\n".join(["same line"] * 9), "é é   ü"]
    for t in texts:
        assert quality_lm.base_stats(t.encode()) == brute_base(t)


def plain_kneser_ney(counted):
    """P(last symbol | first three) as a function, by the definition, from {four symbols: n}."""
    tables = {4: dict(counted)}
    for k in (3, 2, 1):
        tables[k] = collections.Counter(g[1:] for g in tables[k + 1])
    off = {}
    for k, table in tables.items():
        of = [sum(v == i for v in table.values()) for i in (1, 2, 3, 4)]
        y = of[0] / (of[0] + 2 * of[1]) if of[0] and of[1] else 0.5
        off[k] = [0.0] + [min(max(i - (i + 1) * y * of[i] / of[i - 1], 0.05), i - 0.05) if of[i - 1] and of[i] else 0.5 for i in (1, 2, 3)]

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / (len(tables[1]) + 1)
        row = {g: v for g, v in tables[k].items() if g[:-1] == gram[:-1]}
        if not row:
            return p(gram[1:])
        total, taken = sum(row.values()), sum(off[k][min(v, 3)] for v in row.values())
        n = row.get(gram, 0)
        return (n - off[k][min(n, 3)]) / total + taken / total * p(gram[1:])

    return p


def packed(gram):
    key = 0
    for c in gram:
        key = key << 16 | c
    return key


def test_kneser_ney_is_a_distribution_and_follows_the_definition(spark):
    r = np.random.default_rng(6)
    texts = {"xx": "".join(r.choice(list("abc \u4e02\u4e22\U00020000"), 1500)), "yy": "".join(r.choice(list("абв, "), 700))}
    counted = {lang: collections.Counter(quality_lm.fourgrams(quality_lm.symbols(t)).tolist()) for lang, t in texts.items()}
    rows = [(lang, int(np.uint64(g).view(np.int64)), n) for lang, c in counted.items() for g, n in c.items()]
    table = quality_lm.kneser_ney(session_workspace(spark), spark.createDataFrame(rows, "lang string, gram long, n long"))
    models = quality_lm.sorted_arrays(table)
    assert set(models) == {"xx", "yy"}
    for lang, c in counted.items():
        split = {tuple(g >> 16 * i & 0xFFFF for i in (3, 2, 1, 0)): n for g, n in c.items()}
        p = plain_kneser_ney(split)
        seen = sorted({x for g in split for x in g})
        asked = []
        for context in ((32, 32, 32), (97, 98, 99), (0x4E02, 0x4E22, 97), (0x430, 0x431, 32), (5, 6, 97), (5, 6, 7)):
            row = [(*context, x) for x in [*seen, 9999]]
            cost = models[lang].cost(np.array([packed(g) for g in row], np.uint64))
            assert np.exp(-cost) == pytest.approx([p(g) for g in row])
            # the padding blanks are never predicted, so a blank has its share only where the language has one
            assert np.exp(-cost)[[x in {g[-1] for g in split} or x == 9999 for x in [*seen, 9999]]].sum() == pytest.approx(1.0)
            asked += row
        keys = [(lang, int(np.uint64(packed(g)).view(np.int64))) for g in sorted(set(asked))]
        joined = quality_lm.costs_by_joins(spark.createDataFrame(keys, "lang string, gram long"), table).collect()
        assert len(joined) == len(keys)
        for row in joined:
            g = np.array([row["gram"]], np.int64).view(np.uint64)
            assert row["gram_cost"] == pytest.approx(float(models[lang].cost(g)[0]))


def test_no_two_letters_are_one_symbol():
    letters = "".join(map(chr, [*range(0x4E00, 0x9FA6), *range(0x430, 0x450), *range(0x3B1, 0x3CA), *range(0x621, 0x64B), *range(0xDF, 0xF7)]))
    assert len(set(quality_lm.symbols(letters).tolist())) == len(letters)
    assert quality_lm.symbols("ÄБ\n\t X").tolist() == [0xE4, 0x431, 32, 0x78]
    assert quality_lm.symbols("\U00020000").tolist() != quality_lm.symbols("\U00020001").tolist()


def test_texts_in_wrong_signs_of_the_same_script_are_rejected(spark):
    """Han and Cyrillic texts whose letters are others of the same script (which differ by multiples of 32)."""
    r = random.Random(3)

    def texts(letters, words):
        some = ["".join(r.choice(letters) for _ in range(r.randint(2, 5))) for _ in range(80)]
        return [" ".join(r.choice(some) for _ in range(words)) for _ in range(120)]

    han = texts([chr(0x4E00 + i) for i in range(24)], 60)
    cyrillic = texts([chr(0x430 + i) for i in range(24)], 60)
    rows = [(i, t, "zh") for i, t in enumerate(han)] + [(1000 + i, t, "ru") for i, t in enumerate(cyrillic)]
    rows += [(-1, "".join(c if c == " " else chr(ord(c) + 32) for c in han[0]), "zh")]
    rows += [(-2, "".join(c if c == " " else chr(ord(c) + 64) for c in cyrillic[0]), "ru")]
    kept = {x["doc_id"]: x["kept"] for x in quality_lm.quality(spark, frame(spark, rows)).collect()}
    assert not kept[-1] and not kept[-2]
    assert sum(v for k, v in kept.items() if k >= 0) >= 0.99 * 240


def test_packs_and_joins_score_like_one_broadcast(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(150).select("doc_id", "text", "lang")
    docs = docs.union(frame(spark, [(-1, "", None), (-2, None, "en"), (-3, "\U0001F600 ?! zzz", "en"), (-4, "one two", "nn"), (-4, "one two", "nn")]))
    want = sorted(quality_lm.scored_texts(spark, docs).collect(), key=repr)
    for pack, joins in ((0, True), (9_000, None), (60_000, False)):
        got = sorted(quality_lm.scored_texts(spark, docs, pack).collect(), key=repr)
        assert len(got) == len(want) == docs.count()
        for x, y in zip(sorted(got, key=lambda v: repr(v[:8])), sorted(want, key=lambda v: repr(v[:8]))):
            assert x[:8] == y[:8]
            assert (x["cost"] is None) == (y["cost"] is None)
            if x["cost"] is not None:
                assert (x["cost"], x["cost_sq"]) == (pytest.approx(y["cost"], abs=1 / 4096), pytest.approx(y["cost_sq"], rel=1e-3))


def test_counts_are_those_of_one_pass(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(80).select("text", "lang")
    got = {(r["lang"], r["gram"]): r["n"] for r in quality_lm.count_fourgrams(docs.repartition(5)).collect()}
    want = collections.Counter()
    for text, lang in docs.collect():
        words = text.encode().split()
        if not quality_lm.base_failed(len(words), quality_lm.repeated_words(words)):
            want.update((lang, g) for g in quality_lm.fourgrams(quality_lm.symbols(text)).view(np.int64).tolist())
    assert got == dict(want)


def test_quality_rejects_junk_and_keeps_prose(spark):
    rows = queries.op2_quality_rules(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"]]
    junk = [r["kept"] for r in rows if r["quality"] == 0 and not r["base_failed"]]
    assert np.mean(good) > 0.99 and np.mean(junk) < 0.25
    assert all(not r["kept"] for r in rows if r["base_failed"])


def test_bands_and_verdicts_are_those_of_plain_python(spark):
    rows = quality_lm.quality(spark, spark.read.parquet(f"{SF}/documents.parquet"), 3.0).collect()
    usual = collections.defaultdict(list)
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        if not r["base_failed"] and r["log_perplexity"] is not None:
            usual[r["lang"]].append(r)
    outside = 0
    for lang, some in usual.items():
        costs = sorted(r["log_perplexity"] for r in some)
        low, middle, high = (costs[math.ceil(q * len(costs)) - 1] for q in (0.25, 0.5, 0.75))
        noise = sum(r["cost_sq"] - r["log_perplexity"] ** 2 for r in some) / len(some)
        for r in (r for r in rows if r["lang"] == lang and r["log_perplexity"] is not None):
            half = 3.0 * math.sqrt(((high - low) / 1.349) ** 2 + noise / max(r["lm_words"], 1))
            assert (r["low"], r["high"]) == (pytest.approx(middle - half), pytest.approx(middle + half))
            good = middle - half <= r["log_perplexity"] <= middle + half
            outside += not good
            if min(abs(r["log_perplexity"] - middle - half), abs(r["log_perplexity"] - middle + half)) > 1e-9:
                assert r["kept"] == (not r["base_failed"] and good)
    assert outside > 20


def test_odd_rows_of_quality(spark):
    prose = "the cat sat on the mat and then it went to look for some milk"
    rows = [(1, None, "en", 1.0), (2, "", None, 1.0), (3, prose, None, 1.0), (4, "! ? . , ! ? . , ! ; : ,", "en", 1.0), (None, prose, "en", 2.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, cost double")
    got = {r["doc_id"]: r for r in quality_lm.quality(spark, df).collect()}
    assert len(got) == 5 and not got[1]["kept"] and not got[2]["kept"] and got[3]["kept"] and got[None]["kept"]
    assert got[4]["log_perplexity"] is None and got[4]["n_words"] == 12
    assert quality_lm.quality(spark, df.filter("false")).count() == 0


# ---- language-model scoring ----


def brute_scores(texts, target):
    """Both bigram models by their formulas, over a vocabulary that holds every word."""
    tokens = {i: [w for w in t.lower().split()] for i, t in texts.items()}
    ids = {w: k for k, w in enumerate(sorted({w for t in tokens.values() for w in t}))}
    size = lmscore.VOCABULARY

    def model(docs):
        pairs = collections.Counter(p for i in docs for p in zip(["<s>", *tokens[i]], tokens[i]))
        after, before, kinds = collections.Counter(), collections.Counter(), collections.Counter()
        for (v, w), n in pairs.items():
            after[w] += n
            before[v] += n
            kinds[v] += 1
        total = sum(after.values()) + size - 1

        def p(v, w):
            uni = (after[w] + 1) / total
            if not before[v]:
                return uni
            return max(pairs[v, w] - 0.75, 0) / before[v] + 0.75 * kinds[v] / before[v] * uni

        return p

    t, b = model(target), model(texts)
    ce = lambda m, x: -np.mean([math.log(m(v, w)) for v, w in zip(["<s>", *x], x)])
    assert len(ids) < size
    return {i: (len(x), ce(t, x), ce(b, x)) for i, x in tokens.items() if x}


def test_scores_are_those_of_the_formulas(spark):
    r = random.Random(8)
    texts = {i: " ".join(r.choice("abcdefgh") for _ in range(r.randrange(1, 30))) for i in range(60)}
    docs = frame(spark, [(i, t, None) for i, t in texts.items()] + [(100, None, None), (101, "!!", None)])
    ids = spark.createDataFrame([(i, "q") for i in range(0, 60, 3)] + [(0, "q"), (None, "q"), (999, "q")], "doc_id long, text string")
    got = {x["doc_id"]: x for x in lmscore.cross_entropy_difference(spark, docs, ids).collect()}
    want = brute_scores(texts, list(range(0, 60, 3)))
    for i, (n, t, b) in want.items():
        assert got[i]["n_tokens"] == n
        assert got[i]["ce_target"] == pytest.approx(t, rel=1e-5) and got[i]["ce_background"] == pytest.approx(b, rel=1e-5)
        assert got[i]["ce_diff"] == pytest.approx(t - b, abs=1e-4)
    assert got[100]["n_tokens"] == 0 and got[101]["ce_diff"] is None
    empty = lmscore.cross_entropy_difference(spark, docs.filter("false"), ids)
    assert empty.count() == 0
    assert lmscore.cross_entropy_difference(spark, docs, ids.filter("false")).filter("ce_diff is not null").count() == 60


def test_every_word_of_a_large_vocabulary_has_its_own_counts(spark, monkeypatch):
    r = random.Random(9)
    words = [f"w{i}" for i in range(9000)]
    texts = {i: " ".join(["the", *(r.choice(words) if r.random() < 0.8 else "the" for _ in range(60))]) for i in range(400)}
    target = list(range(0, 400, 4))
    distinct = len({w for t in texts.values() for w in t.split()})
    assert distinct > lmscore.VOCABULARY
    monkeypatch.setattr(lmscore, "SLICE_BYTES", 20_000)
    monkeypatch.setattr(lmscore, "BUCKET", 3_000)
    docs = frame(spark, [(i, t, None) for i, t in texts.items()]).repartition(3)
    got = lmscore.cross_entropy_difference(spark, docs, spark.createDataFrame([(i,) for i in target], "doc_id long")).collect()
    monkeypatch.setattr(lmscore, "VOCABULARY", distinct + lmscore.FIRST)  # brute_scores: a cell for each word
    want = brute_scores(texts, target)
    assert len(got) == 400
    for x in got:
        n, t, b = want[x["doc_id"]]
        assert x["n_tokens"] == n
        assert x["ce_target"] == pytest.approx(t, rel=1e-9) and x["ce_background"] == pytest.approx(b, rel=1e-9)


def test_the_mark_and_heavy_words_are_spread_over_buckets(spark, monkeypatch):
    """Documents of one word, and a word that is a third of all: no bucket gets a third of the bigrams."""
    monkeypatch.setattr(lmscore, "SLICE_BYTES", 4_000)
    monkeypatch.setattr(lmscore, "BUCKET", 400)
    texts = {i: f"only{i}" if i < 900 else f"heavy w{i} heavy v{i}" for i in range(1500)}
    docs = frame(spark, [(i, t, None) for i, t in texts.items()]).repartition(3)
    slices_ = lmscore.document_slices(docs)
    total = slices_.agg(F.sum("tokens")).first()[0]
    many = -(-total // lmscore.BUCKET)
    heavy = lmscore.heavy_words(slices_, many)
    assert heavy.tolist() == lmscore._word_hashes(b"heavy").tolist()
    hot = np.concatenate([lmscore.MARKS[:1], heavy])
    got = collections.Counter()
    for r in slices_.collect():
        for bucket, _, _, after, _, _ in lmscore.requests(bytes(r["words"]), r["lens"], [], hot, many):
            got[bucket] += len(after) // lmscore.AFTER_BYTES
    assert len(got) == many and max(got.values()) < 2 * sum(got.values()) / many
    scored = lmscore.cross_entropy_difference(spark, docs, spark.createDataFrame([(1,), (950,)], "doc_id long")).collect()
    want = brute_scores(texts, [1, 950])
    assert len(scored) == 1500
    for x in scored:
        n, t, b = want[x["doc_id"]]
        assert x["n_tokens"] == n and abs(x["ce_target"] - t) < 1e-9 and abs(x["ce_background"] - b) < 1e-9
