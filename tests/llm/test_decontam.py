"""Decontamination against a brute-force reading of the rule."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from tillroll.llm.common import bit_table, in_table
from tillroll.llm.decontam import contamination


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text, items, window=13):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        b = words(t)
        n = min(window, len(b))
        for i in range(len(b) - n + 1 if n else 0):
            for at in range(len(w) - n + 1):
                if w[at : at + n] == b[i : i + n]:
                    hit.update(range(at, at + n))
                    if item is not None:
                        found.add(str(item))
    return len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)


def run(spark, docs, items):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, places string, n_words int")
    b = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, words string")
    rows = contamination(spark, d, b).collect()
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in rows)


def want(docs, items):
    return sorted((-1 if i is None else i, *brute(t, items)) for i, t in docs)


def test_random_texts_over_few_words(spark):
    r = random.Random(5)
    text = lambda n: " ".join(r.choice(["a", "B", "c1", "dé", "ü"]) + r.choice(["", ",", "."]) for _ in range(n))
    items = [(i, text(r.choice([0, 1, 2, 3, 5, 12, 13, 14, 30]))) for i in range(25)] + [(3, None), (None, "a B c1 dé ü a a")]
    items = [x for x in items if len(words(x[1])) != 1] + [(77, "zebra")]
    docs = [(i, text(r.choice([0, 1, 4, 20, 200])) + r.choice(["", " Zebra! "])) for i in range(40)]
    docs += [(100 + (i or 90), text(30) + "\n" + (t or "").upper().replace(" ", " - ") + "\n" + text(9)) for i, t in items if t]
    docs += [(5, None), (None, "zebra"), docs[0], docs[0]]
    assert run(spark, docs, items) == want(docs, items)


def test_the_contamination_share(spark):
    passage = " ".join(f"w{i}" for i in range(13))
    docs = [(1, passage + " x" * (13 * 19)), (2, passage + " x" * (13 * 19 + 1)), (3, passage.replace("w5", "v5"))]
    got = run(spark, docs, [(9, passage)])
    assert [(r[0], r[4]) for r in got] == [(1, True), (2, False), (3, False)] and got == want(docs, [(9, passage)])


def test_a_passage_that_very_many_documents_share(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    docs = [(i, f"d{i} {passage} e{i} f{i}") for i in range(600)]
    assert run(spark, docs, [(1, passage), (2, passage)]) == want(docs[:1], [(1, passage), (2, passage)])[:0] + [
        (i, 43, 40, ["1", "2"], True) for i in range(600)
    ]


def test_long_text_and_empty_tables(spark):
    long = " ".join(f"q{i}" for i in range(150_000)) + " the one needle of thirteen words in the very long text is here now ok"
    items = [(1, "the one needle of thirteen words in the very long text is here now ok")]
    assert run(spark, [(1, long)], items) == [(1, 150_015, 15, ["1"], False)]
    assert run(spark, [], items) == []
    assert run(spark, [(1, "a b"), (2, None)], []) == [(1, 2, 0, [], False), (2, 0, 0, [], False)]


def test_bit_table_grows_with_its_keys(spark):
    keys = spark.range(3000).select(F.xxhash64("id").alias("k")).union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    added = np.array([r.k for r in keys.collect() if r.k is not None], np.int64)
    others = np.random.default_rng(3).integers(-(2**63), 2**63 - 1, 20_000)
    for most, bits in ((1 << 20, 1 << 16), (1 << 12, 1 << 12)):
        table = bit_table(keys, "k", least=64, most=most)
        assert len(table) * 8 == bits and in_table(table, added).all()
        assert abs(in_table(table, others).mean() - (1 - np.exp(-3000 / bits))) < 0.02
    assert not in_table(bit_table(keys.filter("k IS NULL"), "k"), added).any()
