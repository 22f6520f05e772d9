"""ProbMinHash signatures and near-duplicate groups against brute force."""

import itertools
import random

import numpy as np
import pytest

from tillroll.llm import probminhash as pm
from tillroll.llm.common import letters_and_digits

SF = "/root/testdata/sf0.001"


def brute_similarity(a, b):
    total = 0.0
    for d in a.keys() & b.keys():
        total += 1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in a.keys() | b.keys())
    return total


def weighted(values):
    keys = np.array(sorted(values), np.uint64)
    return keys, np.array([values[k] for k in sorted(values)])


def test_exact_similarity_is_the_definition():
    r = random.Random(2)
    for _ in range(50):
        a, b = ({r.randrange(12): r.choice([1.0, 1.7, 2.1]) for _ in range(r.randrange(1, 9))} for _ in range(2))
        assert pm.probability_jaccard(weighted(a), weighted(b)) == pytest.approx(brute_similarity(a, b))
    assert pm.probability_jaccard(weighted({}), weighted({1: 1.0})) == 0


def test_registers_match_with_the_probability_jaccard():
    r = random.Random(3)
    base = {r.getrandbits(64): 1 + r.random() * 2 for _ in range(300)}
    other = dict(list(base.items())[:220]) | {r.getrandbits(64): 1.5 for _ in range(60)}
    a, b = weighted(base), weighted(other)
    sig = pm.signatures([a, b, weighted({5: 1.0})], 4000)
    assert pm.estimate(sig[0], sig[1]) == pytest.approx(pm.probability_jaccard(a, b), abs=0.04)
    assert len(set(sig[2].tolist())) == 1


def edited(r, text, share):
    return " ".join(w if r.random() > share else "zz" + str(r.randrange(10**6)) for w in text.split())


def brute_groups(rows):
    """Components of exact copies (as words) and pairs of similarity 0.8 or more."""
    sets = [pm.weighted_shingles(letters_and_digits((t or "").encode())) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        if len(sets[i][0]) and pm.probability_jaccard(sets[i], sets[j]) >= 0.8:
            parent[find(j)] = find(i)
    return [find(i) for i in range(len(rows))]


def grouped(spark, rows):
    df = spark.createDataFrame([(i, t, "x", True) for i, t in rows], "doc_id long, text string, class_id string, kept boolean")
    return sorted(pm.near_duplicates(spark, df).collect(), key=lambda r: r["uid"])


def check(got, rows):
    want = brute_groups(rows)
    assert [r["doc_id"] for r in got] == [i for i, _ in rows]
    mine = {}
    for place, r in enumerate(got):
        mine.setdefault((r["class_id"], r["group_size"]) if r["group_size"] > 1 else ("alone", place), set()).add(place)
    theirs = {}
    for place, g in enumerate(want):
        theirs.setdefault(g, set()).add(place)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))
    for members in theirs.values():
        assert sum(got[m]["kept"] for m in members) == 1
        ids = [rows[m][0] for m in members if rows[m][0] is not None]
        assert {got[m]["class_id"] for m in members} == {min(ids) if ids else None}


def test_groups_of_copies_chains_and_odd_rows(spark):
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    rows = []
    for g in range(12):
        base = " ".join(word() for _ in range(r.choice([30, 90, 200])))
        rows += [(len(rows) + k, edited(r, base, share)) for k, share in enumerate([0, 0, 0.01, 0.02, 0.03, 0.1, 0.4])]
    chain = " ".join(word() for _ in range(150))
    for k in range(8):  # each link changes a few words of the one before
        chain = edited(r, chain, 0.008)
        rows.append((len(rows), chain))
    rows += [(1000, None), (1001, ""), (1002, "!!"), (1003, "one two"), (1004, "One, two."), (1005, "one two three"), (None, "one two"), (1003, "one two")]
    r.shuffle(rows)
    check(grouped(spark, rows), rows)


def test_one_large_group_of_near_copies(spark):
    r = random.Random(9)
    base = " ".join("".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(120))
    rows = [(i, edited(r, base, 0.025)) for i in range(350)] + [(1000 + i, base) for i in range(50)]
    check(grouped(spark, rows), rows)


def test_blocks_of_a_bucket_meet_once(spark, monkeypatch):
    """Small blocks: every pair of different components of a bucket is still compared."""
    monkeypatch.setattr(pm, "BLOCK", 3)
    r = random.Random(11)
    base = " ".join("".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(100))
    rows = [(i, edited(r, base, 0.03)) for i in range(60)]
    check(grouped(spark, rows), rows)


def test_documents_of_the_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check(grouped(spark, rows), rows)


def test_empty_table(spark):
    assert grouped(spark, []) == []


def test_a_star_of_many_partners_is_verified_piece_by_piece(spark):
    r = random.Random(12)
    base = [f"w{r.randrange(10**6)}" for _ in range(120)]
    texts = {}
    for c in range(3 * pm.PIECE):
        words = list(base)
        for _ in range(c % 9):
            words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
        texts[c] = " ".join(words).encode()
    pairs = [(0, c) for c in texts if c] + [(5, c) for c in range(6, 60)]
    words = spark.createDataFrame([(c, bytearray(t)) for c, t in texts.items()], "class long, words binary")
    got = pm.verified(spark.createDataFrame(pairs, "a long, b long"), words, 0.8).collect()
    sets = {c: pm.weighted_shingles(t) for c, t in texts.items()}
    want = {(a, b) for a, b in pairs if pm.probability_jaccard(sets[a], sets[b]) >= 0.8}
    assert len(got) == len(want) and {(x["a"], x["b"]) for x in got} == want and 0 < len(want) < len(pairs)
