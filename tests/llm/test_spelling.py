"""Spelling variants against comparing every pair of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from tillroll.llm import spelling
from tillroll.llm.common import table


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    forms, near = {}, {w: [] for w in words}
    for w in words:
        near[w] = [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(v, w)]
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        while forms[w] is not None:
            w = forms[w]
        return w

    return {w: (forms[w], root(w), n, len(near[w]), words[forms[w]] if forms[w] else None) for w, n in words.items()}


def corpus(seed: int, stems: int, edits: int):
    """Words, their misspellings once to thrice removed, in texts of odd shape."""
    rnd = random.Random(seed)
    letters = "abcdeinorstéß×"
    words = Counter()
    for _ in range(stems):
        w = "".join(rnd.choices(letters, k=rnd.randint(5, 10)))
        n = rnd.choice((700, 130, 60, 25))
        for _ in range(rnd.randint(1, 4)):
            words[w] += n
            for _ in range(edits):
                i, c = rnd.randrange(len(w)), rnd.choice(letters)
                v = rnd.choice((w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :], w[:i] + c + w[i:]))
                words[v] += max(5, n // rnd.choice((4, 5, 6, 12)))
            w, n = v, n // 5
    tokens = [w for w, n in words.items() for _ in range(n)]
    rnd.shuffle(tokens)
    texts = [" ".join(tokens[i : i + 400]).replace(" a", " A") for i in range(0, len(tokens), 400)]
    return [(i, t) for i, t in enumerate(texts)] + [(None, None), (7, ""), (8, "1234 ... 一"), (None, "Wortlaut " * 9), (9, "wortlaute" * 400)]


def found(spark, rows):
    docs = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], "doc_id long, text string, word string, n int, width int")
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spelling.variants(spark, docs).collect()}


@pytest.mark.parametrize("small", [False, True])
def test_variants_equal_comparing_all_pairs(spark, monkeypatch, small):
    if small:  # many cells, pieces of cells and of queries
        monkeypatch.setattr(spelling, "CELL_WORDS", 12)
        monkeypatch.setattr(spelling, "CELL_QUERIES", 30)
    rows = corpus(11, 60, 3)
    want = brute(rows)
    assert found(spark, rows) == want
    assert sum(w[0] is not None for w in want.values()) > 50 and any(w[0] != w[1] for w in want.values() if w[0])


def test_words_of_equal_letters_are_dealt_over_pieces(spark, monkeypatch):
    """A letter bag with a third of all words, next to another such bag."""
    monkeypatch.setattr(spelling, "CELL_WORDS", 8)
    rnd = random.Random(3)
    bags = ["aabbccdd", "aabbccde", "qrstuvw"]
    words = {"".join(rnd.sample(bag, len(bag))) for bag in bags for _ in range(60)}
    rows = [(i, f"{w} " * rnd.choice((5, 8, 40))) for i, w in enumerate(sorted(words))]
    assert found(spark, rows) == brute(rows)


def test_real_texts(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, "/root/testdata/sf0.01", "documents").limit(150).collect()]
    assert found(spark, rows) == brute(rows)


def test_no_words(spark):
    assert found(spark, []) == {} and found(spark, [(1, None), (2, "short")]) == {}


def test_every_edit_once():
    for word, other in (("aab", "aaab"), ("abcb", "abb"), ("aaa", "aba")):
        made = [m for gone in set(word) for come in "abc" if come != gone for m in spelling.edits(word, gone, come)]
        assert len(made) == len(set(made)) and all(one_edit(word, m) for m in made)
        inserted = [m for come in "abc" for m in spelling.edits(word, "", come)]
        assert len(inserted) == len(set(inserted)) and (len(other) < len(word) or other in inserted or len(other) == len(word))


def test_range_search_prunes_and_loses_nothing():
    rnd = random.Random(5)
    words = sorted({"".join(rnd.choices("abcdefgh", k=7)) for _ in range(600)})
    x = spelling.points(words)
    tree = spelling.kd_tree(x)
    pairs = {(a, b) for at, to in spelling.range_pairs(tree, x, x, 2) for a, b in zip(at.tolist(), to.tolist())}
    want = {(i, j) for i in range(len(x)) for j in range(len(x)) if abs(x[i] - x[j]).sum() == 2}
    assert pairs == want


def test_long_texts_are_cut_between_words():
    text = "wort " * 50 + "x" * 300 + " ende, Größe"
    for size in (1, 7, 64, 10_000):
        cut = list(spelling.pieces(text, size))
        assert "".join(cut) == text
        assert Counter(r for p in cut for r in re.findall("[A-Za-zÀ-ÿ]+", p)) == Counter(re.findall("[A-Za-zÀ-ÿ]+", text))
