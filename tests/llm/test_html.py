"""Main-text extraction: blocks, the field, and pages of known layout."""

import html
import itertools
import re
import time

import numpy as np
import pytest

from tillroll.llm import html_crf as crf

SF = "/root/testdata/sf0.01"


def texts(page):
    return [b.text for b in crf.blocks(page)]


@pytest.mark.parametrize(
    "page, want",
    [
        ("", []),
        ("plain  text\n here", ["plain text here"]),
        ("<p>a<b>b</b> c<br>d<p>e<div>f<span>g</span></div>tail", ["ab c d", "e", "fg", "tail"]),
        ("<p>&lt;b&gt; &amp;amp; &eacute;&#233;&#x1F600; &nbsp; x &copy 3&am</p>", ["<b> &amp; éé😀 x © 3&am"]),
        ("<script>var a='<p>no</p>';</script><style>p{}</style><p>yes<!-- <p>no</p> --></p>", ["yes"]),
        ("<title>t</title><head><meta charset=x></head><body><p hidden>no</p><p style='display: none'>no</p><p>ok", ["ok"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><table><tr><td>e<td>f<tr><td>g</table>", ["a", "b", "c", "d", "e", "f", "g"]),
        ('<p title="a > b">x</p><p>1 < 2 and 3</p><p cla', ["x", "1 < 2 and 3"]),
        ("<p>cut <!-- never closed", ["cut"]),
        ("<p>a</p><script>never closed <p>b</p>", ["a"]),
        ("</div></p>x</nav>y", ["x", "y"]),
    ],
)
def test_blocks(page, want):
    assert texts(page) == want


def test_viterbi_is_the_best_of_all_paths():
    field = crf.Field({"bias": 0.3, "tag:p": 0.9, "tag:li": -1.1, "end:stop": 0.4}, ((0.7, -0.5), (-0.8, 0.6)))
    page = crf.blocks("<li>a<p>b.<li>c<p>d<li>e.<p>f.")
    emit = [sum(field.weights.get(f, 0) for f in fs) for fs in crf.features(page)]

    def score(path):
        return sum(e for e, y in zip(emit, path) if y) + sum(field.step[a][b] for a, b in zip(path, path[1:]))

    best = max(itertools.product((0, 1), repeat=len(page)), key=score)
    assert field.decode(page) == [bool(y) for y in best]


def test_fit_ends_where_the_likelihood_over_all_paths_is_flat():
    r = np.random.default_rng(5)
    tags, pages = ("p", "li", "h2"), []
    for _ in range(12):
        page = crf.blocks("".join(f"<{tags[i]}>x" for i in r.integers(0, 3, int(r.integers(2, 6)))))
        pages.append((page, [bool(r.random() < (0.8 if b.tag == "p" else 0.3)) for b in page]))
    decay, total = 1e-2, sum(len(p) for p, _ in pages)
    field = crf.fit(pages, rounds=2500, rate=0.02, decay=decay)
    names = sorted(field.weights)
    at = np.array([field.weights[n] for n in names] + [x for row in field.step for x in row])

    def loss(x):
        weights, step = dict(zip(names, x)), x[len(names) :].reshape(2, 2)
        out = 0.0
        for page, labels in pages:
            emit = [sum(weights.get(f, 0.0) for f in set(fs)) for fs in crf.features(page)]

            def score(path):
                return sum(e for e, y in zip(emit, path) if y) + sum(step[a][b] for a, b in zip(path, path[1:]))

            paths = np.array([score(p) for p in itertools.product((0, 1), repeat=len(page))])
            out += np.log(np.exp(paths).sum()) - score([int(y) for y in labels])
        return out / total + decay / 2 * (x**2).sum()

    for i in range(len(at)):
        e = np.zeros(len(at))
        e[i] = 1e-4
        assert abs(loss(at + e) - loss(at - e)) / 2e-4 < 2e-3
    assert abs(at).max() > 0.3


@pytest.mark.parametrize(
    "page",
    [
        "".join(f'<div id="q{"abcdefghij"[i % 10]}{"x" * (i % 997)}"><p>t' for i in range(20_000)),
        "<svg>a" * 100_000,
        "<b>a</i><hr>" * 30_000,
        "<div>" * 30_000 + "</i></p>" * 30_000,
    ],
)
def test_deep_and_unclosed_pages_take_time_in_proportion(page):
    field = crf.trained()
    begun = time.process_time()
    field.main_text(page)
    assert time.process_time() - begun < 10


def test_features_that_the_model_does_not_know_change_nothing():
    field = crf.trained()
    for page, _ in zip(_raw_pages(), range(40)):
        whole = crf.blocks(page)
        assert field.main_text(page) == "\n".join(b.text for b, keep in zip(whole, field.decode(whole)) if keep)


def _raw_pages():
    import pyarrow.parquet as pq

    return [h for h in pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"])["html"].to_pylist() if h]


def test_other_labelled_pages_are_read_right():
    wrong = total = 0
    for found, labels in crf.labelled_pages(200, seed=99):
        got = crf.trained().decode(found)
        wrong += sum(a != b for a, b in zip(got, labels))
        total += len(labels)
    assert wrong / total < 0.04


def expected(page):
    article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = [" ".join(html.unescape(re.sub(r"</?b>", "", p).replace("<br>", " ")).split()) for p in re.split(r"</?(?:p|h1)>", article)]
    return "\n".join(p for p in parts if p)


def test_pages_of_the_tables(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in crf.extract(spark, pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    assert np.mean([got[r["page_id"]] == expected(r["html"]) for r in rows]) == 1.0


def test_odd_rows(spark):
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (None, "u", "<p>", "t"), (1, "u", "<article><p>A long enough sentence, I say.</p></article>" * 3, "t")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = crf.extract(spark, df).collect()
    assert sorted(r["text"] for r in got)[:3] == ["", "", ""] and len(got) == 4
    assert crf.extract(spark, df.filter("false")).count() == 0
    long = "<article>" + "<p>Some sentence of a very long article, again and again.</p>" * 20_000 + "</article>"
    assert crf.trained().main_text(long).count("\n") == 19_999
