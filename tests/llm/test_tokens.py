"""Packing and token counts against the library's encoding of whole texts."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillroll.llm.packing import pack, pieces
from tillroll.llm.tokencount import cut_points, spliced_counts, token_counts
from tillroll.llm.wordpiece_cache import WordCache

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
CACHE = WordCache(PATH, most=50)

TEXTS = [
    "Hello, World!  It's 2024\tand\n\nwe'll  see 'em", "", None, "<|startoftext|>a<|endoftext|> b<|endoftext|>c",
    "éa ́  x y\x1cz\x85 ÀÉ ΑΣ ΟΔΟΣ 中文字 \U0001f600‍\U0001f525 ﬁ Ⅷ ½", "word " * 700, "x" * 5000,
    "nowhitespace1234567890" * 90, " \n\t ",
]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aAé.,'sve 1\n\t<|endoftxsar>́ \x1c", max_size=60))
def test_words_apart_have_the_ids_of_the_whole_text(text):
    assert np.frombuffer(CACHE.ids([text.encode()])[0], "<u4").tolist() == library_ids(text)
    many = [text, text[::-1], "", text + " " + text]
    assert [np.frombuffer(i, "<u4").tolist() for i in CACHE.ids([t.encode() for t in many])] == [library_ids(t) for t in many]


def test_words_of_letters_go_to_the_model_and_ends_are_cut_off(monkeypatch):
    cache, given = WordCache(PATH), []
    assert cache.direct
    monkeypatch.setattr(cache, "library", type("", (), {"encode_batch_fast": lambda self, texts, **_: given.extend(texts) or LIBRARY.encode_batch_fast(texts, **_)})())
    texts = ["mädchen señor ÿß naïve", "senor. señor, señor!?## Señor. x×. a÷, é'. (é) 1. ÉCOLE; it's.", "z" * 70 + "." + " " + "ö" * 40 + "..."]
    assert [np.frombuffer(i, "<u4").tolist() for i in cache.ids([t.encode() for t in texts])] == [library_ids(t) for t in texts]
    sent = "\n".join(given)
    assert "señor" not in sent and "naïve" not in sent and "é'." in sent
    assert not any(len(w) > 64 for w in cache.known)
    assert cache.bytes == sum(len(w) + len(i) + 180 for w, i in cache.known.items())


@given(st.integers(1, 20_000))
def test_pieces_are_powers_of_two_that_cover_the_document(total):
    got = pieces(total, 2048)
    assert [s for s, _ in got] == np.cumsum([0, *(n for _, n in got)])[:-1].tolist()
    assert sum(n for _, n in got) == total and all(n <= 2048 and n & (n - 1) == 0 for _, n in got)


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, uid string, length string, ids int")


def test_packed_ids_are_the_librarys(spark):
    rows = [(i, t, "u", "l", 5) for i, t in enumerate(TEXTS)] + [(None, "a b", None, None, None), (0, TEXTS[0], "u", "l", 5)]
    got = pack(documents(spark, rows), PATH, 64, 1).collect()
    assert len({r["sequence_id"] for r in got}) == len(got)
    assert all(r["offset"] == 0 and r["length"] == r["bucket"] and r["length"] & (r["length"] - 1) == 0 for r in got)
    by_doc = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"])):
        by_doc.setdefault(r["doc_id"], []).append(r)
    for i, t in enumerate(TEXTS):
        want = library_ids(t) + [1]
        parts = by_doc[i] if i else by_doc[0][: len(by_doc[0]) // 2]
        assert np.concatenate([np.frombuffer(p["ids"], "<u4") for p in parts]).tolist() == want
        assert {p["doc_tokens"] for p in parts} == {len(want)}
    assert len(by_doc[None]) == len(pieces(len(library_ids("a b")) + 1, 64))


def test_crc_of_ids_is_that_of_the_bytes(spark):
    from tillroll.llm.queries import packed_digests

    row = packed_digests(pack(documents(spark, [(1, "some words", "", "", 0)]), PATH)).first()
    want = np.array(library_ids("some words") + [1], "<u4")[: row["length"]].tobytes()
    assert row["ids_crc32"] == zlib.crc32(want)


@pytest.mark.parametrize("chunk, overlap", [(100, 8), (400, 16), (32_768, 256)])
def test_counts_of_spliced_chunks(spark, chunk, overlap):
    rows = [(i, t, "u", "l", 5) for i, t in enumerate(TEXTS)] + [(None, "a b", None, None, None), (0, TEXTS[0], "u", "l", 5)]
    got = token_counts(documents(spark, rows), PATH, chunk, overlap).collect()
    assert len(got) == len(rows)
    want = sorted((-1 if d is None else d, len((t or "").encode()), len(library_ids(t))) for d, t, *_ in rows)
    assert sorted((-1 if r[0] is None else r[0], r[1], r[2]) for r in got) == want


def test_an_overlap_without_white_space_is_widened():
    text = "a" * 1000 + " " + "b" * 1000
    assert cut_points(text, 900, 8) == [(388, 1412)] or all(" " in text[lo:hi] for lo, hi in cut_points(text, 900, 8))
    assert cut_points("a" * 5000, 900, 8) == []


def test_an_overlap_whose_encodings_differ_is_widened_after_encoding(spark, tmp_path):
    """A vocabulary with tokens of two words: what a chunk's tokens are depends on where it begins."""
    from tokenizers import models

    merges = [(" ", "a"), (" a", " a")]
    vocabulary = {"a": 0, " ": 1, " a": 2, " a a": 3, "b": 4, "<|startoftext|>": 5}
    path = str(tmp_path / "two_words.json")
    pairs = Tokenizer(models.BPE(vocab=vocabulary, merges=merges))
    pairs.save(path)
    text, lone = " a" * 500, " a" * 49 + "b" + " a" * 450
    rows = [(1, text), (2, text + " a"), (None, text), (3, lone), (4, "b" * 300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    first = spliced_counts(docs.withColumn("text_key", docs.text), path, 100, 2).collect()
    assert {r["doc_id"] for r in first if r["n_tokens"] is None} >= {1, 2, None}
    got = sorted((r["doc_id"] or 0, r["n_tokens"]) for r in token_counts(docs, path, 100, 2).collect())
    assert got == sorted((d or 0, len(pairs.encode(t).ids)) for d, t in rows)


def test_an_overlap_over_the_whole_text_leaves_one_chunk():
    assert cut_points("a b " * 100, 100, 400) == [] and cut_points("a b " * 100, 100, 399)


def test_empty_table(spark):
    none = documents(spark, [])
    assert pack(none, PATH).count() == 0 and token_counts(none, PATH).count() == 0
