"""Exact ids of a public tokenizer, with the words it has met kept at hand.

For ``word_bpe_49k.json`` a text may be cut at ASCII white space and the parts encoded on
their own: its normalizer (NFC, white space to one space, lower case by character) never
joins characters across white space, its pre-tokenizer drops white space and no
alternative of its pattern spans it, and its special strings hold none. So

    ids(text) = ids(word 1) + ids(word 2) + ...

and each distinct word is given to the library once per worker while it is kept. To have fewer
distinct words to encode, ASCII capitals are lower-cased, and a word that ends in ASCII punctuation after a letter or
digit gets the ids of both parts when it is first met: the normalizer does the one, and the pre-tokenizer
cuts there anyway. Texts and words that hold ``<|``, with which special strings begin, are left as they are.
A word of lower-case letters a-z and U+00DF to U+00FF is what the normalizer and the pre-tokenizer make of it, so the
library's model gets it at once, its bytes spelt as the vocabulary spells them.
"""

from __future__ import annotations

import json
import os
import re
import struct

import numpy as np

from tillroll.llm.common import kept


SEPARATOR = "<|startoftext|>"  # a special string of the vocabulary: texts on its sides don't meet
_TOGETHER, _LONGEST = 512, 64
_ENTRY = 180  # bytes of two objects and a place in a dictionary, less their contents
_STOPPED = re.compile(rb"(.*(?:[a-z0-9]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))([!-&(-/:;=-@\[-`{-~]+)", re.DOTALL)
_PUNCTUATION = frozenset(b"!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~")
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
#: What the library does before its model, in the vocabulary that all this is about.
_STEPS = ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"]


def byte_spelling() -> dict[int, str]:
    """Byte-level vocabularies spell a byte as itself if it is printable, else as one of U+0100, U+0101, ..."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def words_of(text: bytes) -> list[bytes]:
    """The parts of a text that are encoded on their own."""
    return (text if b"<|" in text else text.lower()).split()


class WordCache:
    """``ids(text)`` as little-endian unsigned 32-bit ids.

    The ids of about ``most`` words of at most 64 bytes are kept, and of them at most about ``most_bytes``
    (words, ids and what Python needs for both), in two halves: when the newer
    is full the older is dropped, and words that are met again move to the newer (a matter of
    speed only). Unknown words go to the library together, with a special string
    between them; it cuts texts before anything else is done, so each word is encoded alone.
    """

    def __init__(self, path: str, most: int = 800_000, most_bytes: int = 256 << 20):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.half, self.half_bytes = Tokenizer.from_file(path), most // 2, most_bytes // 2
        self.bytes = 0
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.library.no_padding()
        self.library.no_truncation()
        self.separator_id = self.library.token_to_id(SEPARATOR)
        self.model, self.spelling = self.library.model, byte_spelling()
        spec = json.loads(self.library.to_str())
        before = [*(spec["normalizer"] or {}).get("normalizers", []), *(spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.direct = [step["type"] for step in before] == _STEPS

    def encode(self, words: list[bytes]) -> dict[bytes, bytes]:
        out = {}
        mark = SEPARATOR.encode()
        if self.direct:
            words, given = [], words
            for w in given:
                if _LETTERS.fullmatch(w):
                    ids = [t.id for t in self.model.tokenize(w.decode("latin-1").translate(self.spelling))]
                    out[w] = struct.pack(f"<{len(ids)}I", *ids)
                else:
                    words.append(w)
        odd = [w for w in words if mark in w]
        plain = [w for w in words if mark not in w]
        for e, w in zip(self.library.encode_batch_fast([w.decode() for w in odd], add_special_tokens=False), odd):
            out[w] = np.array(e.ids, "<u4").tobytes()
        for lo in range(0, len(plain), _TOGETHER):
            part = plain[lo : lo + _TOGETHER]
            joined = mark.join(part).decode()
            ids = np.array(self.library.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(ids == self.separator_id) * 4
            data = ids.tobytes()
            out.update((w, data[a:b]) for w, a, b in zip(part, [0, *(cuts + 4).tolist()], [*cuts.tolist(), len(data)]))
        return out

    def learn(self, new: set[bytes]) -> set[bytes]:
        """Words that are not at hand become known, a word with punctuation at its end from both parts.
        Returns those, with the parts, that are too long to be kept."""
        known, older = self.known, self.older
        unseen = new.difference(older)
        ends = [w for w in unseen if w[-1] in _PUNCTUATION and b"<|" not in w]
        cuts = {w: m.groups() for w in ends if (m := _STOPPED.fullmatch(w))}
        learnt = new.union(part for parts in cuts.values() for part in parts if part not in known)
        known.update((w, older[w]) for w in learnt if w in older)
        known.update(self.encode([w for w in learnt.difference(older) if w not in cuts]))
        known.update((w, known[a] + known[b]) for w, (a, b) in cuts.items())
        self.bytes += sum(map(len, learnt)) + sum(map(len, map(known.__getitem__, learnt))) + _ENTRY * len(learnt)
        long = {w for w in learnt if len(w) > _LONGEST}
        self.bytes -= sum(len(w) + len(known[w]) + _ENTRY for w in long)
        return long

    def ids(self, texts: list[bytes]) -> list[bytes]:
        out = []
        for lo in range(0, len(texts), 256):  # unknown words of several texts go together
            if len(self.known) > self.half or self.bytes > self.half_bytes:
                self.known, self.older, self.bytes = {}, self.known, 0
            known = self.known
            split = [words_of(t) for t in texts[lo : lo + 256]]
            long = self.learn(set().union(*split).difference(known))
            out += [b"".join(map(known.__getitem__, words)) for words in split]
            for w in long:
                del known[w]
        return out


def cache(path: str, most_bytes: int = 256 << 20) -> WordCache:
    """The worker's cache of a vocabulary file."""
    return kept(f"words of {path}, {most_bytes}", lambda: WordCache(path, most_bytes=most_bytes))
