"""Shared helpers: table scans, staged tables, and vectorised scanning of words.

Operators stage tables in the session's workspace below the shared folder: their results are
lazy and may read them until ``staging.release`` or the end of the application removes them.

Words are found on UTF-8 bytes. ``letters_and_digits`` lower-cases A-Z and turns every
ASCII character that is neither a letter nor a digit into a space, so that a word is a
run of letters, digits and non-ASCII characters. Word n-grams are hashed straight from
the bytes: a prefix sum of ``(byte + 1) * P**i`` (mod 2**64, P odd, hence invertible)
gives the hash of any byte range independent of where it stands, without a Python loop
over words. Hashes only select candidates; results are always verified on the words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.staging import Workspace, session_workspace
from tillroll.sources.tables import table

__all__ = ["Workspace", "letters_and_digits", "ngram_hashes", "session_workspace", "table", "word_spans"]

_FOLD = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256)
)
_MASK = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_STEP_WORDS = 1 << 17


def letters_and_digits(text: bytes) -> bytes:
    """The words of ``text``, lower-cased (A-Z) and joined by single spaces."""
    return b" ".join(text.translate(_FOLD).split())


def word_spans(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of a text joined by single spaces."""
    if not joined:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate([[0], gaps + 1])
    return starts, np.concatenate([gaps, [len(joined)]])


def row_key(uid: str | None) -> Column:
    """The rows' key as ``uid``: the column of that name, else a number. The number changes with
    the scan's partitions, so it only holds within what is staged with it."""
    return (F.monotonically_increasing_id() if uid is None else F.col(uid).cast("long")).alias("uid")


class _Powers:
    """P**i and P**-i (mod 2**64), grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << max(16, (n - 1).bit_length())
            for name, base in (("up", _P), ("down", _P_INV)):
                f = np.full(size, base, np.uint64)
                f[0] = 1
                setattr(cls, name, np.multiply.accumulate(f))
        return cls.up, cls.down


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def ngram_hashes(joined: bytes, n: int, spans: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """64-bit hash of every n-word window, in order (empty if there are fewer words).

    Worked off in steps of ``_STEP_WORDS`` words, so a very long text needs bounded memory
    beside its own bytes.
    """
    starts, ends = spans
    total = len(starts) - n + 1
    if total <= 0:
        return np.empty(0, np.uint64)
    data, parts = np.frombuffer(joined, np.uint8), []
    for lo in range(0, total, _STEP_WORDS):
        hi = min(lo + _STEP_WORDS, total)
        first, last = int(starts[lo]), int(ends[hi + n - 2])
        up, down = _Powers.upto(last - first + 1)
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum((data[first:last].astype(np.uint64) + np.uint64(1)) * up[: last - first], out=sums[1:])
        s, e = starts[lo:hi] - first, ends[lo + n - 1 : hi + n - 1] - first
        parts.append(mix((sums[e] - sums[s]) * down[s]))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def prefix_hashes(joined: bytes, sizes: tuple[int, ...], spans: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
    """Per size, 64-bit hashes of the first ``size`` bytes of the words that are longer."""
    starts, ends = spans
    data, out = np.frombuffer(joined, np.uint8), []
    up, _ = _Powers.upto(max(sizes))
    for size in sizes:
        s = starts[ends - starts > size]
        h = np.zeros(len(s), np.uint64)
        for i in range(size):
            h += (data[s + i].astype(np.uint64) + np.uint64(1)) * up[i]
        out.append(mix(h ^ np.uint64(size)))
    return out


def fresh(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column bears it."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], object]):
    """An object that a worker process keeps from task to task (a cache)."""
    if name not in _KEPT:
        _KEPT[name] = make()
    return _KEPT[name]


def _give_back() -> None:
    """Returns what earlier tasks have freed to the system; allocators hold it for the process."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def slices(batches: Iterator, weigh: str, most_bytes: int = 4 << 20, keep: bool = False) -> Iterator:
    """Cut Arrow batches into pieces of about ``most_bytes`` of the column ``weigh``.

    A worker process serves tasks of one operator after the other; a task that doesn't ``keep``
    what the ones before have kept drops it, so that the operators' caches don't add up.
    """
    if not keep:
        _KEPT.clear()
    _give_back()
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = max(1, batch.column(weigh).nbytes)
        rows = max(1, int(batch.num_rows * most_bytes / size))
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


def bit_table(keys: DataFrame, column: str, per_key: int = 16, least: int = 1 << 23, most: int = 1 << 29) -> np.ndarray:
    """Bit table of 64-bit keys with at least ``per_key`` bits for each of the counted keys, so that
    hardly one key in ``per_key`` that was not added tests true; a key that was added always does.

    The size is a power of two from ``least`` (1 MB) to ``most`` (64 MB, some 33 million keys; beyond
    them more keys test true, which costs time only). The words are or-ed together on the executors;
    at most ``bits / 64`` rows of 12 bytes reach the driver.
    """
    bits, many = least, keys.filter(F.col(column).isNotNull()).count()
    while bits < min(per_key * many, most):
        bits *= 2
    slot = F.pmod(F.col(column), F.lit(bits))
    rows = (
        keys.filter(F.col(column).isNotNull())
        .select((slot / 64).cast("int").alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int")).alias("b"))
        .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    )
    out = np.zeros(bits // 64, np.int64)
    out[rows.column("w").to_numpy()] = rows.column("b").to_numpy()
    return out.view(np.uint8)


def in_table(table_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which int64/uint64 ``keys`` may be in the bit table (never misses one that is)."""
    slot = keys.astype(np.uint64) & np.uint64(len(table_) * 8 - 1)
    return (table_[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
