"""Row keys: content hashes and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.functions.text import col


def content_hash(*parts: Column | str) -> Column:
    """SHA-256 (hex) of the parts joined by ``|``, NULL parts as empty text.

    Identical normalised content gives the same key, so replayed lines collapse. Never NULL, and
    said so to Catalyst: readers that only ask whether there is a key don't compute it.
    """
    return F.coalesce(F.sha2(F.concat_ws("|", *[F.coalesce(col(p), F.lit("")) for p in parts]), 256), F.lit(""))


def packed_hex(text: Column | str) -> Column:
    """The bytes of a text of lower-case hexadecimal digits (half as long to exchange); NULL for any other text."""
    raw = F.unhex(col(text))
    return F.when(F.lower(F.hex(raw)) == col(text), raw)


def joined_text(*parts: Column | str) -> Column:
    """The parts as ``content_hash`` joins them; a joined text is a part itself:
    ``content_hash(a, joined_text(b, c))`` is ``content_hash(a, b, c)``. Never NULL."""
    return F.coalesce(F.concat_ws("|", *[F.coalesce(col(p), F.lit("")) for p in parts]), F.lit(""))


def surrogate_key(*parts: Column | str) -> Column:
    """Stable 64-bit surrogate key of a natural key (xxhash64)."""
    return F.xxhash64(*[col(p) for p in parts])
