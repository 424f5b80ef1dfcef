"""Column functions over URIs and document bytes (all JVM-side)."""

from __future__ import annotations

import codecs

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

REPLACEMENT_CHAR = "�"
# Genuine replacement characters while invalid bytes are removed: escape character first.
ESCAPES = [("\x01", "\x01\x02"), (REPLACEMENT_CHAR, "\x01\x03")]


def filename_of(uri: Column) -> Column:
    """Text after the last ``/`` (empty for a URI ending in ``/``)."""
    return F.substring_index(uri, "/", -1)


def extension_of(uri: Column) -> Column:
    """Lower-cased text after the last ``.`` of the filename, ``''`` without a dot.

    Query strings are not stripped: ``4.html?x=1`` has extension ``html?x=1``.
    """
    name = filename_of(uri)
    return F.when(F.instr(name, ".") > 0, F.lower(F.substring_index(name, ".", -1))).otherwise(F.lit(""))


def decode_utf8(content: Column) -> Column:
    """UTF-8 decode that drops invalid bytes (like ``bytes.decode(errors="ignore")``).

    Valid input is a plain cast. Invalid input is repaired, which puts U+FFFD
    where bytes were bad, and those are removed; a genuine U+FFFD is written
    as two control characters meanwhile (and that escape is itself escaped),
    so it stays. Null stays null.
    """
    text = content.cast("string")
    kept = text
    for plain, coded in ESCAPES:
        kept = F.replace(kept, F.lit(plain), F.lit(coded))
    kept = F.replace(F.make_valid_utf8(kept), F.lit(REPLACEMENT_CHAR), F.lit(""))
    for plain, coded in reversed(ESCAPES):
        kept = F.replace(kept, F.lit(coded), F.lit(plain))
    return F.when(F.is_valid_utf8(text), text).otherwise(kept)


def _decode_other(encoding: str):
    @F.pandas_udf("string")
    def decode(content: pd.Series) -> pd.Series:
        return content.map(lambda b: None if b is None else bytes(b).decode(encoding, errors="ignore"))

    return decode


def decode_bytes(content: Column, encoding: str = "utf-8") -> Column:
    """Decode with ``encoding``, ignoring bad bytes. UTF-8, Latin-1 and ASCII
    stay in the JVM; other encodings use a vectorised Python decoder."""
    name = codecs.lookup(encoding).name
    if name == "utf-8":
        return decode_utf8(content)
    if name == "iso8859-1":
        return F.decode(content, "ISO-8859-1")
    if name == "ascii":
        return F.regexp_replace(F.decode(content, "ISO-8859-1"), r"[\x80-\xff]", "")
    return _decode_other(encoding)(content)


def byte_prefix_text(content: Column, max_bytes: int | None) -> Column:
    """First ``max_bytes`` bytes decoded leniently (a cut character is dropped);
    ``None`` decodes the whole content; null → ``''``."""
    part = content if max_bytes is None else F.substring(content, 1, max_bytes)
    return F.coalesce(decode_utf8(part), F.lit(""))


def char_prefix(text: Column, max_chars: int | None) -> Column:
    """First ``max_chars`` characters; ``None`` keeps the whole text."""
    return text if max_chars is None else F.substring(text, 1, max_chars)


def text_bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")
