"""Hash keys: pseudonyms, natural keys, fingerprints, surrogate keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake.functions import as_col

SEPARATOR = "||"
MISSING = "n/a"


def _text_or(value: Column | str, missing: str) -> Column:
    return F.coalesce(as_col(value).cast("string"), F.lit(missing))


def pseudonymize(value: Column | str, salt: str) -> Column:
    """Salted SHA-256: equal values give equal hashes, so hashed columns still join."""
    return F.sha2(F.concat_ws(SEPARATOR, F.lit(salt), _text_or(value, "")), 256)


def trimmed_text(columns: Iterable[Column | str]) -> Column:
    """The trimmed text of the columns in one, NULL written as ``n/a``: what :func:`trimmed_hash` digests."""
    return F.concat_ws(SEPARATOR, *[F.coalesce(F.trim(as_col(c).cast("string")), F.lit(MISSING)) for c in columns])


def trimmed_hash(columns: Iterable[Column | str]) -> Column:
    """SHA-256 over the trimmed text of the columns, NULL written as ``n/a``."""
    return F.sha2(trimmed_text(columns), 256)


def row_fingerprint(columns: Iterable[str], exclude: Iterable[str] = ()) -> Column:
    """Content hash of a row over its non-technical columns, independent of column order."""
    return trimmed_hash(sorted(set(columns) - set(exclude)))


def natural_key(identifier: Column | str, fallback: Iterable[Column | str]) -> Column:
    """The identifier when it is filled in, else a hash of the fallback columns."""
    text = as_col(identifier).cast("string")
    return F.when(text.isNotNull() & (F.trim(text) != ""), text).otherwise(trimmed_hash(fallback))


def surrogate_key(*columns: Column | str, missing: dict[int, str] | None = None) -> Column:
    """Deterministic key shared by a dimension and its fact; ``missing`` overrides ``n/a`` by position."""
    missing = missing or {}
    parts = [_text_or(c, missing.get(i, MISSING)) for i, c in enumerate(columns)]
    return F.sha2(F.concat_ws(SEPARATOR, *parts), 256)


def time_key(day: Column | str) -> Column:
    """Key of a calendar day, NULL for a missing day."""
    return F.sha2(as_col(day).cast("string"), 256)


#: First byte of a packed text: 32 bytes of a digest follow, or the text as it is.
_DIGEST, _TEXT = bytearray(b"\x01"), bytearray(b"\x00")


def pack_digest(value: Column | str) -> Column:
    """A text as bytes, a SHA-256 text in half its length; equal texts give equal bytes and no others do.

    Digests compare among themselves as their texts do.
    """
    text = as_col(value)
    raw = F.unhex(F.when((F.octet_length(text) == 64) & (F.lower(text) == text), text))  # NULL unless all are hex digits
    return F.coalesce(F.concat(F.lit(_DIGEST), raw), F.concat(F.lit(_TEXT), text.cast("binary")))


def unpack_digest(value: Column | str) -> Column:
    """The text that :func:`pack_digest` packed."""
    packed = as_col(value)
    body = F.substring(packed, F.lit(2), F.octet_length(packed))
    return F.when(F.substring(packed, 1, 1) == F.lit(_DIGEST), F.lower(F.hex(body))).otherwise(body.cast("string"))


def digest_columns(df: DataFrame, *more: str) -> list[str]:
    """Text columns that hold digests by their names, and those of ``more`` that hold text."""
    named = [c for c in df.columns if c in more or c.startswith(("hash_", "sk_")) or c.endswith("_hash")]
    return [c for c in named if df.schema[c].dataType == T.StringType()]


def pack_digests(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows as they go into a shuffle: digests do not compress as text."""
    return df.withColumns({c: pack_digest(c) for c in columns})


def unpack_digests(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: unpack_digest(c) for c in columns})
