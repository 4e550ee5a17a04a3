"""Column names: snake_case without accents, unique."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SEPARATORS = re.compile(r"[\s\-./\\()_]+")
_NOT_ALNUM = re.compile(r"[^a-z0-9]")


def sanitize_name(name: str) -> str:
    decomposed = unicodedata.normalize("NFKD", name)
    plain = "".join(ch for ch in decomposed if not unicodedata.combining(ch)).lower()
    words = (_NOT_ALNUM.sub("", word) for word in _SEPARATORS.split(plain))
    return "_".join(word for word in words if word)


def sanitize_names(names: Iterable[str]) -> list[str]:
    """Clean names; later collisions become ``x_dup``, ``x_dup2``, ``x_dup3`` ..."""
    taken: set[str] = set()
    result = []
    for name in names:
        base = candidate = sanitize_name(name)
        n = 0
        while candidate in taken:
            n += 1
            candidate = f"{base}_dup{n if n > 1 else ''}"
        taken.add(candidate)
        result.append(candidate)
    return result


def sanitize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*sanitize_names(df.columns))


def ensure_column(df: DataFrame, name: str, data_type: str) -> DataFrame:
    """Cast an existing column, or add it as typed NULL."""
    value: Column = F.col(name) if name in df.columns else F.lit(None)
    return df.withColumn(name, value.cast(data_type))


def drop_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Projection without the listed columns; names the frame does not have are ignored."""
    excluded = set(names)
    return df.select(*[c for c in df.columns if c not in excluded])
