"""Text expressions: normalisation and guards over whole texts."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from caselake.catalogs import QUESTION_MAX_CHARS, QUESTION_MIN_CHARS
from caselake.functions import as_col


def clean_upper(value: Column | str) -> Column:
    return F.upper(F.trim(as_col(value)))


def clean_title(value: Column | str) -> Column:
    return F.initcap(F.trim(as_col(value)))


def first_term(lowered: Column | str, terms: Iterable[str], whole_words: bool = False) -> Column:
    """First term of the list a lower-cased text contains, NULL when it contains none.

    ``whole_words`` asks for word boundaries, so a short term such as an
    abbreviation does not hit inside longer words.
    """
    lowered = as_col(lowered)

    def hit(term: str) -> Column:
        if whole_words:
            return lowered.rlike(rf"(?U)(?<!\w){re.escape(term)}(?!\w)")
        return lowered.contains(term)

    return F.coalesce(*[F.when(hit(t), F.lit(t)) for t in terms])


def blocked_term(text: Column | str, terms: Iterable[str], whole_words: bool = False) -> Column:
    """:func:`first_term` of a text in any case."""
    return first_term(F.lower(as_col(text)), terms, whole_words)


def matches_any(text: Column | str, patterns: Iterable[str]) -> Column:
    """True when one of the patterns occurs in the text."""
    text = as_col(text)
    found = F.lit(False)
    for pattern in patterns:
        found = found | text.rlike(pattern)
    return found


def correct_terms(text: Column | str, corrections: Mapping[str, str]) -> Column:
    """Replace each wrong wording in turn, ignoring case (accented letters included)."""
    result = as_col(text)
    for wrong, right in corrections.items():
        replacement = right.replace("\\", "\\\\").replace("$", "\\$")
        result = F.regexp_replace(result, rf"(?iu)\Q{wrong}\E", replacement)
    return result


def fold_case(text: Column | str) -> Column:
    """Text in one case, in which a Latin-1 letter equals all letters a case-blind match accepts for it.

    Besides lower-casing that takes the dotless i, the long s and the dot that
    the dotted capital I leaves behind.
    """
    return F.translate(F.lower(as_col(text)), "ıſ\u0307", "is")


def foldable(term: str) -> bool:
    """Whether :func:`fold_case` finds every case-blind match of the term (Latin-1, one-to-one letters)."""
    return all(ch < "\u0100" and ch not in "ßµ" for ch in term)


def mentions_any(folded: Column | str, terms: Iterable[str]) -> Column:
    """True when a text in one case contains one of the terms in any case."""
    folded, found = as_col(folded), F.lit(False)
    for term in terms:
        found = found | folded.contains(fold_case(F.lit(term)))
    return found


def length_problem(
    text: Column | str, low: int = QUESTION_MIN_CHARS, high: int = QUESTION_MAX_CHARS
) -> Column:
    """``curta`` below ``low`` trimmed characters (or NULL), ``longa`` above ``high``, else NULL."""
    text = as_col(text)
    trimmed = F.regexp_replace(text, r"^\s+|\s+$", "")
    return (
        F.when(text.isNull() | (F.length(trimmed) < low), "curta")
        .when(F.length(text) > high, "longa")
    )


def source_reliability(url: Column | str, domains: Mapping[str, str], default: str) -> Column:
    """Reliability label of the first domain the address contains."""
    url = as_col(url)
    return F.coalesce(*[F.when(url.contains(d), F.lit(label)) for d, label in domains.items()],
                      F.lit(default))
