"""Coded values: decoding, bands, flags, rates."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from caselake.catalogs import (
    AGE_EDGES, AGE_LABELS, NOT_INFORMED, SEVERITY_LIMITS, SEVERITY_OK, SEVERITY_ORDER, Flag,
)
from caselake.functions import as_col


def decode(value: Column | str, mapping: Mapping, default: str | Column | None = NOT_INFORMED) -> Column:
    """Label of a code; ``default`` for NULL and unknown codes."""
    value = as_col(value)
    default = default if isinstance(default, Column) else F.lit(default)
    cases = reduce(
        lambda acc, kv: acc.when(value == F.lit(kv[0]), F.lit(kv[1])), mapping.items(), F
    )
    return cases.otherwise(default)


def decode_map(value: Column | str, mapping: Mapping) -> Column:
    """Map look-up form of :func:`decode`: NULL for NULL and unknown codes."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), as_col(value))


def normalize_age(value: Column | str, unit: Column | str) -> Column:
    """Age in years from a number and its unit (3 years, 2 months, 1 days); NULL for other units."""
    value, unit = as_col(value).cast("double"), as_col(unit)
    return (
        F.when(unit == 3, value)
        .when(unit == 2, F.round(value / F.lit(12.0), 1))
        .when(unit == 1, F.round(value / F.lit(365.0), 1))
    )


def bucketize(
    value: Column | str,
    edges: Sequence[float] = AGE_EDGES,
    labels: Sequence[str] = AGE_LABELS,
    missing: str = "Ignorado",
) -> Column:
    """Label of the first band whose upper edge exceeds the value; last label above all edges."""
    value = as_col(value)
    cases = F.when(value.isNull(), missing)
    for edge, label in zip(edges, labels):
        cases = cases.when(value < edge, label)
    return cases.otherwise(labels[-1])


def count_present(columns: Iterable[Column | str]) -> Column:
    """Number of non-NULL values among the columns (a blank counts as present)."""
    return reduce(add, [F.when(as_col(c).isNotNull(), 1).otherwise(0) for c in columns], F.lit(0))


def flag(rule: Flag) -> Column:
    """Integer 0/1 column of a flag rule; NULL codes give 0."""
    if rule.column is None:
        return F.lit(1)
    hit = F.col(rule.column).isin(*rule.codes)
    cases = F.when(hit, 1)
    if rule.or_present:
        cases = cases.when(F.col(rule.or_present).isNotNull(), 1)
    return cases.otherwise(0)


def safe_rate(numerator: Column | str, denominator: Column | str, digits: int = 4) -> Column:
    """Rounded ratio, NULL unless the denominator is positive."""
    num, den = as_col(numerator), as_col(denominator)
    return F.when(den > 0, F.round(num / den, digits))


def scale_percent(rate: Column | str, digits: int = 2) -> Column:
    return F.round(as_col(rate) * 100, digits)


def severity(validity: Column | str) -> Column:
    """Severity class of a validity share."""
    validity = as_col(validity)
    cases = reduce(
        lambda acc, limit: acc.when(validity < limit[0], limit[1]), SEVERITY_LIMITS, F
    )
    return cases.otherwise(SEVERITY_OK)


def severity_rank(label: Column | str) -> Column:
    """Sort key that puts the worst severity first."""
    ranks = {name: i for i, name in enumerate(SEVERITY_ORDER)}
    return decode(label, ranks, default=F.lit(len(ranks)))
