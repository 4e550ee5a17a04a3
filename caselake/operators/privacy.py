"""Separation of personal data from analytical data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselake.catalogs import (
    DIRECT_PII, FALLBACK_KEY_COLUMNS, QUASI_PII_HIGH, SOURCE_SYSTEM, UNANALYTIC_COLUMNS,
)
from caselake.functions import keys
from caselake.functions.names import drop_present


def add_case_key(df: DataFrame, salt: str, fallback: Iterable[str] = FALLBACK_KEY_COLUMNS) -> DataFrame:
    """Pseudonymous case key; rows without an identifier are told apart by the fallback columns."""
    fallback = [c for c in fallback if c in df.columns]
    key = keys.natural_key("nu_notific", fallback)
    return df.withColumn("hash_caso", keys.pseudonymize(key, salt))


def pii_columns(df: DataFrame) -> list[str]:
    """Personal columns the frame really has; none at all means the wrong input."""
    present = [c for c in (*DIRECT_PII, *QUASI_PII_HIGH) if c in df.columns]
    if not present:
        raise ValueError("no personal-data column found: build the vault before dropping columns")
    return present


def build_pii_vault(df: DataFrame, salt: str, run_id: str) -> DataFrame:
    """Distinct case key plus (hash, clear text) per personal column.

    The clear text exists only here; store the result apart from analytical tables.
    """
    pairs = []
    for name in pii_columns(df):
        pairs += [keys.pseudonymize(name, salt).alias(f"{name}_hash"), F.col(name)]
    return (
        add_case_key(df, salt)
        .select("hash_caso", "nu_notific", *pairs, "nome_arquivo_origem")
        .distinct()
        .withColumns({"origem_sistema": F.lit(SOURCE_SYSTEM), "run_id": F.lit(run_id)})
    )


def mask_for_analytics(
    df: DataFrame, salt: str, hash_columns: Iterable[str] = QUASI_PII_HIGH
) -> DataFrame:
    """Drop personal and unanalytic columns; ``hash_columns`` stay visible as ``<name>_hash``."""
    hashed = {f"{c}_hash": keys.pseudonymize(c, salt) for c in hash_columns if c in df.columns}
    return drop_present(
        df.withColumns(hashed), (*DIRECT_PII, *QUASI_PII_HIGH, *UNANALYTIC_COLUMNS)
    )
