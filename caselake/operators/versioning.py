"""Type-2 history on immutable files.

A merge never windows over a key's rows. Each key is summarised by partially
aggregated first and last rows, and the summary is joined back in a way the
adaptive skew join can split, so a key with very many rows in one delivery does
not end in one task. Closed history passes through untouched.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.catalogs import FALLBACK_KEY_COLUMNS, TECHNICAL_COLUMNS
from caselake.functions import keys
from caselake.operators import dedup
from caselake.operators.joins import join_summary

CURRENT, START, END = "registro_mais_atual", "dh_inicio_vigencia", "dh_fim_vigencia"


def fingerprint_cases(df: DataFrame, exclude: Iterable[str] = TECHNICAL_COLUMNS) -> DataFrame:
    return df.withColumn("hash_registros", keys.row_fingerprint(df.columns, exclude))


def dedup_case_versions(df: DataFrame, fallback: Iterable[str] = FALLBACK_KEY_COLUMNS) -> DataFrame:
    """One row per (natural key, content): the latest ingested."""
    key = keys.natural_key("nu_notific", [c for c in fallback if c in df.columns])
    digests = keys.digest_columns(df)
    kept = dedup.keep_latest(
        keys.pack_digests(df.withColumn("_key", key), digests), ["_key", "hash_registros"], "dh_ingestao_bronze",
        ties=[c for c in ("nome_arquivo_origem",) if c in df.columns],
    )
    return keys.unpack_digests(kept.drop("_key"), digests)


def current_view(df: DataFrame, flag: str = CURRENT) -> DataFrame:
    return df.filter(F.col(flag))


def _position(order: Iterable[str], fingerprint: str) -> Column:
    """Place of a version among the versions of its key; the fingerprint settles ties."""
    return F.struct(*order, fingerprint)


def _packed(df: DataFrame, key: str, digests: Iterable[str]) -> DataFrame:
    """Rows of known keys with packed digests. A packed key cannot be NULL, so that joins on it need not filter it again."""
    packed = keys.pack_digests(df.filter(F.col(key).isNotNull()), digests)
    return packed.withColumn(key, F.coalesce(key, F.lit(bytearray()))) if key in digests else packed


def scd2_first_load(
    source: DataFrame, now: Column, key: str = "hash_caso", fingerprint: str = "hash_registros",
    order: Iterable[str] = ("dh_ultima_atualizacao",),
) -> DataFrame:
    """History of a first delivery: the last version of every key is the current one."""
    position, digests = _position(order, fingerprint), keys.digest_columns(source, key, fingerprint)
    rows = _packed(source, key, digests)
    last = rows.groupBy(key).agg(F.max(position).alias("_last"))
    is_last = position == F.col("_last")
    return join_summary(rows, last, key).select(
        *[keys.unpack_digest(c).alias(c) if c in digests else F.col(c) for c in source.columns],
        is_last.alias(CURRENT),
        now.alias(START),
        F.when(~is_last, now).alias(END),
    )


def scd2_changes(
    current: DataFrame,
    source: DataFrame,
    now: Column,
    key: str = "hash_caso",
    fingerprint: str = "hash_registros",
    order: Iterable[str] = ("dh_ultima_atualizacao",),
    mode: str = "versions",
    known: DataFrame | None = None,
    only_changes: bool = False,
) -> DataFrame:
    """Current rows after a delivery, plus every row the delivery closes.

    ``only_changes`` leaves out current rows that stay as they are, so ``current``
    and ``known`` need hold the delivered keys alone.

    ``versions``: a changed key closes its current row and opens the new
    version; several versions of a key in one delivery chain in ``order`` and
    only the last stays current. ``close_only``: changed current rows are
    closed and only unknown keys are inserted; ``known`` names keys that exist
    in closed rows alone.

    ``source`` holds at most one row per (key, fingerprint). Stored and
    delivered rows travel together, so the wide rows are shuffled once; the
    per-key summary beside them carries only key, order and fingerprint; digests
    are packed for both.
    """
    if mode not in ("versions", "close_only"):
        raise ValueError(f"unknown merge mode {mode!r}")
    columns = [*current.columns, *[c for c in source.columns if c not in current.columns]]
    rows = current.withColumn("_new", F.lit(False)).unionByName(
        source.withColumn("_new", F.lit(True)), allowMissingColumns=True
    )
    digests = keys.digest_columns(rows, key, fingerprint)
    rows = _packed(rows, key, digests)
    new, position = F.col("_new"), _position(order, fingerprint)
    narrow = rows.select(key, "_new", *order, fingerprint)
    if known is not None:
        narrow = narrow.unionByName(
            _packed(known.select(key), key, [c for c in digests if c == key]).withColumn("_new", F.lit(False)),
            allowMissingColumns=True,
        )
    summary = narrow.groupBy(key).agg(
        F.min(F.when(new, position)).alias("_first"),
        F.max(F.when(new, position)).alias("_last"),
        F.count_if(new).alias("_delivered"),
        F.count_if(~new).alias("_stored"),
        F.max(F.when(~new, F.col(fingerprint))).alias("_current"),
    )

    first_is_current = F.coalesce(F.col(f"_first.{fingerprint}") == F.col("_current"), F.lit(False))
    changed = (F.col("_delivered") > 1) | ((F.col("_delivered") == 1) & ~first_is_current)
    if mode == "versions":
        enters = ~(first_is_current & (position == F.col("_first")))
        stays_current = position == F.col("_last")
    else:
        enters = F.col("_stored") == 0
        stays_current = F.lit(True)
    return (
        join_summary(rows, summary, key)
        .filter(~new | enters)
        .withColumn("_is_current", F.when(new, stays_current).otherwise(~changed))
        .filter(new | ~F.col("_is_current") if only_changes else F.lit(True))
        .withColumns(
            {
                CURRENT: F.col("_is_current"),
                START: F.when(new, now).otherwise(F.col(START)),
                END: F.when(~F.col("_is_current"), now),
            }
        )
        .select(*[keys.unpack_digest(c).alias(c) if c in digests else F.col(c) for c in columns])
    )


def scd2_merge(
    target: DataFrame, source: DataFrame, now: Column, key: str = "hash_caso", mode: str = "versions",
    **options,
) -> DataFrame:
    """New full history after a delivery: closed rows as they are, plus :func:`scd2_changes`."""
    closed = target.filter(~F.col(CURRENT))
    known = closed.select(key) if mode == "close_only" else None
    changes = scd2_changes(
        target.filter(F.col(CURRENT)), source, now, key, mode=mode, known=known, **options
    )
    return closed.unionByName(changes, allowMissingColumns=True)


def unmerged_runs(
    bronze: DataFrame, merged_until: Column, stamp: str = "dh_ingestao_bronze"
) -> DataFrame:
    """Rows ingested after the last merged timestamp: no run is skipped when several are waiting."""
    return bronze.filter(F.col(stamp) > merged_until)
