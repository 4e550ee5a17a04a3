"""Deduplication and run selection.

``row_number() = 1`` is planned by Spark as a group limit before *and* after
the shuffle, so a key that holds a large share of all rows sends one row per
map task over the network instead of its whole group.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caselake.functions import as_col


def keep_first(df: DataFrame, keys: Iterable[Column | str], order: Iterable[Column | str]) -> DataFrame:
    """One row per key: the first in the given order.

    The order should be total (end it with a row fingerprint) so that reruns
    keep the same row.
    """
    window = Window.partitionBy(*[as_col(k) for k in keys]).orderBy(*[as_col(o) for o in order])
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def keep_latest(df: DataFrame, keys: Iterable[Column | str], newest: Column | str,
                ties: Iterable[Column | str] = ()) -> DataFrame:
    """One row per key: the one with the newest order value."""
    return keep_first(df, keys, [as_col(newest).desc_nulls_last(), *ties])


def distinct_projection(df: DataFrame, columns: Iterable[Column | str]) -> DataFrame:
    return df.select(*columns).distinct()


def latest_run(
    df: DataFrame, run: str = "run_id", stamp: str = "dh_ingestao_bronze", runs: DataFrame | None = None,
) -> DataFrame:
    """Rows of the run that holds the newest timestamp.

    The run id is a one-row scalar subquery; it reaches the scan as a pushed
    filter. ``runs`` (run, stamp) finds it without reading ``df``.
    """
    newest = (df if runs is None else runs).agg(F.max_by(F.col(run), F.struct(stamp, run)).alias("run"))
    return df.filter(F.col(run) == newest.scalar())


def latest_complete_run(
    log: DataFrame,
    dimension: str = "dimensao_dmbok",
    run: str = "run_id",
    stamp: str = "dh_execucao",
    min_dimensions: int | None = 5,
    runs: DataFrame | None = None,
) -> DataFrame:
    """Rows of the newest run that covers enough dimensions.

    Runs below ``min_dimensions`` are used only when no run reaches it; with
    ``None`` the newest among the runs of widest coverage is taken. Coverage is
    a partial aggregate per run; the best run is a one-row scalar subquery, so
    rows of the log are never sorted or gathered by run. ``runs`` (run, dimension,
    stamp) finds it without reading the log, of which one run is read then.
    """
    covered = F.count_distinct(dimension)
    coverage = covered if min_dimensions is None else (covered >= min_dimensions).cast("int")
    known = (log if runs is None else runs).groupBy(F.col(run).alias("_run"))
    best = known.agg(coverage.alias("_coverage"), F.max(stamp).alias("_last")).agg(F.max_by("_run", F.struct("_coverage", "_last", "_run")).alias("_run"))
    return log.filter(F.col(run).eqNullSafe(best.scalar()))
