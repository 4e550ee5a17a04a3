"""Stored daily series, brought up to date by a delivery's changes alone.

``<path>/mes=<yyyy-MM>/`` holds a month's daily sums, the number of rows behind
each day and the number of the delivery the month is at. A delivery adds what
it opened and takes away what it closed, so only its own rows and the months
they fall in are read, and only those months are written (dynamic partition
overwrite). A month that is already at the delivery's number stays as it is,
so a repeated run after a failure counts nothing twice.

Sums and counts of rows are additive; rates and means are taken on reading.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.operators import metrics, versioning
from caselake.sources import storage

MONTH, ROWS, NUMBER = "mes", "linhas", "numero_entrega"


def signed_changes(changes: DataFrame) -> DataFrame:
    """What a delivery adds (1: opened and current) and takes away (-1: was current until now).

    A version that a delivery opens and closes at once was never current.
    """
    closed = F.col(versioning.START) < F.col(versioning.END)
    sign = F.when(F.col(versioning.CURRENT), 1).when(closed, -1)
    return changes.withColumn("_sign", sign).filter("_sign IS NOT NULL")


def _schema(sums: Mapping[str, Column | str]) -> str:
    return ", ".join([f"{metrics.DAY} date", *[f"`{s}` long" for s in sums], f"{ROWS} long", f"{NUMBER} long", f"{MONTH} string"])


def _stored(spark: SparkSession, path: str, sums: Mapping[str, Column | str]) -> DataFrame | None:
    if not any(c.startswith(f"{MONTH}=") for c in storage.Folder(spark, path).children()):
        return None
    return spark.read.schema(_schema(sums)).parquet(path)


def apply_delivery(changes: DataFrame, path: str, number: int, day: str, sums: Mapping[str, Column | str]) -> None:
    """Adds one delivery's changes to the series; deliveries come in the order of their numbers.

    ``sums`` maps columns of the series to integer columns or expressions of the rows.
    """
    spark, names = changes.sparkSession, [*sums, ROWS]
    values = {n: F.expr(c) if isinstance(c, str) else c for n, c in sums.items()} | {ROWS: F.lit(1)}
    signed = signed_changes(changes).filter(F.col(day).isNotNull())
    delta = signed.groupBy(F.col(day).cast("date").alias(metrics.DAY)).agg(
        *[F.sum(F.col("_sign") * v).cast("long").alias(n) for n, v in values.items()])
    delta = delta.withColumn(MONTH, F.date_format(metrics.DAY, "yyyy-MM"))
    kept = storage.fresh_dir(spark, "series-delta")  # one row per changed day
    delta.write.parquet(kept)
    delta = spark.read.schema(delta.schema).parquet(kept)

    stored = _stored(spark, path, sums)
    total = delta.withColumn("_at", F.lit(number).cast("long"))
    if stored is not None:
        touched = delta.select(MONTH).distinct()
        before = stored.join(F.broadcast(touched), MONTH, "left_semi")  # at most one row per calendar month
        done = before.groupBy(MONTH).agg(F.max(NUMBER).alias("_at")).filter(F.col("_at") >= number).select(MONTH)
        total = delta.join(done, MONTH, "left_anti").withColumn("_at", F.lit(number).cast("long")).unionByName(
            before.join(done, MONTH, "left_anti").withColumnRenamed(NUMBER, "_at"))
    merged = total.groupBy(MONTH, metrics.DAY).agg(*[F.sum(n).alias(n) for n in names])
    merged.withColumn(NUMBER, F.lit(number).cast("long")).select(metrics.DAY, *names, NUMBER, MONTH).repartition(MONTH).write.option(
        "partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(MONTH).parquet(path)
    storage.Folder(spark, kept).delete()


def read_days(spark: SparkSession, path: str, sums: Mapping[str, Column | str]) -> DataFrame:
    """Daily totals; days whose rows are all gone are left out."""
    return _stored(spark, path, sums).filter(F.col(ROWS) > 0).select(metrics.DAY, *sums)


def read_months(spark: SparkSession, path: str, sums: Mapping[str, Column | str]) -> DataFrame:
    """Monthly totals of the same series."""
    rows = _stored(spark, path, sums).filter(F.col(ROWS) > 0)
    return rows.groupBy(F.col(MONTH).alias(metrics.MONTH)).agg(*[F.sum(s).alias(s) for s in sums])
