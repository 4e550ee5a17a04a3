"""Joins of many rows per key with one summary row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_summary(rows: DataFrame, summary: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join rows with an aggregate over the same key, so that a hot key can be split.

    The adaptive skew join splits a partition only when both join sides come
    straight from a shuffle. An aggregate is already partitioned by its key,
    Spark would reuse that and the rows of a hot key would stay in one task.
    Joining on the length of the key as well makes Spark shuffle the narrow summary
    once more and leaves the wide side open to splitting; lengths hardly add to the shuffle.
    """
    length = F.octet_length(F.col(key).cast("string"))
    return (
        rows.withColumn("_key_length", length)
        .join(summary.withColumn("_key_length", length), [key, "_key_length"], how)
        .drop("_key_length")
    )
