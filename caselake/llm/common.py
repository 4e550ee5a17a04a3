"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import fields

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.sources.storage import fresh_dir

#: Character class of everything that separates words: space and U+0009 to U+000D.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, *folders: str) -> DataFrame:
    """The rows of ``df`` written once to the shared folder, in subfolders by ``folders``, and read back.

    Cuts the lineage: whatever is derived from the result reads files that all
    executors reach, so a lost executor costs no recomputation of ``df``.
    """
    spark = df.sparkSession
    folder = fresh_dir(spark, name)
    (df.write.partitionBy(*folders) if folders else df.write).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def packed(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """All columns of ``docs`` as one struct ``_row`` beside the named ones.

    Operators that return whole rows work on this, so their own columns never
    clash with columns of the caller.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    return docs.select(whole, *columns)


def text_reader(docs: DataFrame) -> Callable[[pa.RecordBatch], pa.Array]:
    """Finds the texts in Arrow batches of ``docs``: its column ``text``, or the one inside ``_row``.

    Whole rows go through Python once this way, not a second time for their texts.
    """
    names = docs.columns
    if "text" in names:
        at = names.index("text")
        return lambda batch: batch.column(at)
    at, inside = names.index("_row"), docs.schema["_row"].dataType.names.index("text")
    return lambda batch: batch.column(at).field(inside)


def small_batches(spark: SparkSession, size: int = 8 << 20) -> None:
    """Bounds the bytes of text that Spark hands to Python at once, for sessions that run operators on whole rows."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(setting).rstrip("b")) <= size:
        spark.conf.set(setting, size)


def plain(value) -> tuple:
    """The fields of a dataclass as a tuple, which workers unpickle without this package."""
    return tuple(getattr(value, f.name) for f in fields(value))


def text_or_empty(column: str | Column = "text") -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def split_words(text: Column) -> Column:
    """Array of the words of ``text``; empty for a text without one."""
    return F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != F.lit(""))


def record_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096, chars: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of at most ``size`` rows and about ``chars`` characters."""
    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= size or weight >= chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def dict_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of Arrow batches one by one."""
    for batch in batches:
        yield from batch.to_pylist()
