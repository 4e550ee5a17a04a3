"""Table reads and writes on plain Parquet.

A full rebuild goes to a new folder and the catalogue entry is pointed at it
afterwards, so a rebuild may read the table it replaces and a failed job leaves
the old contents in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from caselake.functions import keys as hashed
from caselake.sources import storage


def read_table(spark: SparkSession, source: str, merge_schema: bool = False) -> DataFrame:
    """Catalogue table by name, or a Parquet folder by path.

    ``merge_schema`` unites columns added over time; it reads the footers of all files.
    """
    if "/" in source:
        return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(source)
    return spark.table(source)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def append(df: DataFrame, path: str, block: str, partition_by: Sequence[str] = ()) -> None:
    """Add a block of rows to a log; a block of the same name (a repeated run) is replaced.

    Every block owns a folder, so a retry never doubles rows.
    """
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path.rstrip('/')}/block={block}")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All blocks of a log, columns added over time merged."""
    return read_table(spark, path, merge_schema=True).drop("block")


def write_checked(df: DataFrame, path: str, checks: Mapping[str, Column] | None = None) -> int:
    """Write to a folder beside ``path``, verify in the same pass, then publish; returns the number of rows.

    Rows and violations are counted while they are written. No rows, or a row
    for which a named check does not hold, raises: ``path`` keeps what it held
    and the rejected rows are deleted.
    """
    checks = checks or {}
    violated = [F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"bad_{i}")
                for i, ok in enumerate(checks.values())]
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *violated)
    parent, _, leaf = path.rstrip("/").rpartition("/")
    aside = f"{parent}/.{leaf}-{uuid.uuid4().hex}"  # readers skip names that begin with a dot
    storage.save(counted, aside)
    found = seen.get
    failed = [f"{name}: {found[f'bad_{i}']} rows" for i, name in enumerate(checks) if found[f"bad_{i}"]]
    if found["rows"] == 0:
        failed.append("no rows")
    folder = storage.Folder(df.sparkSession, aside)
    if failed:
        folder.delete()
        raise ValueError(f"{path}: " + "; ".join(failed))
    folder.replace(path)
    return found["rows"]


def overwrite(df: DataFrame, name: str, root: str) -> str:
    """Rebuild table ``name``; returns the folder that now holds it."""
    spark = df.sparkSession
    location = f"{root.rstrip('/')}/{name}/{uuid.uuid4().hex}"
    storage.save(df, location)
    point_at(spark, name, location)
    return location


def point_at(spark: SparkSession, name: str, location: str, **properties: str) -> None:
    """Catalogue entry of a folder, replaced in one call: readers find the old contents or the new ones."""
    given = {"location": location, **properties}
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in given.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({listed}) AS SELECT * FROM parquet.`{location}`")


def entry_properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def location(spark: SparkSession, name: str) -> str:
    """Folder a catalogue entry points at."""
    return entry_properties(spark, name)["location"]


#: Ranges per clustering column of an interleaved key, as a power of two, and rows sampled for their bounds.
RANGE_BITS, BOUND_SAMPLE = 5, 4096


def interleaved_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """One number whose bits are the interleaved bits of each column's range rank.

    Bounds are quantiles of the rows with the least row hashes, a bounded sample
    that reruns find again. A rank counts the bounds below a value (NULL: 0), so
    the key works for every type that sorts and neighbours in all columns get
    neighbouring keys.
    """
    row = F.xxhash64(*[F.col(c) for c in df.columns])
    with storage.freed_shuffles(df.sparkSession):
        sample = df.select(*columns, row.alias("_row")).orderBy("_row").limit(BOUND_SAMPLE).collect()
    key, n = F.lit(0).cast("long"), len(columns)
    for j, column in enumerate(columns):
        values = sorted(r[column] for r in sample if r[column] is not None)
        bounds = sorted({values[i * len(values) >> RANGE_BITS] for i in range(1, 1 << RANGE_BITS)}) if values else []
        rank = F.lit(0)
        for bound in bounds:
            rank = rank + F.coalesce((F.col(column) >= F.lit(bound)).cast("int"), F.lit(0))
        for bit in range(RANGE_BITS):
            on = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("long")
            key = key.bitwiseOR(F.shiftleft(on, bit * n + n - 1 - j))
    return key


def cluster(df: DataFrame, columns: Sequence[str], files: int | None = None, interleave: bool = False) -> DataFrame:
    """Range-cluster rows for file and row-group skipping, in ``files`` evenly sized parts.

    Without a number the adaptive plan chooses it by size. A row hash follows
    the clustering columns in the range key, so one value that holds most rows
    is cut over several files instead of filling one. In plain order a filter on
    the first column skips files; ``interleave`` lets filters on any of them do so.
    Digests beside the clustering columns are packed for the shuffle.
    """
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    digests = [c for c in hashed.digest_columns(df) if c not in columns]
    order = [interleaved_key(df, columns)] if interleave and len(columns) > 1 else [F.col(c) for c in columns]
    keys = [*order, spread]
    packed = hashed.pack_digests(df, digests)
    ranged = packed.repartitionByRange(files, *keys) if files else packed.repartitionByRange(*keys)
    return hashed.unpack_digests(ranged, digests).sortWithinPartitions(*columns)


def compact_and_cluster(
    df: DataFrame, path: str, columns: Sequence[str] = (), files: int | None = None, interleave: bool = False,
) -> None:
    """Rewrite to few files in a new folder, clustered when columns are given.

    Without a number of files the adaptive plan merges small partitions up to its advisory size.
    """
    if columns:
        compact = cluster(df, columns, files, interleave)
    else:
        compact = df.repartition(files) if files else df.hint("rebalance")
    compact.write.parquet(path)
