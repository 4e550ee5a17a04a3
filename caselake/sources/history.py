"""Versioned case history on Parquet, dealt by key and compacted in levels.

``<root>/<name>/parte=<id>/balde=<bucket>/registro_mais_atual=<bool>/`` holds a
part: what one delivery changed (the rows it closed and the versions it opened),
or several such parts merged. A stored current row that a later delivery closed
is recognised by its closed copy (same key, start and content).

- **Buckets.** A part's rows are dealt by a hash of the case key into a power of
  two of buckets of about ``bucket_rows`` rows. A merge opens only the buckets
  that can hold a delivered key, so its cost follows the delivery, not the table.
- **Levels.** The newest ``FANOUT`` parts are merged into one as long as the
  oldest of them is not far larger than the rest, so n deliveries leave about
  log n parts and each row is rewritten about log n times. Current rows that have
  a closed copy in the same part are dropped on the way.
- **Manifest.** One row per delivery: number, id, rows, newest stamp, part. It is
  written anew by each merge; consumers that need a delivery's newest stamp read
  this small file and no case.
- **Room.** Digests are shuffled packed, folders are compressed with zstd, and each
  step frees its shuffles when its rows are written: the rows of a delivery are
  computed into the shared folder before they are dealt to buckets.
- **Publication.** The catalogue entry names the manifest and is replaced in one
  call after everything is written. Folders the manifest does not name are left
  over from interrupted or compacted runs; they are not read, and :func:`vacuum`
  deletes them.

Deliveries are numbered in the order they are merged; ids are compared with
their numbers as numbers, so ``d10`` follows ``d9``.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake.functions import keys
from caselake.operators import versioning
from caselake.sources import storage, tables

NUMBER, BUCKET, PART = "numero_entrega", "balde", "parte"
STAMP = "dh_ingestao_bronze"
#: Rows of a bucket, about; a part of n rows has n / BUCKET_ROWS buckets.
BUCKET_ROWS = 1 << 20
#: Parts that are merged together, and how much larger than the rest the oldest may be.
FANOUT = 4
MANIFEST = ("number long, delivery string, rows long, newest timestamp, part string, part_rows long, "
            "part_buckets int, columns string")


@dataclass(frozen=True)
class Part:
    id: str
    rows: int
    buckets: int
    deliveries: tuple[int, ...]


@dataclass(frozen=True)
class State:
    """What a history's entry and manifest say."""

    folder: str
    key: str
    fingerprint: str
    bucket_rows: int
    merged: tuple  # manifest rows, oldest first

    @property
    def parts(self) -> list[Part]:
        """Parts, oldest first; a delivery that changed nothing has none."""
        numbers: dict[tuple, list[int]] = {}
        for r in self.merged:
            if r.part is not None:
                numbers.setdefault((r.part, r.part_rows, r.part_buckets), []).append(r.number)
        return [Part(*about, tuple(n)) for about, n in numbers.items()]

    @property
    def columns(self) -> str:
        return self.merged[-1].columns


def deliveries(spark: SparkSession, name: str) -> DataFrame:
    """The manifest: a row for every merged delivery."""
    return spark.read.schema(MANIFEST).parquet(tables.entry_properties(spark, name)["manifest"])


def _state(spark: SparkSession, name: str) -> State | None:
    if not tables.table_exists(spark, name):
        return None
    entry = tables.entry_properties(spark, name)
    merged = tuple(deliveries(spark, name).orderBy("number").collect())  # one short row per delivery
    return State(entry["folder"], entry["key"], entry["fingerprint"], int(entry["bucket_rows"]), merged)


def merged_deliveries(spark: SparkSession, name: str) -> list[str]:
    """Ids merged so far, oldest first; none for an unknown history."""
    state = _state(spark, name)
    return [r.delivery for r in state.merged] if state else []


def newest_stamp(spark: SparkSession, name: str) -> Column:
    """Newest stamp of everything delivered, a one-row subquery over the manifest."""
    return deliveries(spark, name).agg(F.max("newest").alias("t")).scalar()


def _order(delivery: str) -> list:
    """Sort key of an id: its numbers compare as numbers."""
    return [int(p) if i % 2 else p for i, p in enumerate(re.split(r"(\d+)", delivery))]


def _hash(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _buckets(rows: int, bucket_rows: int) -> int:
    """A power of two, so that a key's bucket in a small part follows from the one in a large part."""
    return 1 << max(0, -(-rows // bucket_rows) - 1).bit_length()


def _columns(df: DataFrame) -> str:
    """Stored columns as a schema text: all columns of all deliveries so far."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields
                     if f.name not in (versioning.CURRENT, NUMBER))


def _read(spark: SparkSession, state: State, parts: Iterable[Part], touched: set[int] | None = None, of: int = 1) -> DataFrame:
    """Rows of parts; ``touched`` names the buckets, out of ``of``, that can hold a wanted key."""
    folders = []
    for part in parts:
        folder = f"{state.folder}/{PART}={part.id}"
        if touched is None or part.buckets == 1:
            folders.append(folder)
        else:
            wanted = {f"{BUCKET}={b % part.buckets}" for b in touched}
            held = storage.Folder(spark, folder).children()
            folders.extend(f"{folder}/{b}" for b in held if b in wanted)
    schema = T._parse_datatype_string(state.columns).add(NUMBER, "long")
    if not folders:
        return spark.createDataFrame([], schema.add(versioning.CURRENT, "boolean"))
    schema = schema.add(PART, "string").add(BUCKET, T.IntegerType()).add(versioning.CURRENT, "boolean")
    rows = spark.read.schema(schema).option("basePath", state.folder).parquet(*folders)
    return rows.drop(PART, BUCKET)


def _open(rows: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """Current rows that no later delivery has closed; only key, start and content of closed rows are compared."""
    digests = keys.digest_columns(rows, key, fingerprint)
    rows = keys.pack_digests(rows, digests)
    closed = rows.filter(~F.col(versioning.CURRENT)).select(key, versioning.START, fingerprint, NUMBER).alias("c")
    same = [F.col(f"o.{c}").eqNullSafe(F.col(f"c.{c}")) for c in (key, versioning.START, fingerprint)]
    later = F.col(f"c.{NUMBER}") > F.col(f"o.{NUMBER}")
    current = versioning.current_view(rows).alias("o").join(closed, reduce(lambda a, b: a & b, same) & later, "left_anti")
    return keys.unpack_digests(current, digests)


def _settled(rows: DataFrame, state: State, parts: list[Part]) -> DataFrame:
    """Closed rows, and current rows that are still open. A single part is settled as it was written."""
    if len(parts) < 2:
        return rows
    closed = rows.filter(~F.col(versioning.CURRENT))
    return closed.unionByName(_open(rows, state.key, state.fingerprint))


def _write_part(df: DataFrame, folder: str, key: str, buckets: int, spent: Iterable[str] = ()) -> Part | None:
    """Writes a part and counts its rows by the footers; None if there are none.

    The rebalance splits a bucket that a hot key fills over several files; the
    rows are stored before it. ``spent`` names folders that go when the rows
    have been computed from them.
    """
    spark, part, spent = df.sparkSession, uuid.uuid4().hex, list(spent)
    dealt = df.withColumn(BUCKET, _hash(key, buckets))
    if buckets > 1:
        computed, digests = storage.fresh_dir(spark, "computed"), keys.digest_columns(df, key)
        storage.save(dealt, computed)
        while spent:
            storage.Folder(spark, spent.pop()).delete()
        spent.append(computed)
        packed = keys.pack_digests(spark.read.schema(dealt.schema).parquet(computed), digests)
        ordered = packed.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, versioning.CURRENT, key)
        dealt = keys.unpack_digests(ordered, digests)
    path = f"{folder}/{PART}={part}"
    storage.save(dealt, path, (BUCKET, versioning.CURRENT))
    for used in spent:
        storage.Folder(spark, used).delete()
    rows = spark.read.schema(f"{NUMBER} long").parquet(path).count()
    if not rows:
        storage.Folder(spark, path).delete()
        return None
    return Part(part, rows, buckets, ())


def _changes(
    spark: SparkSession, state: State, source: DataFrame, now: Column, mode: str, work: str, **options,
) -> DataFrame:
    """What a delivery closes and opens, from the stored rows of delivered keys alone."""
    parts, key = state.parts, state.key
    most = max((p.buckets for p in parts), default=1)
    touched = {r[0] for r in source.select(_hash(key, most)).distinct().collect()}  # numbers below the bucket count
    stored, delivered = _read(spark, state, parts, touched, most), source.select(key)
    digests = keys.digest_columns(stored, key, state.fingerprint) if keys.digest_columns(delivered, key) else []
    packed = keys.pack_digests(stored, digests).join(
        keys.pack_digests(delivered, [c for c in digests if c == key]), key, "left_semi")
    stored = keys.unpack_digests(packed, digests)
    storage.save(stored, work, (versioning.CURRENT,))
    stored = spark.read.schema(stored.schema).parquet(work)
    closed = stored.filter(~F.col(versioning.CURRENT))
    current = _open(stored, key, state.fingerprint) if len(parts) > 1 else versioning.current_view(stored)
    return versioning.scd2_changes(
        current.drop(NUMBER), source, now, key, state.fingerprint, mode=mode,
        known=closed if mode == "close_only" else None, only_changes=True, **options)


def _compacted(spark: SparkSession, state: State) -> list[Part]:
    """Parts after merging the newest ones as long as the oldest of them is not far larger than the rest."""
    parts = state.parts
    while len(parts) >= FANOUT and parts[-FANOUT].rows <= FANOUT * sum(p.rows for p in parts[1 - FANOUT:]):
        last = parts[-FANOUT:]
        rows = _settled(_read(spark, state, last), state, last)
        buckets = _buckets(sum(p.rows for p in last), state.bucket_rows)
        merged = _write_part(rows, state.folder, state.key, buckets)
        numbers = tuple(n for p in last for n in p.deliveries)
        parts = [*parts[:-FANOUT], Part(merged.id, merged.rows, merged.buckets, numbers)]
    return parts


def merge_delivery(
    spark: SparkSession, name: str, root: str, delivery: str, source: DataFrame, now: Column,
    mode: str = "versions", key: str = "hash_caso", fingerprint: str = "hash_registros",
    stamp: str = STAMP, bucket_rows: int = BUCKET_ROWS, **options,
) -> None:
    """Apply one delivery. An id that has been merged changes nothing; an id older than the newest is refused.

    The delivery is computed once, into the shared folder, and merged from
    there. ``key``, ``fingerprint`` and ``bucket_rows`` are those of the first delivery.
    """
    with storage.freed_shuffles(spark):
        state = _state(spark, name)
        known = [r.delivery for r in state.merged] if state else []
        if delivery in known:
            return
        if known and _order(delivery) < _order(known[-1]):
            raise ValueError(f"delivery {delivery} is older than the merged {known[-1]}")
        folder = state.folder if state else f"{root.rstrip('/')}/{name}"
        state = state or State(folder, key, fingerprint, bucket_rows, ())
        number = len(known) + 1

        prepared, work = storage.fresh_dir(spark, "delivery"), storage.fresh_dir(spark, "touched")
        storage.save(source, prepared)
        source = spark.read.schema(source.schema).parquet(prepared)
        newest = F.max(stamp).cast("timestamp") if stamp in source.columns else F.lit(None).cast("timestamp")
        n_rows, newest = source.agg(F.count(F.lit(1)), newest).first()
        if state.merged:
            changes = _changes(spark, state, source, now, mode, work, **options)
        else:
            changes = versioning.scd2_first_load(source, now, state.key, state.fingerprint, **options)
        columns = _columns(changes)
        buckets = _buckets(n_rows, state.bucket_rows)
        numbered = changes.withColumn(NUMBER, F.lit(number).cast("long"))
        part = _write_part(numbered, folder, state.key, buckets, (prepared, work))

        row = T.Row(*[f.name for f in T._parse_datatype_string(MANIFEST)])(
            number, delivery, part.rows if part else 0, newest, part and part.id,
            part and part.rows, part and part.buckets, columns)
        state = State(folder, state.key, state.fingerprint, state.bucket_rows, (*state.merged, row))
        place = {n: p for p in _compacted(spark, state) for n in p.deliveries}
        _publish(spark, name, state, place)


def _publish(spark: SparkSession, name: str, state: State, place: dict[int, Part]) -> None:
    """Writes the manifest and replaces the catalogue entry in one call."""
    rows = [(r.number, r.delivery, r.rows, r.newest, *((p.id, p.rows, p.buckets) if (p := place.get(r.number)) else (None,) * 3), r.columns)
            for r in state.merged]
    manifest = f"{state.folder}/manifest/{uuid.uuid4().hex}"
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(manifest)
    entry = {"folder": state.folder, "manifest": manifest, "key": state.key, "fingerprint": state.fingerprint,
             "bucket_rows": str(state.bucket_rows)}
    properties = ", ".join(f"'{k}' = '{v}'" for k, v in entry.items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({properties}) AS SELECT '{manifest}' AS manifest")


def last_changes(spark: SparkSession, name: str) -> tuple[int, DataFrame]:
    """Number of the newest delivery, and the rows it closed and opened."""
    state = _state(spark, name)
    last = state.merged[-1]
    parts = [p for p in state.parts if last.number in p.deliveries]
    return last.number, _read(spark, state, parts).filter(F.col(NUMBER) == last.number).drop(NUMBER)


def vacuum(spark: SparkSession, name: str) -> list[str]:
    """Deletes the folders that the manifest does not name; call it when no reader uses an earlier state."""
    state = _state(spark, name)
    named = {f"{PART}={p.id}" for p in state.parts}
    manifest = tables.entry_properties(spark, name)["manifest"].rpartition("/")[2]
    stale = [c for c in storage.Folder(spark, state.folder).children() if c.startswith(f"{PART}=") and c not in named]
    stale += [f"manifest/{c}" for c in storage.Folder(spark, f"{state.folder}/manifest").children() if c != manifest]
    for child in stale:
        storage.Folder(spark, f"{state.folder}/{child}").delete()
    return stale


def read_history(spark: SparkSession, name: str) -> DataFrame:
    """All versions: closed rows, and current rows that no delivery has closed since."""
    state = _state(spark, name)
    parts = state.parts
    return _settled(_read(spark, state, parts), state, parts).drop(NUMBER)


def read_current(spark: SparkSession, name: str, settle: bool = False) -> DataFrame:
    """Current rows. With ``settle`` they are found once, into the shared folder, for callers that read them often.

    The rows of a single part are settled as they stand.
    """
    state = _state(spark, name)
    parts = state.parts
    rows = _read(spark, state, parts)
    if len(parts) < 2:
        return versioning.current_view(rows).drop(NUMBER)
    current = _open(rows, state.key, state.fingerprint).drop(NUMBER)
    if not settle:
        return current
    return storage.kept(current, "current")
