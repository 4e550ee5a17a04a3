"""Removal of repeated passages with a logarithmic family of suffix arrays.

A passage is repeated where a string of ``LENGTH`` bytes also starts elsewhere.
Suffix arrays here are sparse: of every run of ``SPAN`` starting places only the
one whose next ``GRAM`` bytes hash least is an anchor. The choice depends on the
bytes of the string alone, so equal strings have their anchors at equal places,
and each string of ``LENGTH`` bytes belongs to exactly one anchor.

An entry stands for an anchor and the strings that belong to it. Its key r is
the hash of the bytes all of them share (the suffix from the anchor, as far as
every string reaches), u the hash of the bytes any of them covers. Arrays are
sorted by (r, u): any order that keeps equal suffixes together serves a match
search, and 16 fixed bytes per entry take the place of suffixes in the shuffle.

- A batch of documents gets an array: each task sorts its entries, finds the
  matches inside itself and keeps one entry per (r, u).
- Arrays of one size are merge-scanned into one of the next size
  (:class:`SuffixLevels`), which finds the matches between them, so an entry is
  rewritten once per doubling of the collection.
- Entries with equal (r, u) are repeated with all their strings. Where u differs
  under one r, only some strings may match: their anchors are looked up in the
  texts, split into stretches of ``STRETCH`` places, compared again by shared and
  covered bytes, and what is left is compared string by string.

Every comparison is a grouping with partial sums; no group is gathered. A key
that a third of all rows carry reaches the shuffle as one entry per task, and
the range partitioning by (r, u) splits what remains.

Positions are judged on the input. Keys are compared by 128 bits and stretches
by 128 bits and their edge bytes, so a false match is not to be expected.

Defined results: null texts are empty; texts shorter than ``LENGTH`` lose
nothing and match nothing; repeated rows are copies of each other; rows with
one id and equal texts get equal results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.common import table, text_or_empty
from caselake.llm.textnp import RollingHash, mix, slices
from caselake.sources.storage import fresh_dir

LENGTH = 400
SPAN = 256
GRAM = 24
STRETCH = 32
#: Bytes of one text that are worked on together; longer texts are cut with an overlap.
CHUNK = 1 << 21
U64 = np.uint64
_EDGE = STRETCH - 1
#: kind 0: an entry of the array; 1: a place known to be repeated, no longer part of the array.
LEVEL = "r long, u long, doc_id long, mark long, at long, kind int, many boolean, mixed boolean"


def _chunks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, int]]:
    """(first row, base, bytes, offsets, starting places of the first text to use) of bounded pieces."""
    if len(offsets) > 2 or len(data) <= CHUNK:
        yield 0, 0, data, offsets, len(data)
        return
    for base in range(0, len(data), CHUNK):
        part = data[base:base + CHUNK + LENGTH + SPAN + GRAM]
        yield 0, base, part, np.array([0, len(part)]), CHUNK


def anchors(data: np.ndarray, offsets: np.ndarray, most: int) -> tuple[np.ndarray, ...]:
    """Text, anchor, first and last start of the strings that belong to it, for all anchors of the texts."""
    n = len(data)
    room = n - SPAN - GRAM + 2
    empty = (np.zeros(0, np.int64),) * 4
    if n < LENGTH or room <= 0:
        return empty
    at = np.arange(n - GRAM + 1)
    key = (RollingHash(data)(at, at + GRAM) >> U64(24) << U64(24)) | at.astype(U64)
    width = 1
    while width < SPAN:  # SPAN is a power of two
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    start = np.arange(min(len(key), n - LENGTH + 1))
    start = start[(start + LENGTH <= offsets[1:][text[start]]) & (start - offsets[:-1][text[start]] < most)]
    if not len(start):
        return empty
    anchor = (key[start] & U64((1 << 24) - 1)).astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return text[start[first]], anchor[first], start[first], start[last]


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, mark -> the sorted array of the task and the repeated places it finds by itself."""
    parts: list[tuple[np.ndarray, ...]] = []
    held = 0
    for batch in batches:
        ids = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False) if batch.column(0).null_count else batch.column(0).to_numpy()
        marks = batch.column(2).to_numpy()
        for row, _, data, offsets in slices(batch.column(1)):
            for _, base, part, bounds, most in _chunks(data, offsets):
                text, anchor, first, last = anchors(part, bounds, most)
                if not len(text):
                    continue
                roll = RollingHash(part)
                r = roll(anchor, anchor + LENGTH - SPAN + 1)
                shape = ((anchor - first) * SPAN + (last - first)).astype(U64)
                u = mix(RollingHash(part, 1)(first, last + LENGTH) ^ mix(shape))
                place = (first - bounds[text] + base).astype(np.int64)
                at = place * 65536 + (anchor - first) * 256 + (last - first)
                parts.append((r, u, ids[row + text], marks[row + text], at))
                held += len(r)
        if held >= 2_000_000:
            yield from _sorted_run(parts)
            parts, held = [], 0
    if parts:
        yield from _sorted_run(parts)


def _sorted_run(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    r, u, ids, marks, at = (np.concatenate(c) for c in zip(*parts))
    order = np.lexsort((u, r))
    r, u, ids, marks, at = r[order].view(np.int64), u[order].view(np.int64), ids[order], marks[order], at[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (u[1:] != u[:-1])
    many = np.repeat(np.diff(np.append(np.flatnonzero(new), len(r))) > 1, np.diff(np.append(np.flatnonzero(new), len(r))))
    kind = np.where(new, 0, 1).astype(np.int32)
    names = ["r", "u", "doc_id", "mark", "at", "kind", "many", "mixed"]
    for a in range(0, len(r), 1 << 16):
        s = slice(a, a + (1 << 16))
        yield pa.RecordBatch.from_arrays([pa.array(x[s]) for x in (r, u, ids, marks, at, kind, many, np.zeros(len(r), bool))], names)


def _merge_scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over entries sorted by (r, u), holding one batch: equal entries become one, the others places.

    ``many``: (r, u) occurs more than once; ``mixed``: r also occurs with another
    u. The first and last keys of a partition count as mixed, as the neighbour
    partition may hold their r; that only adds comparisons later.
    """
    held: pa.RecordBatch | None = None
    previous: tuple | None = None  # key and number of the last row given out

    def settle(rows: pa.RecordBatch, following: tuple | None) -> pa.RecordBatch:
        nonlocal previous
        r, u = rows.column(0).to_numpy(), rows.column(1).to_numpy()
        n = len(r)
        pr = np.concatenate([[previous[0] if previous else 0], r[:-1]])
        pu = np.concatenate([[previous[1] if previous else 0], u[:-1]])
        nr = np.concatenate([r[1:], [following[0] if following else 0]])
        nu = np.concatenate([u[1:], [following[1] if following else 0]])
        with_previous, with_next = np.ones(n, bool), np.ones(n, bool)
        with_previous[0], with_next[-1] = previous is not None, following is not None
        same_before = with_previous & (pr == r) & (pu == u)
        same_after = with_next & (nr == r) & (nu == u)
        many = rows.column(6).to_numpy(zero_copy_only=False) | same_before | same_after
        mixed = ~with_previous | ~with_next | (pr == r) & (pu != u) | (nr == r) & (nu != u)
        if previous and (r[0], u[0]) == previous[:2]:
            mixed[0] |= previous[2]
        # The last row of a run stays in the array; whether its r began with another u is handed down the run.
        new = ~same_before
        run = np.cumsum(new)
        seen = np.zeros(run[-1] + 1, bool)
        np.logical_or.at(seen, run, mixed)
        mixed = seen[run]
        kind = np.where(same_after, 1, 0).astype(np.int32)
        previous = (r[-1], u[-1], bool(mixed[-1]))
        return pa.RecordBatch.from_arrays([*rows.columns[:5], pa.array(kind), pa.array(many), pa.array(mixed)], rows.schema.names)

    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            yield settle(held, (batch.column(0)[0].as_py(), batch.column(1)[0].as_py()))
        held = batch
    if held is not None:
        yield settle(held, None)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, mark; the mark tells rows apart that share an id."""
    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.pmod(F.xxhash64(text, F.col("doc_id")), F.lit(1 << 31)).alias("mark"))


class SuffixLevels:
    """A family of arrays whose sizes double; levels are Parquet folders in the shared folder."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.levels, self.made = spark, fresh_dir(spark, "suffix-levels"), [], 0

    def _write(self, rows: DataFrame) -> str:
        self.made += 1
        path = f"{self.folder}/{self.made}"
        rows.write.option("compression", "zstd").parquet(path)
        return path

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema(LEVEL).parquet(path)

    def _drop(self, path: str) -> None:
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def _scan(self, paths: list[str]) -> DataFrame:
        rows = self.spark.read.schema(LEVEL).parquet(*paths)
        entries = rows.filter("kind = 0").repartitionByRange("r", "u").sortWithinPartitions("r", "u")
        return entries.mapInArrow(_merge_scan, LEVEL).unionAll(rows.filter("kind = 1"))

    def add(self, docs: DataFrame) -> None:
        """A batch gets an array; arrays of equal size are merge-scanned into one of the next size."""
        self.levels.append((0, self._write(keyed(docs).mapInArrow(_entries, LEVEL))))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, new), (_, old) = self.levels.pop(), self.levels.pop()
            self.levels.append((size + 1, self._write(self._scan([old, new]))))
            self._drop(old)
            self._drop(new)

    def settled(self) -> DataFrame:
        """All entries and repeated places, merge-scanned across the levels."""
        paths = [p for _, p in self.levels]
        if len(paths) == 1 and self.levels[0][0] > 0:
            return self._read(paths[0])
        return self._read(self._write(self._scan(paths))) if paths else self.spark.createDataFrame([], LEVEL)


def _bits(shift: int, mask: int) -> Column:
    return F.shiftrightunsigned(F.col("at"), shift).bitwiseAND(F.lit(mask).cast("long"))


_STRETCHES = ("doc_id long, mark long, r1 long, r2 long, edges binary, low int, high int, anchor long")


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, mark, text, ats -> one row per anchor and stretch of its starting places.

    Offsets count from a start to its anchor. A stretch of offsets b * STRETCH to
    b * STRETCH + STRETCH - 1 has the bytes that all its strings share (r1, r2)
    and the bytes on both sides of them (edges) that tell the strings apart.
    """
    for batch in batches:
        ids, marks, texts, lists = (batch.column(i) for i in range(4))
        for i in range(batch.num_rows):
            data = np.frombuffer(texts[i].as_py().encode("utf-8", "surrogatepass") if isinstance(texts[i].as_py(), str) else texts[i].as_py(), np.uint8)
            at = np.unique(np.array(lists[i].as_py(), dtype=np.int64))
            first = at >> 16
            offset_high = (at >> 8) & 255  # of the first start
            offset_low = offset_high - (at & 255)
            anchor = first + offset_high
            low_block, high_block = offset_low // STRETCH, offset_high // STRETCH
            n = high_block - low_block + 1
            which = np.repeat(np.arange(len(at)), n)
            block = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low_block[which]
            low = np.maximum(offset_low[which], block * STRETCH)
            high = np.minimum(offset_high[which], block * STRETCH + _EDGE)
            begin = anchor[which] - block * STRETCH
            end = begin - _EDGE + LENGTH
            # Hash only the stretch of the text in use.
            padded = np.concatenate([np.zeros(_EDGE, np.uint8), data, np.zeros(_EDGE, np.uint8)])
            r1, r2 = RollingHash(data)(begin, end), RollingHash(data, 1)(begin, end)
            side = np.arange(_EDGE)
            edges = np.concatenate([padded[begin[:, None] + side], padded[end[:, None] + _EDGE + side]], axis=1)
            m = len(which)
            blob = pa.array([e.tobytes() for e in edges], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(m, ids[i].as_py())), pa.array(np.full(m, marks[i].as_py())), pa.array(r1.view(np.int64)),
                 pa.array(r2.view(np.int64)), blob, pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)),
                 pa.array(anchor[which])],
                ["doc_id", "mark", "r1", "r2", "edges", "low", "high", "anchor"])


def _mixed_places(docs: DataFrame, settled: DataFrame, store) -> DataFrame:
    """Repeated places (doc_id, mark, begin, end) among entries whose r has more than one u."""
    mixed = settled.filter("kind = 0 AND mixed").groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(
        F.collect_list("at").alias("ats"))  # the anchors of one text
    looked_up = keyed(docs).join(mixed, (F.coalesce("doc_id", F.lit(-1)) == F.col("_id")) & (F.col("mark") == F.col("_mark")))
    rows = store(looked_up.select(F.col("_id").alias("doc_id"), "mark", "text", "ats").mapInArrow(_stretches, _STRETCHES)
                 .withColumn("edge", F.xxhash64("edges")))
    key = ["r1", "r2", "edge", "low", "high"]
    shapes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.first("edges").alias("edges"))
    shapes = store(shapes)
    groups = shapes.groupBy("r1", "r2").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").drop("k")
    # Between different shapes of one group: string by string. A string is its offset and the edge bytes it covers.
    strings = shapes.join(groups, ["r1", "r2"]).withColumn("o", F.explode(F.sequence("low", "high")))
    left = F.pmod(F.col("o"), F.lit(STRETCH))  # bytes left of the shared ones
    strings = strings.withColumn("s", F.xxhash64(F.expr(f"substring(edges, {_EDGE} + 1 - pmod(o, {STRETCH}), {_EDGE})"), left, F.lit(1)))
    equal = strings.groupBy("r1", "r2", "o", "s").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
    partial = strings.filter("n = 1").join(equal, ["r1", "r2", "o", "s"]).groupBy(*key).agg(
        F.collect_list("o").alias("offsets"))  # STRETCH numbers at most
    whole = shapes.filter("n > 1").select(*key, F.sequence("low", "high").alias("offsets"))
    found = rows.drop("edges").join(whole.unionByName(partial), key)
    places = found.select("doc_id", "mark", F.explode("offsets").alias("o"), "anchor")
    begin = F.col("anchor") - F.col("o")
    return places.groupBy("doc_id", "mark", "anchor").agg(
        F.sort_array(F.collect_list(begin)).alias("starts")).select("doc_id", "mark", F.explode(_runs("starts")).alias("x")).select(
        "doc_id", "mark", F.col("x.begin").alias("begin"), F.col("x.end").alias("end"))


def _runs(starts: str) -> Column:
    """Intervals covered by strings that begin at the sorted ``starts`` of one anchor: one per unbroken run."""
    begins = F.filter(starts, lambda s, i: (i == 0) | (F.get(starts, i - 1) < s - 1))
    ends = F.filter(starts, lambda s, i: F.coalesce(F.get(starts, i + 1) > s + 1, F.lit(True)))
    return F.transform(begins, lambda b, i: F.struct(b.alias("begin"), (F.get(ends, i) + LENGTH).alias("end")))


def repeated_places(docs: DataFrame, batches: int = 2) -> DataFrame:
    """doc_id (-1 for null), mark, begin, end: bytes covered by strings that also start elsewhere."""
    spark = docs.sparkSession
    levels = SuffixLevels(spark)
    part = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(batches))
    for b in range(batches):
        levels.add(docs.filter(part == b))
    settled = levels.settled()

    def store(df: DataFrame) -> DataFrame:
        path = levels._write(df)
        return spark.read.schema(df.schema).parquet(path)

    whole = settled.filter("kind = 1 OR many").select(
        "doc_id", "mark", _bits(16, (1 << 47) - 1).alias("begin"),
        (_bits(16, (1 << 47) - 1) + _bits(0, 255) + LENGTH).alias("end"))
    return whole.unionByName(_mixed_places(docs, settled, store))


_REMOVED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _remove(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_removed, n_spans, digests, kept = [], [], [], []
            for text, spans in zip(batch.column(1), batch.column(2)):
                raw = text.as_py().encode("utf-8", "surrogatepass")
                pairs = spans.as_py()
                removed = count = 0
                if pairs:
                    pieces, end = [], 0
                    for p in sorted((p["begin"], p["end"]) for p in pairs):
                        if p[0] > end or (p[0] == 0 and not count):
                            pieces.append(raw[end:p[0]])
                            count += 1
                            removed += p[1] - p[0]
                            end = p[1]
                        elif p[1] > end:
                            removed += p[1] - end
                            end = p[1]
                    raw = b"".join([*pieces, raw[end:]])
                n_removed.append(removed)
                n_spans.append(count)
                digests.append(hashlib.sha256(raw).hexdigest())
                kept.append(raw if keep_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
                 pa.array(digests, pa.string()), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def remove_repeats(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the bytes left (``kept``)."""
    spans = repeated_places(docs).groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(
        F.collect_list(F.struct("begin", "end")).alias("spans"))  # of one text
    joined = keyed(docs).join(spans, (F.coalesce("doc_id", F.lit(-1)) == F.col("_id")) & (F.col("mark") == F.col("_mark")), "left")
    rows = joined.select("doc_id", "text", "spans", F.octet_length("text").cast("long").alias("n_bytes"))
    return rows.mapInArrow(_remove(keep_text), _REMOVED)


def op1_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beside the counts: whether anything was removed, and the text left (U+FFFD where a cut splits a character)."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    left = F.make_valid_utf8(F.col("kept").cast("string"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", (F.col("n_removed") > 0).alias("has_repeats"),
                        left.alias("text"))
