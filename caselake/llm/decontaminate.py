"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are compared in lower case with runs of white space as one space. A
region of a document within ``k`` edits of an item of ``m`` characters shares at
least ``m - Q + 1 - k * Q`` q-grams with it, all on ``k + 1`` neighbouring
diagonals. Shared q-grams are counted in overlapping bands of ``2 * (k + 1)``
diagonals, so one band holds them all; bands that reach the bound are verified
by a banded alignment of the whole item, which decides. Nothing below the edit
budget is missed.

Items of ``LONG`` characters or more are also searched as overlapping windows of
``WINDOW`` characters, each with a budget and bound of its own, so a quoted part
of ``WINDOW + STEP`` characters is found wherever it is cut. Shorter items are
found whole. An item gives one match per document: the whole item's, or else
that of its best window.

The benchmark is the stated query set: it is read in blocks of ``BLOCK_CHARS``
characters, each broadcast on its own, against all documents. Documents are
never shuffled; a task holds one Arrow batch.

Defined results: null texts are empty; items of fewer than ``Q`` characters are
too short to be told from chance and are not searched; repeated items match one
by one; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake.llm.common import packed, plain, table, text_reader

Q = 8
#: Edits allowed per hundred characters of an item.
EDIT_PERCENT = 8
BLOCK_CHARS = 2_000_000
#: Items of so many characters are also searched in windows of so many, one every STEP characters.
LONG, WINDOW, STEP = 400, 200, 100
#: Characters of documents that are worked on together.
SLICE_CHARS = 1 << 18
U64 = np.uint64
_A = 0x9E3779B97F4A7C15
#: Stands between texts and for places outside a text; no character has these numbers.
_GAP, _OUTSIDE = 0x110000, 0x110001
_TABLE_BITS = 20


def normalized(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts with a gap after each; starts and lengths."""
    parts = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
    length = np.array([len(p) for p in parts], dtype=np.int64)
    start = np.cumsum(length + 1) - (length + 1)
    codes = np.full(int((length + 1).sum()), _GAP, dtype=np.uint32)
    if len(parts):
        inside = np.ones(len(codes), bool)
        inside[start + length] = False
        codes[inside] = np.concatenate(parts)
    return codes, start, length


def _grams(codes: np.ndarray) -> np.ndarray:
    """Hash of the Q = 8 characters from every place on; places too near the end are left out."""
    h = (codes.astype(U64) + U64(1)) * U64(0xC2B2AE3D27D4EB4F)
    width, factor = 1, _A
    while width < Q:
        h = h[:-width] * U64(factor & (2**64 - 1)) + h[width:]
        width, factor = 2 * width, factor * factor
    return (h ^ (h >> U64(29))) * U64(0xBF58476D1CE4E5B9)


@dataclass
class Index:
    """Q-grams of a block of items and windows, sorted, with their items and places; ``whole``: the item of a window."""

    ids: list
    whole: list
    codes: np.ndarray
    start: np.ndarray
    length: np.ndarray
    budget: np.ndarray
    bound: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    table: np.ndarray


def build_index(items: list[tuple], percent: int = EDIT_PERCENT) -> Index | None:
    """``items``: (id, normalized text of Q characters at least)."""
    if not items:
        return None
    windows = [(i, text[a:a + WINDOW]) for i, (_, text) in enumerate(items) if len(text) >= LONG
               for a in [*range(0, len(text) - WINDOW, STEP), len(text) - WINDOW]]
    whole = [*range(len(items)), *[i for i, _ in windows]]
    items = [*items, *[(items[i][0], text) for i, text in windows]]
    codes, start, length = _codes([t for _, t in items])
    budget = np.minimum(length * percent // 100, (length - Q) // Q)  # the bound stays at 1 or more
    value, item, place = [], [], []
    for i in range(len(items)):
        g = _grams(codes[start[i]:start[i] + length[i]])
        value.append(g)
        item.append(np.full(len(g), i))
        place.append(np.arange(len(g)))
    value, item, place = map(np.concatenate, (value, item, place))
    order = np.argsort(value, kind="stable")
    grams, first = np.unique(value[order], return_index=True)
    known = np.zeros(1 << _TABLE_BITS, bool)
    known[(grams >> U64(64 - _TABLE_BITS)).astype(np.int64)] = True
    return Index([i for i, _ in items], whole, codes, start, length, budget, length - Q + 1 - budget * Q,
                 grams, np.append(first, len(value)), item[order], place[order], known)


def _regions(index: Index, codes: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, ...]:
    """Document, item, first diagonal and shared q-grams of the bands that reach the bound."""
    none = (np.zeros(0, np.int64),) * 4
    if len(codes) < Q:
        return none
    gram = _grams(codes)
    at = np.flatnonzero(index.table[(gram >> U64(64 - _TABLE_BITS)).astype(np.int64)])
    slot = np.searchsorted(index.grams, gram[at])
    slot = np.minimum(slot, len(index.grams) - 1)
    hit = index.grams[slot] == gram[at]
    at, slot = at[hit], slot[hit]
    if not len(at):
        return none
    n = index.first[slot + 1] - index.first[slot]
    ends = np.cumsum(n)
    entry = np.arange(ends[-1]) + np.repeat(index.first[slot] - (ends - n), n)
    where = np.repeat(at, n)
    doc = np.searchsorted(start, where, side="right") - 1
    item = index.item[entry]
    diagonal = where - start[doc] - index.place[entry] + index.length[item]  # never negative
    step = index.budget[item] + 1
    upper = diagonal // step  # band b covers the diagonals from b * step up to (b + 2) * step
    doc, item, band = np.tile(doc, 2), np.tile(item, 2), np.concatenate([upper, upper - 1])
    n_items, n_bands = len(index.ids), int(band.max()) + 2
    key = (doc * n_items + item) * n_bands + band + 1
    key, shared = np.unique(key, return_counts=True)
    item = key // n_bands % n_items
    reached = shared >= index.bound[item]
    key, shared, item = key[reached], shared[reached], item[reached]
    first = (key % n_bands - 1) * (index.budget[item] + 1) - index.length[item]
    return key // n_bands // n_items, item, first, shared


def _align(index: Index, codes: np.ndarray, start: np.ndarray, length: np.ndarray,
           doc: np.ndarray, item: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least edits of the whole item against each region, and where the best region ends.

    Column c of row i is the item's first i characters ending at place i + c of
    the region; all regions advance a row together.
    """
    k = index.budget[item]
    low = first - k
    width = int((4 * k + 2).max())
    m = index.length[item]
    rows = int(m.max())
    place = low[:, None] + np.arange(rows + width)[None, :]
    ok = (place >= 0) & (place < length[doc][:, None])
    region = np.where(ok, codes[np.where(ok, place + start[doc][:, None], 0)], _OUTSIDE)
    row = np.minimum(np.arange(rows)[None, :], m[:, None] - 1)
    chars = index.codes[index.start[item][:, None] + row]
    column = np.arange(width)
    far = rows + width
    state = np.where(column[None, :] < (4 * k + 2)[:, None], 0, far).astype(np.int64)
    best, end = np.full(len(item), far), np.zeros(len(item), np.int64)
    for i in range(rows):
        other = chars[:, i:i + 1] != region[:, i:i + width]
        step = state + other
        step[:, :-1] = np.minimum(step[:, :-1], state[:, 1:] + 1)
        state = np.minimum.accumulate(step - column, axis=1) + column
        done = m == i + 1
        if done.any():
            c = np.argmin(state[done], axis=1)
            best[done] = state[done, c]
            end[done] = low[done] + i + 1 + c
    return best, end


_MATCH = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("shared", pa.int32()), ("end_char", pa.int64())]))
MATCHES = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType()),
    T.StructField("shared", T.IntegerType()), T.StructField("end_char", T.LongType())]))


def search(index: Index, texts: list[str]) -> list[list[dict]]:
    """Per normalized text the items found: least distance, q-grams shared, end of the region."""
    found: list[list[dict]] = [[] for _ in texts]
    codes, start, length = _codes(texts)
    doc, item, first, shared = _regions(index, codes, start, length)
    for a in range(0, len(doc), 256):
        d, t = doc[a:a + 256], item[a:a + 256]
        distance, end = _align(index, codes, start, length, d, t, first[a:a + 256])
        for i in np.flatnonzero(distance <= index.budget[t]):
            own = index.whole[t[i]]
            new = {"item_id": index.ids[own], "distance": int(distance[i]), "shared": int(shared[a + i]), "end_char": int(end[i]),
                   "index": own, "rank": (own != t[i], int(distance[i]))}
            old = next((x for x in found[d[i]] if x["index"] == own), None)
            if old is None:
                found[d[i]].append(new)
            elif new["rank"] < old["rank"]:
                old.update(new)
    return [[{n: v for n, v in x.items() if n not in ("index", "rank")} for x in f] for f in found]


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple]]:
    """Normalized items in blocks of at most ``BLOCK_CHARS`` characters with windows (or one longer item)."""
    block, held = [], 0
    for r in benchmark.select("item_id", "text").toLocalIterator():
        text = normalized(r["text"])
        if len(text) < Q:
            continue
        size = len(text) * (1 + WINDOW // STEP if len(text) >= LONG else 1)  # its windows count
        if block and held + size > BLOCK_CHARS:
            yield block
            block, held = [], 0
        block.append((r["item_id"], text))
        held += size
    if block:
        yield block


def with_matches(docs: DataFrame, benchmark: DataFrame, percent: int = EDIT_PERCENT) -> DataFrame:
    """``docs`` with ``benchmark_matches``: array of (item_id, distance, shared, end_char), empty when clean."""
    column = "benchmark_matches"
    docs = docs.drop(column)
    out = docs.withColumn(column, F.array().cast(MATCHES))
    schema = T.StructType(docs.schema.fields + [T.StructField(column, MATCHES)])
    read = text_reader(docs)
    for block in _blocks(benchmark):
        # BLOCK_CHARS bounds it; plain arrays, which workers read without this package
        held = docs.sparkSession.sparkContext.broadcast(plain(build_index(block, percent)))

        def find(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = Index(*held.value)
            for batch in batches:
                matches: list[list[dict]] = []
                texts: list[str] = []
                chars = 0
                for scalar in read(batch):
                    text = normalized(scalar.as_py())
                    texts.append(text)
                    chars += len(text)
                    if chars >= SLICE_CHARS:
                        matches.extend(search(index, texts))
                        texts, chars = [], 0
                matches.extend(search(index, texts))
                before = batch.column(batch.num_columns - 1).to_pylist()
                both = pa.array([(b or []) + m for b, m in zip(before, matches)], _MATCH)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], both], batch.schema.names)

        out = out.mapInArrow(find, schema)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without an item of the benchmark or, of long items, a window."""
    return with_matches(packed(docs), benchmark).filter(F.size("benchmark_matches") == 0).select("_row.*")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_matches(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("benchmark_matches").alias("m")).select("doc_id", "m.*")
