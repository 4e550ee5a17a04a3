"""Near duplicates from bottom-k sketches of one hash function.

1. A document's distinct word shingles are hashed once; equal sets form a class
   and a class keeps its ``K`` least hashes (bottom-k sketch).
2. Inverted lists of retained values generate overlaps. Of each sketch the
   commonest ``DROP`` values are left out of the lists: two sets over the
   threshold share far more than ``DROP`` retained values, so they still meet in
   a list, and values that very many documents carry make no lists.
3. Inside a list the union sketch of two classes estimates their similarity.
   A search that only looks at classes not yet reached links those that may
   pass, so a list of n copies costs about n estimates and yields n - 1 links.
4. Within each group of classes so linked, exact Jaccard on the full sets
   decides, again by a search over classes not yet reached. Confirmed links
   give the components.

Estimates are let through down to six standard deviations below the threshold,
and sets that fit into their sketch are compared exactly, so a link is lost with
a chance below 1e-9. Lists and groups over a fixed size are cut into blocks and
every pair of blocks is searched, so nothing is dropped and no task holds more
than two blocks.

Defined results: a text with fewer words than a shingle is one shingle of all
its words; a text without words (or null) has an empty set and is linked with
nothing; rows with equal sets are linked; null ids take part and never become a
component's id; an empty table gives no rows. Sets are compared by 64-bit
hashes of their shingles, classes by a 64-bit hash of the set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caselake.llm.common import packed, stored, table, text_or_empty
from caselake.llm.components import components
from caselake.llm.textnp import RollingHash, lower_ascii, mix, slices, words
from caselake.operators.joins import join_summary

WORDS = 5
K = 64
DROP = 24
PERCENT = 80
SIGMAS = 6
#: Classes of one list, and bytes of texts and full sets of one group, that a block holds.
LIST_BLOCK = 4096
SET_BLOCK = 4 << 20
U64 = np.uint64
_STEP = U64(0x9E3779B97F4A7C15)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of all texts of a slice, by row and value, and their row numbers."""
    data = lower_ascii(data)
    start, end, row = words(data, offsets)
    if not len(start):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    h = RollingHash(data)(start, end)
    n = len(offsets) - 1
    count = np.bincount(row, minlength=n)
    first = np.cumsum(count) - count
    whole = count >= size
    total = len(h)
    value = np.zeros(max(0, total - size + 1), U64)
    for i in range(size):
        value = value * _STEP + h[i:total - size + 1 + i]
    at = np.flatnonzero(row[:total - size + 1] == row[size - 1:]) if total >= size else np.zeros(0, np.int64)
    parts, rows = [mix(value[at])], [row[at]]
    for r in np.flatnonzero(~whole & (count > 0)):  # fewer words than a shingle: all of them, and how many
        v = count[r:r + 1].astype(U64)  # an array, whose products wrap
        for x in h[first[r]:first[r] + count[r]]:
            v = v * _STEP + x
        parts.append(mix(v + U64(1)))
        rows.append(np.array([r]))
    value, row = np.concatenate(parts), np.concatenate(rows)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return value[new], row[new]


SKETCHES = "doc_id long, text_hash long, n long, class long, sketch array<long>, bytes long"


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, text, text_hash -> ids, n (size of the set), class (hash of the set), sketch (least K, as signed), bytes."""
    for batch in batches:
        for first, last, data, offsets in slices(batch.column(1)):
            value, row = shingles(data, offsets)
            m = last - first
            n = np.bincount(row, minlength=m)
            begin = np.cumsum(n) - n
            sums = np.concatenate([[U64(0)], np.cumsum(mix(value + U64(0x51ED270B)), dtype=U64)])
            cls = mix(sums[begin + n] - sums[begin] + n.astype(U64) * _STEP)
            rank = np.arange(len(value)) - begin[row]
            low = value[rank < K].view(np.int64)
            ends = np.concatenate([[0], np.cumsum(np.minimum(n, K))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, m), batch.column(2).slice(first, m), pa.array(n, pa.int64()),
                 pa.array(cls.view(np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(low)), pa.array(np.diff(offsets))],
                ["doc_id", "text_hash", "n", "class", "sketch", "bytes"])


def _once(members: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """One row of each class, and the classes."""
    cls, first = np.unique(members.column("class").to_numpy(), return_index=True)
    return members.take(pa.array(first)), cls


def _linked(cls: np.ndarray, a: list[int], b: list[int]) -> pa.Table:
    return pa.table({"a": pa.array(cls[a], pa.int64()), "b": pa.array(cls[b], pa.int64())})


def _forest(near, n: int) -> tuple[list[int], list[int]]:
    """Links of a spanning forest; ``near(i, others)`` tells which of ``others`` are linked with i."""
    left, right = [], []
    rest = np.arange(n)
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            hit = near(i, rest)
            found = rest[hit]
            left.extend([i] * len(found))
            right.extend(found.tolist())
            queue.extend(found.tolist())
            rest = rest[~hit]
    return left, right


def _estimated(percent: int):
    """Spanning links of a block of sketches whose union-sketch estimate may reach the threshold."""
    t = percent / 100
    lenient = t - SIGMAS * (t * (1 - t) / K) ** 0.5

    def links(members: pa.Table) -> pa.Table:
        members, cls = _once(members)
        size = members.column("n").to_numpy()
        kept = np.minimum(size, K)
        flat = members.column("sketch").combine_chunks().flatten().to_numpy()
        values, column = np.unique(flat.view(U64), return_inverse=True)
        table_ = np.full((len(cls), K), len(values), dtype=np.int64)  # the last column stands for "no value"
        table_[np.arange(K)[None, :] < kept[:, None]] = column
        places = np.zeros(len(values) + 1, dtype=np.int64)
        steps = np.arange(1, K + 1)

        def near(i: int, others: np.ndarray) -> np.ndarray:
            mine = table_[i, :kept[i]]
            places[mine] = np.arange(1, kept[i] + 1)
            out = np.zeros(len(others), bool)
            for a in range(0, len(others), 1024):
                part = others[a:a + 1024]
                rank = places[table_[part]]
                both = rank > 0
                seen = np.cumsum(both, axis=1)
                union = size[i] + size[part] - seen[:, -1]  # exact where both sets fit into their sketches
                within = (both & (rank + steps - seen <= K)).sum(axis=1)
                k = np.minimum(K, union)
                exact = (size[i] <= K) & (size[part] <= K)
                out[a:a + 1024] = np.where(exact, 100 * seen[:, -1] >= percent * union, within >= lenient * k)
            places[mine] = 0
            return out

        return _linked(cls, *_forest(near, len(cls)))

    return links


def _exact(percent: int):
    """Spanning links of a block of texts whose full sets reach the threshold."""
    def links(members: pa.Table) -> pa.Table:
        members, cls = _once(members)
        sets, bounds = [], [0]
        for _, _, data, offsets in slices(members.column("text").combine_chunks()):
            value, row = shingles(data, offsets)
            sets.append(value)
            bounds.extend((bounds[-1] + np.cumsum(np.bincount(row, minlength=len(offsets) - 1))).tolist())
        flat = np.concatenate(sets)
        bounds = np.array(bounds)
        size = np.diff(bounds)
        values, column = np.unique(flat, return_inverse=True)
        mark = np.zeros(len(values), dtype=bool)

        def near(i: int, others: np.ndarray) -> np.ndarray:
            out = np.zeros(len(others), bool)
            possible = np.flatnonzero((100 * np.minimum(size[others], size[i]) >= percent * np.maximum(size[others], size[i])))
            mine = column[bounds[i]:bounds[i + 1]]
            mark[mine] = True
            for a in range(0, len(possible), 256):
                part = others[possible[a:a + 256]]
                n = size[part]
                ends = np.cumsum(n)
                at = np.arange(ends[-1]) + np.repeat(bounds[part] - (ends - n), n)
                common = np.add.reduceat(mark[column[at]].astype(np.int64), ends - n)
                out[possible[a:a + 256]] = 100 * common >= percent * (size[i] + n - common)
            mark[mine] = False
            return out

        return _linked(cls, *_forest(near, len(cls)))

    return links


def block_pairs(members: DataFrame, group: list[str], n_blocks: Column) -> DataFrame:
    """``members`` once for every pair of blocks their own block is part of: adds _i and _j.

    A group of one block stays one task; of n blocks, each row appears n times.
    """
    block = F.pmod(F.xxhash64("class", F.lit("block")), n_blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), (n_blocks - 1).cast("int")))
    return (members.withColumn("_block", block).withColumn("_other", other)
            .withColumn("_i", F.least("_block", "_other")).withColumn("_j", F.greatest("_block", "_other"))
            .drop("_block", "_other"))


def candidate_links(classes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes whose estimates may reach the threshold; a spanning forest per list."""
    terms = classes.select("class", F.explode("sketch").alias("value"))
    frequent = terms.groupBy("value").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = join_summary(terms, frequent, "value").groupBy("class").agg(
        F.sort_array(F.collect_list(F.struct("df", "value"))).alias("terms"))  # K entries at most
    sizes = classes.select("class", F.size("sketch").alias("m"))
    kept = F.col("m") - F.least(F.lit(DROP), F.floor(F.col("m") * DROP / K))  # values of the sketch that make lists
    lone = F.col("m") - F.size("terms")  # the rarest: values that no other class has
    rare = F.expr("slice(terms, 1, cast(greatest(0, _kept - _lone) AS int))")
    lists = (shared.join(sizes, "class").withColumn("_kept", kept).withColumn("_lone", lone)
             .select("class", F.explode(rare).alias("t")).select("class", "t.value"))
    lists = stored(lists, "inverted-lists")
    # Lists of the same classes are searched once.
    shape = lists.groupBy("value").agg(
        F.count(F.lit(1)).alias("size"), F.sum(F.hash("class").cast("long")).alias("s1"),
        F.bit_xor(F.xxhash64("class")).alias("s2")).filter("size > 1")
    once = shape.groupBy("size", "s1", "s2").agg(F.min("value").alias("value")).select("value", "size")
    members = lists.join(once, "value").withColumn("_blocks", F.ceil(F.col("size") / LIST_BLOCK))
    rows = block_pairs(members, ["value"], F.col("_blocks")).select("value", "_i", "_j", "class")
    return (rows.join(classes, "class").groupBy("value", "_i", "_j")
            .applyInArrow(_estimated(percent), "a long, b long").distinct())


def confirmed_links(docs: DataFrame, rows: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes of one group (node, label) whose full sets reach the threshold."""
    chosen = rows.join(groups, F.col("class") == F.col("node")).groupBy("class", "label").agg(
        F.min(F.struct("doc_id", "text_hash", "n", "bytes")).alias("r")).select("class", "label", "r.*")
    weight = chosen.groupBy("label").agg(F.sum(8 * F.col("n") + F.col("bytes")).alias("weight"))
    chosen = join_summary(chosen.drop("bytes"), weight, "label")
    texts = docs.select(F.col("doc_id").alias("_id"), "text", F.xxhash64(text_or_empty()).alias("_hash"))
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("text_hash"))
    # Repeated rows give a class's text again; the search drops them.
    members = texts.join(chosen, same).select("class", "label", "text", F.ceil(F.col("weight") / SET_BLOCK).alias("_blocks"))
    pairs = block_pairs(members, ["label"], F.col("_blocks")).select("label", "_i", "_j", "class", "text")
    return pairs.groupBy("label", "_i", "_j").applyInArrow(_exact(percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id for every row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hashed = docs.withColumn("text_hash", F.xxhash64(text_or_empty()))
    sketched = stored(hashed.mapInArrow(_sketches, SKETCHES), "sketches")
    plain = sketched.select("doc_id", "text_hash", "n", "class", "bytes")
    filled = sketched.filter("n > 0")
    one = Window.partitionBy("class").orderBy("n")
    classes = stored(filled.select("class", "n", "sketch").withColumn("_r", F.row_number().over(one))
                     .filter("_r = 1").drop("_r"), "classes")
    groups = components(candidate_links(classes, percent), "candidate-groups")
    links = confirmed_links(docs, plain.filter("n > 0"), groups, percent)
    labels = components(links, "near-duplicate-groups").select(F.col("node").alias("_node"), "label")
    labelled = plain.join(labels, (F.col("n") > 0) & (F.col("class") == F.col("_node")), "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "class")).drop("_node")
    least = labelled.filter("n > 0").groupBy("label").agg(F.min("doc_id").alias("_least"))
    return join_summary(labelled, least, "label", "left").select(
        "doc_id", "text_hash", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("_least")).otherwise(F.col("doc_id")).alias("component_id"), "label")


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each component: that of the least id, once if it is repeated. Rows with empty sets all stay.

    Rows are found again by one hash of id and text, on which the rank of
    repeated rows needs no further shuffle.
    """
    found = near_duplicates(docs, percent)
    first = Window.partitionBy("label").orderBy(F.col("doc_id").asc_nulls_last(), "text_hash")
    filled = found.filter("n_shingles > 0").withColumn("_r", F.row_number().over(first)).filter("_r = 1")
    kept = (filled.select("doc_id", "text_hash", F.lit(False).alias("all"))
            .unionByName(found.filter("n_shingles = 0").select("doc_id", "text_hash", F.lit(True).alias("all")).distinct())
            .withColumn("key", F.xxhash64("doc_id", "text_hash")))
    rows = packed(docs, "doc_id", F.xxhash64(text_or_empty()).alias("text_hash"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "text_hash"))
    same = ((F.col("d.key") == F.col("k.key")) & (F.col("d.text_hash") == F.col("k.text_hash"))
            & F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")))
    joined = rows.alias("d").join(kept.alias("k"), same).select("d.*", "k.all")
    copy = Window.partitionBy("key", "doc_id", "text_hash").orderBy(F.xxhash64("_row"))
    return joined.withColumn("_r", F.row_number().over(copy)).filter("all OR _r = 1").select("_row.*")


def op10_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), percent=85)
    return found.select("doc_id", "n_shingles", "component_id",
                        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:CASE WHEN len(w) < 5 THEN len(w) ELSE i + 4 END], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT x, y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2)
  JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM p UNION SELECT y, x FROM p),
r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.doc_id)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(c) AS component_id, r.doc_id = min(c) AS kept
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id"""
