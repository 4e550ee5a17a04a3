"""Ranked lexical search over documents dealt by term owner.

1. Index: each document's different terms with their counts, cut into blocks of
   documents of bounded size. Blocks deal the documents, so a term that stands in
   every document is spread over all blocks.
2. Owners: the searched terms go to ``len(SHARES) + 1`` owner stages by document
   frequency, rare terms first. An owner holds the postings of its terms.
3. An item's bundle for a block holds the item's terms that occur there and a
   sparse accumulator (document, score). It passes through the owner stages one
   after the other: each stage is a cogroup of bundles and owned postings by
   block, which adds integer contributions to the accumulators.
4. Between stages the scores reached so far give each item a floor, the
   ``k``-th best partial score. A document whose score and all that later stages
   can add stay under the floor is out of the running; that is exact, as scores
   only grow. After the last stage a bundle keeps its best ``k`` documents.
5. Final selection ranks what the blocks kept.

Defined results: a term is a run of letters, digits and characters beyond ASCII,
A to Z in lower case; null texts have none. Rows without a term count nowhere.
Repeated rows are documents of their own that tie; null ids come first among
equal scores. Items that share an id form one item, whose terms add up; an item
without a term or a match has no row. An empty table gives none.
Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caselake.llm.common import stored, table
from caselake.llm.textnp import RollingHash, lower_ascii, slices
from caselake.operators.joins import join_summary

TOP = 20
#: A block ends at so many documents or different terms; one longer document is a block of its own.
BLOCK_ROWS, BLOCK_TERMS = 4096, 1 << 18
#: Upper bounds of the share of documents that hold a term, for each owner stage but the last.
SHARES = (1 / 64, 1 / 8)
_TERM = np.zeros(256, dtype=bool)
_TERM[128:] = True
for _first, _last in ("09", "AZ", "az"):
    _TERM[ord(_first):ord(_last) + 1] = True

#: Stands for a null id, so that nulls come first.
NO_ID = -(1 << 63)

INDEX = "block long, row int, id long, n long, terms array<long>, counts array<int>"
_LONG, _INT = pa.int64(), pa.int32()


def _stretches(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the runs of marked bytes; runs never cross texts."""
    begins = np.zeros(len(inside) + 1, dtype=bool)  # a text begins here
    begins[offsets[:-1]] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | begins[1:-1]
    ends[:-1] &= ~inside[1:] | begins[1:-1]
    start = np.flatnonzero(starts)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(offsets, start, side="right") - 1


def term_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms (hashes) of all texts by row, their counts, how many different ones a row has, and how many in all."""
    data = lower_ascii(data)
    start, end, row = _stretches(_TERM[data], offsets)
    n = len(offsets) - 1
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
    value = RollingHash(data)(start, end).view(np.int64)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(value))).astype(np.int32)
    return value[at], counts, np.bincount(row[at], minlength=n), np.bincount(row, minlength=n)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, text -> the rows of INDEX; blocks are numbered within the task."""
    block = (TaskContext.get().partitionId() << 32) - 1
    rows, held = BLOCK_ROWS, 0
    for batch in batches:
        for first, last, data, offsets in slices(batch.column(1)):
            terms, counts, different, total = term_counts(data, offsets)
            blocks, numbers = np.zeros(last - first, np.int64), np.zeros(last - first, np.int32)
            for i, size in enumerate(different.tolist()):
                if rows == BLOCK_ROWS or held + size > BLOCK_TERMS:
                    block, rows, held = block + 1, 0, 0
                blocks[i], numbers[i] = block, rows
                rows, held = rows + 1, held + size
            ends = pa.array(np.concatenate([[0], np.cumsum(different)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks), pa.array(numbers), batch.column(0).slice(first, last - first), pa.array(total, _LONG),
                 pa.ListArray.from_arrays(ends, pa.array(terms)), pa.ListArray.from_arrays(ends, pa.array(counts))],
                ["block", "row", "id", "n", "terms", "counts"])


def indexed(rows: DataFrame, key: str) -> DataFrame:
    """Term counts of ``rows`` (key, text); rows without a term are left out."""
    return rows.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("id"), "text").mapInArrow(_indexed, INDEX).filter("n > 0")


def _exploded(index: DataFrame, *columns: str) -> DataFrame:
    return index.select(*columns, F.inline(F.arrays_zip(F.col("terms").alias("term"), F.col("counts").alias("tf")))).toDF(
        *columns, "term", "tf")


def item_terms(items: DataFrame) -> DataFrame:
    """(item, term, times) of the items (item_id, text)."""
    return _exploded(indexed(items, "item_id"), "id").groupBy(F.col("id").alias("item"), "term").agg(F.sum("tf").alias("times"))


def postings(index: DataFrame, terms: DataFrame, documents: int, length: int) -> DataFrame:
    """(term, block, row, id, impact) of the searched terms.

    The impact is what a term's weight is multiplied by: it grows with the
    term's count and falls with the document's length.
    """
    searched = join_summary(_exploded(index, "block", "row", "id", "n"), terms.select("term").distinct(), "term")
    size = f"(75L + (25L * n * {documents}L) div {length}L)"
    return searched.select("term", "block", "row", "id", F.expr(f"(1000000000L * tf) div (1000L * tf + 12L * {size})").alias("impact"))


def weights(found: DataFrame, documents: int) -> DataFrame:
    """(term, weight, peak, stage) of the terms of postings; the peak is a term's greatest impact."""
    counted = found.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("impact").alias("peak"))
    weight = F.expr(f"cast(floor(1000 * ln(cast({2 * documents + 2} AS double) / cast(2 * df + 1 AS double))) AS long)")
    stage = F.lit(len(SHARES))
    for k in reversed(range(len(SHARES))):
        stage = F.when(F.col("df") <= int(SHARES[k] * documents), k).otherwise(stage)
    return counted.select("term", weight.alias("weight"), "peak", stage.alias("stage")).filter("weight > 0")


_ENTRY_COLUMNS = ("terms", "adds", "most", "stages")
BUNDLES = ("block long, item long, terms array<long>, adds array<long>, most array<long>, stages array<int>, "
           "rows array<int>, ids array<long>, scores array<long>, best array<long>")


def bundles(owned: DataFrame, items: DataFrame, weighted: DataFrame) -> DataFrame:
    """One bundle for each item and block that share a term, with nothing scored yet.

    ``adds`` is a term's weight times its occurrences in the item, ``most`` what it can add to a score.
    """
    entries = join_summary(items, weighted, "term").select(
        "item", "term", (F.col("times") * F.col("weight")).alias("add"),
        (F.col("times") * F.col("weight") * F.col("peak")).alias("most"), "stage")
    there = owned.select("term", "block").distinct().join(entries, "term")
    packed = there.groupBy("block", "item").agg(F.sort_array(F.collect_list(F.struct("stage", "term", "add", "most"))).alias("e"))
    nothing = F.array().cast("array<long>")
    return packed.select("block", "item", F.col("e.term").alias("terms"), F.col("e.add").alias("adds"), F.col("e.most").alias("most"),
                         F.col("e.stage").alias("stages"), F.array().cast("array<int>").alias("rows"), nothing.alias("ids"),
                         nothing.alias("scores"), nothing.alias("best"))


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, kind))


def owner_stage(stage: int, k: int, last: bool):
    """Adds the contributions of one owner's terms to the accumulators of a block's bundles."""
    def step(left: pa.Table, right: pa.Table) -> pa.Table:
        term, row, ids, impact = (right.column(c).to_numpy() for c in ("term", "row", "id", "impact"))
        order = np.argsort(term, kind="stable")
        term, row, impact = term[order], row[order], impact[order]
        ids = ids[order]
        columns = {c: left.column(c).combine_chunks() for c in left.schema.names}
        values = {c: columns[c].flatten().to_numpy(zero_copy_only=False) for c in (*_ENTRY_COLUMNS, "rows", "ids", "scores")}
        ends = {c: np.concatenate([[0], np.cumsum(columns[c].value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
                for c in ("terms", "rows")}
        floors = columns["floor"].to_numpy(zero_copy_only=False)
        begin, end = np.searchsorted(term, values["terms"]), np.searchsorted(term, values["terms"], side="right")
        size = 1 + max(row.max(initial=0), values["rows"].max(initial=0))
        acc, names = np.zeros(size, np.int64), np.zeros(size, np.int64)
        names[row] = ids
        names[values["rows"]] = values["ids"]
        out: dict[str, list[np.ndarray]] = {"rows": [], "ids": [], "scores": [], "best": []}
        for b in range(left.num_rows):
            acc[:] = 0
            carried = slice(ends["rows"][b], ends["rows"][b + 1])
            acc[values["rows"][carried]] = values["scores"][carried]
            rest = 0
            for e in range(ends["terms"][b], ends["terms"][b + 1]):
                if values["stages"][e] == stage:
                    a, z = begin[e], end[e]
                    acc[row[a:z]] += values["adds"][e] * impact[a:z]
                elif values["stages"][e] > stage:
                    rest += int(values["most"][e])
            kept = np.flatnonzero((acc > 0) & (acc + rest >= floors[b]))
            if last and len(kept) > k:
                kept = kept[np.lexsort((names[kept], -acc[kept]))[:k]]
            score = acc[kept]
            out["rows"].append(kept)
            out["ids"].append(names[kept])
            out["scores"].append(score)
            out["best"].append(np.sort(score)[-k:])
        done = {c: _lists(v, _INT if c == "rows" else _LONG) for c, v in out.items()}
        return pa.table({c: done.get(c, columns.get(c)) for c in
                         ("block", "item", *_ENTRY_COLUMNS, "rows", "ids", "scores", "best")})

    return step


def floors(carried: DataFrame, k: int) -> DataFrame:
    """(item, floor): the ``k``-th best score so far of the items that have so many."""
    best = Window.partitionBy("item").orderBy(F.desc("score"))
    ranked = carried.select("item", F.explode("best").alias("score")).withColumn("_r", F.row_number().over(best))
    return ranked.filter(F.col("_r") <= k).groupBy("item").agg(
        F.min("score").alias("floor"), F.count(F.lit(1)).alias("_n")).filter(F.col("_n") == k).drop("_n")


def search(documents: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score of each item's ``k`` best documents with a score above 0."""
    index = stored(indexed(documents, "doc_id"), "term-counts")
    n_documents, length = index.agg(F.count(F.lit(1)), F.sum("n")).first()
    wanted = stored(item_terms(items), "item-terms")
    found = stored(postings(index, wanted, n_documents, length or 1), "postings")
    weighted = stored(weights(found, n_documents), "term-weights")
    owned = stored(join_summary(found, weighted.select("term", "stage"), "term"), "owned-postings", "stage")
    carried = stored(bundles(owned, wanted, weighted), "bundles")
    for stage in range(len(SHARES) + 1):
        bounded = join_summary(carried, floors(carried, k), "item", "left").withColumn("floor", F.coalesce("floor", F.lit(0)))
        own = owned.filter(F.col("stage") == stage).select("block", "term", "row", "id", "impact")
        step = owner_stage(stage, k, stage == len(SHARES))
        carried = stored(bounded.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(step, BUNDLES), f"bundles-{stage}")
    scored = carried.select("item", F.inline(F.arrays_zip(F.col("ids").alias("id"), F.col("scores").alias("score"))))
    order = Window.partitionBy("item").orderBy(F.desc("score"), "id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return ranked.select(known("item").alias("item_id"), "rank", known("id").alias("doc_id"), "score")


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
OP12_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS k, {_TERMS} AS w FROM documents),
s AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS total FROM d WHERE len(w) > 0),
p AS (SELECT k, any_value(doc_id) AS doc_id, any_value(n) AS n, term, count(*) AS tf FROM (SELECT k, doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY k, term),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY 1, 2),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS weight
  FROM (SELECT term, count(*) AS df FROM p GROUP BY 1), s),
r AS (SELECT item_id, k, any_value(doc_id) AS doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // total))))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN p USING (term), s GROUP BY 1, 2),
o AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM r WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= {TOP}"""
