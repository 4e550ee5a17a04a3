"""Quality classifier by importance resampling.

Two generative models over hashed word n-grams (one and two words): a target
model from labelled good texts and a raw model from the whole corpus. A
document's log weight is the sum over its n-grams of the log ratio of the two.
Rows are drawn without replacement in proportion to their weights by Gumbel
top-k: the k largest of log weight plus Gumbel noise stay. The noise comes from
a hash of id and text, so a task that runs again draws the same numbers.

How many rows are drawn (k) is not a fixed share: it is the number of rows that
the two models take for target text, those whose log weight is at or above the
cut with the fewest errors on labelled rows that the target model has not seen.
Which rows they are the noisy weights decide, by :func:`top_k`'s way.

Toxic rows are told by a second ratio, which asks in how many toxic and in how
many other labelled texts an n-gram stands: a few words make a text toxic,
however long it is, so its toxic weight is the sum of its two largest log
ratios, not a mean. The cut on that weight is fitted on held-out labels as well,
and rows at or above it are rejected whatever their quality.

Labelled rows are a sample of at most ``MAX_LABELLED`` rows (by hash of the id),
which bounds the broadcast and what reaches the driver. The models are tables of
``BUCKETS`` counts whatever the corpus; raw counts cover all documents.

Defined results: a document without words has weight 0 and is never drawn; rows
that tie with the k-th weight all stay, rows without a weight do not; null
ids and labels of absent documents are harmless; rows labelled several times
count as good only if all their labels are, and as toxic if one of them is;
without good labels no text is rejected for its quality, without toxic or
without other labels none as toxic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake.llm.common import packed, stored, table, text_or_empty, text_reader
from caselake.llm.textnp import RollingHash, lower_ascii, mix, slices, words

BUCKETS = 1 << 16
MAX_LABELLED = 20_000
#: Added to every bucket's observed and expected count.
SMOOTHING = 4.0
#: A document's log weight is that of a passage of so many n-grams with its mean log ratio.
PASSAGE = 100
#: Buckets of the toxic model: few enough texts share one by chance that long texts are not taken for toxic.
TOXIC_BITS = 20
#: N-grams below this log ratio say nothing about toxicity.
TOXIC_LEAST = float(np.log(2))
U64 = np.uint64


def ngram_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row number of every word and every pair of neighbouring words."""
    data = lower_ascii(data)
    start, end, row = words(data, offsets)
    if not len(start):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    h = RollingHash(data)(start, end)
    pair = row[1:] == row[:-1]
    two = mix(h[:-1] * U64(0x9E3779B97F4A7C15) + h[1:])[pair]
    return np.concatenate([h, two]), np.concatenate([row, row[1:][pair]])


def in_buckets(hashes: np.ndarray, bits: int = 16) -> np.ndarray:
    return (hashes >> U64(64 - bits)).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, data, offsets in slices(batch.column(0)):
            total += np.bincount(in_buckets(ngram_hashes(data, offsets)[0]), minlength=BUCKETS)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"])


def model(docs: DataFrame) -> np.ndarray:
    """Counts of the hashed n-grams of all ``docs``: ``BUCKETS`` numbers, added up by Spark."""
    partial = docs.select("text").mapInArrow(_counts, "bucket long, n long")
    counts = np.zeros(BUCKETS)
    for r in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]
    return counts


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log of target over raw probability per bucket, drawn towards 0 where the target sample says little.

    The count that the raw model leads to expect in the target sample takes
    the raw probability's place, so that ``SMOOTHING`` added to both sides is
    the same amount of evidence in every bucket.
    """
    expected = target.sum() * raw / max(1.0, raw.sum())
    return np.log((target + SMOOTHING) / (expected + SMOOTHING))


def _toxic_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of batches (text, toxic, fold): per bucket the texts that hold it, by fold and label; bucket -1 counts all texts."""
    total = np.zeros((4, 1 << TOXIC_BITS), np.int64)
    texts = np.zeros(4, np.int64)
    for batch in batches:
        group = 2 * np.array(batch.column(2).to_pylist(), np.int64) + np.array(batch.column(1).to_pylist(), np.int64)
        texts += np.bincount(group, minlength=4)
        for first, last, data, offsets in slices(batch.column(0)):
            hashes, row = ngram_hashes(data, offsets)
            once = np.unique((row << TOXIC_BITS) + in_buckets(hashes, TOXIC_BITS))
            of = group[first:last][once >> TOXIC_BITS]
            for g in range(4):
                total[g] += np.bincount(once[of == g] & ((1 << TOXIC_BITS) - 1), minlength=1 << TOXIC_BITS)
    used = np.flatnonzero(total.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(used, -1))] + [pa.array(np.append(total[g, used], texts[g])) for g in range(4)],
        ["bucket", "clean0", "toxic0", "clean1", "toxic1"])


def toxic_model(sample: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Texts per fold and label (clean, toxic), and of these the texts that hold an n-gram of each bucket.

    Buckets that too few toxic texts hold to reach ``TOXIC_LEAST`` stay 0.
    """
    names = ["clean0", "toxic0", "clean1", "toxic1"]
    partial = sample.select("text", "toxic", "fold").mapInArrow(_toxic_counts, ", ".join(f"{c} long" for c in ["bucket", *names]))
    told = partial.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in names]).filter(
        (F.col("bucket") < 0) | (F.col("toxic0") + F.col("toxic1") >= SMOOTHING))
    counts, texts = np.zeros((2, 2, 1 << TOXIC_BITS)), np.zeros((2, 2))
    for r in told.collect():
        if r["bucket"] < 0:
            texts[:] = np.reshape(r[1:], (2, 2))
        else:
            counts[:, :, r["bucket"]] = np.reshape(r[1:], (2, 2))
    return texts, counts


def toxic_ratio(texts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log of toxic over clean share of texts per bucket, 0 below ``TOXIC_LEAST``."""
    expected = texts[1] * counts[0] / max(1.0, texts[0])
    ratio = np.log((counts[1] + SMOOTHING) / (expected + SMOOTHING))
    return np.where(ratio >= TOXIC_LEAST, ratio, 0.0)


def _two_largest(hashes: np.ndarray, row: np.ndarray, ratio: np.ndarray, n: int) -> np.ndarray:
    """Per row the sum of the two largest ratios of its different n-grams."""
    bucket = in_buckets(hashes, TOXIC_BITS)
    some = ratio[bucket] > 0
    once = np.unique((row[some] << TOXIC_BITS) + bucket[some])
    value, row = ratio[once & ((1 << TOXIC_BITS) - 1)], once >> TOXIC_BITS
    order = np.lexsort((-value, row))
    value, row = value[order], row[order]
    begin = np.searchsorted(row, row)
    top = np.arange(len(row)) - begin < 2
    return np.bincount(row[top], weights=value[top], minlength=n)


def with_weights(docs: DataFrame, ratio: np.ndarray, toxic: np.ndarray | None = None) -> DataFrame:
    """``docs`` with ``log_weight``, ``toxic_weight`` (0 without toxic ratios) and ``has_words``."""
    # BUCKETS and 2 ** TOXIC_BITS numbers
    held = docs.sparkSession.sparkContext.broadcast((ratio.astype(np.float64), toxic))
    texts = text_reader(docs)
    new = ["log_weight", "toxic_weight", "has_words"]
    schema = T.StructType(docs.schema.fields + [
        T.StructField(c, T.BooleanType() if c == "has_words" else T.DoubleType()) for c in new])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_, toxic_table = held.value
        for batch in batches:
            weight, toxic_weight, some = np.zeros(batch.num_rows), np.zeros(batch.num_rows), np.zeros(batch.num_rows, bool)
            for first, last, data, offsets in slices(texts(batch)):
                hashes, row = ngram_hashes(data, offsets)
                total = np.bincount(row, weights=table_[in_buckets(hashes)], minlength=last - first)
                n = np.bincount(row, minlength=last - first)
                weight[first:last] = PASSAGE * total / np.maximum(n, 1)
                some[first:last] = n > 0
                if toxic_table is not None:
                    toxic_weight[first:last] = _two_largest(hashes, row, toxic_table, last - first)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(weight), pa.array(toxic_weight), pa.array(some)],
                                             [*batch.schema.names, *new])

    return docs.mapInArrow(score, schema)


def with_noise(scored: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``noisy_weight``: log weight plus standard Gumbel noise from a hash of id and text."""
    bits = F.shiftrightunsigned(F.xxhash64("doc_id", text_or_empty(text)), 11).cast("double")
    uniform = (bits + 0.5) / float(1 << 53)
    return scored.withColumn("noisy_weight", F.col("log_weight") - F.log(-F.log(uniform)))


def kth_largest(values: DataFrame, k: int) -> float:
    """The k-th largest value of the one column of ``values`` (nulls aside), found without a global sort.

    An interval is narrowed to one of 1,000 bins until its rows weigh the same.
    Infinite for k of 0 or less, minus infinite if there are no more than k.
    """
    value = F.col(values.columns[0])
    low, high, total = values.agg(F.min(value), F.max(value), F.count(value)).first()
    if k <= 0 or total <= k:
        return float("inf") if k <= 0 else float("-inf")
    above = 0  # rows over the interval
    while low < high:
        width = (high - low) / 1000
        if low + width <= low:
            break
        inside = values.filter(value.between(low, high))
        bins = inside.groupBy(F.least(F.floor((value - low) / width), F.lit(999)).alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"))
        for r in sorted(bins.collect(), key=lambda r: -r["bin"]):  # 1,000 rows at most
            if above + r["n"] >= k:
                low, high = r["low"], r["high"]
                break
            above += r["n"]
    return low


def top_k(noisy: DataFrame, k: int) -> DataFrame:
    """The k rows of the largest ``noisy_weight`` and all that tie with the last of them."""
    return noisy.filter(F.col("noisy_weight") >= kth_largest(noisy.select("noisy_weight"), k))


def labelled(docs: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """At most ``most`` labelled documents (by hash of the id): doc_id, text, good, toxic, fold (0 or 1)."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(
        F.min(F.col("quality") == 1).alias("good"), F.max(F.coalesce("toxic", F.lit(0)) != 0).alias("toxic"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(most)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(2)).cast("int")
    return stored(rows.select("doc_id", "text", "good", "toxic", fold.alias("fold")), "labelled")


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The cut between two weights with the fewest errors: good rows below it and bad rows above it."""
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order]
    errors = np.concatenate([[0], np.cumsum(g)]) + np.concatenate([[0], -np.cumsum(~g)])
    i = int(np.argmin(errors))
    if i == 0:
        return float("-inf")
    return float(w[-1]) + 1.0 if i == len(w) else float((w[i - 1] + w[i]) / 2)


def fit_toxic(sample: DataFrame) -> tuple[np.ndarray | None, float]:
    """Toxic log ratios from labelled rows and the cut on the toxic weight, fitted across the two folds.

    The ratios are the mean of the two folds': more labels would raise all
    ratios, and the cut with them.
    """
    texts, counts = toxic_model(sample)
    if not texts.sum(axis=0).all():
        return None, float("inf")
    none = np.zeros(BUCKETS)
    ratios = [toxic_ratio(texts[f], counts[f]) for f in (0, 1)]
    seen = [with_weights(sample.filter(F.col("fold") == f), none, ratios[1 - f])
            .select("toxic_weight", "toxic") for f in (0, 1)]
    rows = seen[0].unionByName(seen[1]).collect()  # MAX_LABELLED pairs at most
    cut = best_cut(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=bool))
    return (ratios[0] + ratios[1]) / 2, max(cut, TOXIC_LEAST)


def fit(docs: DataFrame, sample: DataFrame) -> tuple[np.ndarray, float]:
    """Log ratios from all documents and the labelled rows, and the cut on the log weight.

    Toxic rows teach neither the target model nor the cut; they have a model of
    their own (:func:`fit_toxic`). The cut is fitted across two folds, each
    weighed by a target model of the other; the final target model has both.
    """
    sample = sample.filter(~F.col("toxic"))
    raw = model(docs)
    folds = [model(sample.filter(F.col("good") & (F.col("fold") == f))) for f in (0, 1)]
    if not (folds[0].sum() + folds[1].sum()):
        return np.zeros(BUCKETS), float("-inf")
    seen = [with_weights(sample.filter(F.col("fold") == f), log_ratio(folds[1 - f], raw))
            .filter("has_words").select("log_weight", "good") for f in (0, 1)]
    rows = seen[0].unionByName(seen[1]).collect()  # MAX_LABELLED pairs at most
    cut = best_cut(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=bool))
    return log_ratio(folds[0] + folds[1], raw), cut


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, log_weight, toxic_weight, noisy_weight and kept for every row of ``docs``, and the row itself as ``_row``."""
    sample = labelled(docs, labels)
    ratio, cut = fit(docs, sample)
    toxic, toxic_cut = fit_toxic(sample)
    may_stay = F.col("has_words") & (F.col("toxic_weight") < F.lit(toxic_cut))

    def weighed(rows: DataFrame) -> DataFrame:
        return with_noise(with_weights(rows, ratio, toxic), "_row.text" if "_row" in rows.columns else "text")

    # Two numbers a row: the k-th weight is looked for in them, and the rows are weighed again, alike, where they are used.
    weights = stored(weighed(docs.select("doc_id", "text")).filter(may_stay).select("noisy_weight", "log_weight"), "weights")
    k = weights.filter(F.col("log_weight") >= F.lit(cut)).count()
    least = kth_largest(weights.select("noisy_weight"), k)
    kept = may_stay & (F.col("noisy_weight") >= F.lit(least))
    return weighed(packed(docs, "doc_id")).withColumn("kept", kept).drop("has_words")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classify(docs, table(spark, sf_dir, "labels")).select("doc_id", "log_weight", "noisy_weight", "kept")
