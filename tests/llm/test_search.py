"""Ranked search against a plain scorer and SQL, in one block and over many."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caselake.llm import registry, search
from caselake.llm.textnp import slices
from tests.compare import database, difference
from tests.llm import cases

ITEMS = "item_id long, text string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(documents, items, k):
    docs = [(i, collections.Counter(w), len(w)) for i, t in documents if (w := terms(t))]
    total = sum(n for _, _, n in docs)
    df = collections.Counter(t for _, c, _ in docs for t in c)
    wanted = collections.defaultdict(collections.Counter)
    for i, t in items:
        wanted[i].update(terms(t))
    out = []
    for item, times in wanted.items():
        scores = []
        for i, counts, n in docs:
            m = 100 - 25 + (25 * n * len(docs)) // total
            score = 0
            for t, x in times.items():
                if t in counts:
                    w = math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * df[t] + 1)))
                    score += x * w * ((1000000000 * counts[t]) // (1000 * counts[t] + 12 * m))
            if score > 0:
                scores.append((-score, i is not None, i, -score))
        for rank, (_, _, i, s) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1):
            out.append((item, rank, i, -s))
    return sorted(out, key=repr)


def found(spark, documents, items, k):
    docs = cases.documents(spark, documents)
    return cases.rows(search.search(docs, spark.createDataFrame(items, ITEMS), k), "item_id", "rank", "doc_id", "score")


def some_texts(seed, n):
    """Texts whose words follow a steep curve: some stand everywhere, most are rare."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    odds = [1 / (i + 1) for i in range(400)]
    return [" ".join(rng.choices(vocabulary, odds, k=rng.randrange(1, 60))) for _ in range(n)]


@pytest.mark.parametrize(("rows", "limit", "k"), [(4096, 1 << 18, 3), (7, 1 << 18, 3), (4096, 50, 20)])
def test_search_equals_brute_force(spark, monkeypatch, rows, limit, k):
    monkeypatch.setattr(search, "BLOCK_ROWS", rows)
    monkeypatch.setattr(search, "BLOCK_TERMS", limit)
    documents = list(enumerate(some_texts(1, 400)))
    documents += documents[:30] + [(1000 + i, t) for i, t in documents[30:60]]  # repeated rows and copies: ties
    items = list(enumerate(some_texts(2, 12))) + [(50, "w0 W0 w0"), (51, "absent"), (52, "w399 w398 w397")]
    assert found(spark, documents, items, k) == brute(documents, items, k)


def test_floors_shrink_accumulators_without_changing_results(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_ROWS", 50)
    documents = [(i, t) for i, t in enumerate(some_texts(3, 600))] + [(900 + i, "rare1 rare2 rare3 w0") for i in range(6)]
    items = [(1, "rare1 rare2 rare3 w0 w1")]
    sizes = []
    step = search.stored

    def watched(df, name, *folders):
        out = step(df, name, *folders)
        if name == "bundles-2":
            sizes.append(out.agg(F.sum(F.size("rows"))).first()[0])
        return out

    monkeypatch.setattr(search, "stored", watched)
    assert found(spark, documents, items, 5) == brute(documents, items, 5)
    assert sizes[0] < 60  # of the hundreds of documents that hold w0 or w1


def test_terms_of_a_slice():
    texts = ["A b-a", "", None, "É_é 9", "x" * 5, "," * 9]
    _, _, data, offsets = next(iter(slices(pa.array(texts))))
    _, counts, different, total = search.term_counts(data, offsets)
    assert total.tolist() == [len(terms(t)) for t in texts]
    assert different.tolist() == [len(set(terms(t))) for t in texts]
    assert np.array_equal(np.sort(counts), sorted(c for t in texts for c in collections.Counter(terms(t)).values()))


def test_odd_documents_and_items(spark):
    docs = [(r["doc_id"], r["text"]) for r in cases.odd(spark).collect()]
    docs += [(20, "term " * 500_000), (None, "one one"), (None, "no id here")]  # a text of 2.5 MB, null ids that tie
    items = [(1, "one id"), (1, "one here"), (2, None), (3, ""), (None, "ONE w5x5 é 你"), (4, "term"), (5, "..."), (6, "one " * 3000)]
    assert found(spark, docs, items, 20) == brute(docs, items, 20)
    plain = cases.odd(spark)
    wanted = spark.createDataFrame(items, ITEMS)
    assert cases.rows(search.search(cases.clashing(plain), wanted.withColumn("term", F.lit("own")))) == cases.rows(search.search(plain, wanted))
    assert search.search(cases.empty(spark), wanted).count() == 0
    assert search.search(plain, spark.createDataFrame([], ITEMS)).count() == 0


def test_query_equals_sql(spark, data_dir):
    name = "op12_search"
    assert difference(spark, database(data_dir), data_dir, registry.QUERIES[name], registry.ORACLES[name]) is None
