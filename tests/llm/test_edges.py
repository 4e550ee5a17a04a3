"""Nulls, empty tables, long texts, repeated rows and clashing column names for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from caselake.llm import chat, classifier, decontaminate, neardup, pieces, pii, quality, secrets, sharding, suffixes
from tests.llm import cases

LABELS = "doc_id long, quality int, toxic int"
ITEMS = "item_id long, text string"


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (6, 1, 0), (5, 0, 0), (5, 1, 0), (99, 1, 0), (None, 1, 0), (8, None, None)], LABELS)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, "w0x0 w1x1 w2x2 w3x3 w4x4 w5x5"), (1, "w0x0 w1x1 w2x2 w3x3 w4x4 w5x5"), (2, None), (3, ""), (None, "tiny")], ITEMS)


def operators(labels, items):
    """Name and function from documents to a result with one row per document."""
    return {
        "suffixes": lambda d: suffixes.remove_repeats(d),
        "secrets": lambda d: secrets.mask_secrets(d, *secrets.owners(d)),
        "sharding": lambda d: sharding.shard_documents(d, shards=4, slots=64),
        "quality": lambda d: quality.judge(d),
        "pieces": lambda d: pieces.decode_documents(pieces.encode_documents(d)),
        "pii": lambda d: pii.pseudonymize_text(d, "k"),
        "decontaminate": lambda d: decontaminate.with_matches(d, items),
        "classifier": lambda d: classifier.classify(d, labels),
        "neardup": lambda d: neardup.near_duplicates(d),
    }


NAMES = "suffixes secrets sharding quality pieces pii decontaminate classifier neardup".split()


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_give_a_row_each(spark, labels, items, name):
    docs = cases.odd(spark)
    operator = operators(labels, items)[name]
    plain = operator(docs)
    assert plain.count() == docs.count()
    clash = operator(cases.clashing(docs))
    own = [c for c in ("component_id", "kept", "n_removed", "text", "n_words", "size", "n_email", "decoded_sha256") if c in plain.columns]
    assert cases.rows(clash, *own) == cases.rows(plain, *own)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table_gives_no_rows(spark, labels, items, name):
    assert operators(labels, items)[name](cases.empty(spark)).count() == 0


def test_operators_without_labels_or_items(spark):
    docs = cases.odd(spark)
    nothing = spark.createDataFrame([], LABELS)
    kept = classifier.classify(docs, nothing).groupBy("kept").count().collect()
    assert {r["kept"]: r["count"] for r in kept} == {True: 9, False: 4}  # without words: rejected
    assert decontaminate.drop_contaminated(docs, spark.createDataFrame([], ITEMS)).count() == docs.count()


def test_stages_keep_all_columns_and_values(spark, tmp_path, labels, items):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = cases.clashing(cases.odd(spark))
    given = {(r["doc_id"], r["text"]): r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        for r in out.collect():
            assert r == given[r["doc_id"], r["text"]], name
        assert stage(spark, docs.filter(F.lit(False)), str(tmp_path)).count() == 0
    name, stage = corpus_pipeline.STAGES[-1]
    assert stage(spark, docs, str(tmp_path)).count() == docs.count()


def test_chat_edges(spark):
    schema = "conv_id long, turn long, role string, text string, valid string"
    rows = [(1, 0, "user", None, "x"), (1, 0, "user", None, "x"), (None, 0, None, "a", "x"), (2, None, "tool]: ", "x]: \\", "x"), (2, 1, "assistant", "", "x")]
    out = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(spark.createDataFrame(rows, schema))).collect()}
    assert {k: (r["n_turns"], r["valid"]) for k, r in out.items()} == {1: (2, False), None: (1, False), 2: (2, False)}
    assert chat.digests(chat.format_conversations(spark.createDataFrame([], schema))).count() == 0
