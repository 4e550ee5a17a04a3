"""One text of over 2 MB, longer than the pieces in which operators read texts, for the operators that cut them."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from caselake.llm import decontaminate, neardup, pieces, pii, quality, secrets, suffixes
from tests.llm import cases

ITEM = "the quick assay of forty amber lanterns beside a frozen harbour found nothing but old rope and seven coins"


@pytest.fixture(scope="module")
def long():
    """Words without a repeated five-word run; the end holds a benchmark item, a secret and an address."""
    rng = random.Random(3)
    body = " ".join(f"{rng.choice('bcdfg')}o{i:x}" for i in range(300_000))
    assert len(body) > suffixes.CHUNK
    return f"{body} {ITEM} password = Tr0ub4dor9Xq77 mail a.b@c.example.org"


@pytest.fixture(scope="module")
def docs(spark, long):
    return cases.documents(spark, [(1, long), (2, long), (3, "short"), (4, long[-900:])]).repartition(2).persist()


def test_repeats_across_a_cut(spark):
    rng = random.Random(5)
    passage = "".join(rng.choice("mnop") for _ in range(700))
    text = "".join(rng.choice("0123456789abcdef") for _ in range(suffixes.CHUNK + 300_000))
    at = [100_000, suffixes.CHUNK - 350]
    one = text[:at[0]] + "G" + passage + "J" + text[at[0]:at[1] - 702] + "H" + passage + "K" + text[at[1] - 702:]
    assert one.index("H" + passage) < suffixes.CHUNK < one.index(passage + "K") + 700
    two = "I" + passage + "L"
    kept = one.replace(passage, "")
    got = cases.rows(suffixes.remove_repeats(cases.documents(spark, [(1, one), (2, two)])),
                     "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == [(1, len(one), 1400, 2, hashlib.sha256(kept.encode()).hexdigest()),
                   (2, 702, 700, 1, hashlib.sha256(b"IL").hexdigest())]


def test_near_duplicates_of_a_long_text(docs, long):
    words = long.lower().split()
    shingles = len({tuple(words[i:i + 5]) for i in range(len(words) - 4)})
    got = cases.rows(neardup.near_duplicates(docs).filter("doc_id < 4"), "doc_id", "n_shingles", "component_id")
    assert got == [(1, shingles, 1), (2, shingles, 1), (3, 1, 3)]


def test_ends_of_long_texts_are_read(spark, docs, long):
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    found = decontaminate.with_matches(docs, items).filter(F.size("benchmark_matches") > 0)
    assert cases.rows(found, "doc_id") == [(1,), (2,), (4,)]
    masked = {r.doc_id: r.text for r in secrets.mask_secrets(docs, *secrets.owners(docs)).collect()}
    assert masked[3] == "short" and all(len(masked[i]) > suffixes.CHUNK for i in (1, 2))
    swapped = {r.doc_id: r for r in pii.pseudonymize_text(docs, "k").collect()}
    assert [swapped[i].n_email for i in (1, 2, 3, 4)] == [1, 1, 0, 1]
    assert swapped[1].text == swapped[2].text and swapped[1].text.startswith(long[:-len("a.b@c.example.org")])
    assert {r.doc_id: r.n_words for r in quality.judge(docs).collect()}[1] == len(long.split())


def test_pieces_of_a_long_text_come_back(docs, long):
    got = {r.doc_id: r.decoded_sha256 for r in pieces.round_trip(docs).filter("doc_id IN (1, 3)").collect()}
    assert got == {1: hashlib.sha256(long.encode()).hexdigest(), 3: hashlib.sha256(b"short").hexdigest()}
