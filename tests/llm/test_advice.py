"""Cases of the second review: what an operator left out before."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from caselake.llm import classifier, decontaminate, pieces, pii, secrets
from caselake.llm.common import table
from tests.llm import cases

# --- 9: classifier ---------------------------------------------------------------------------------


def test_toxic_texts_are_rejected_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    labels = table(spark, folder, "labels")
    docs = table(spark, folder, "documents").join(labels.select("doc_id").distinct(), "doc_id")
    held = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(2)) == 0
    kept = classifier.classify(docs, labels.filter(~held)).select("doc_id", "kept")
    n = {(r.toxic, r.kept): r["count"]
         for r in kept.join(labels.filter(held & (F.col("quality") == 1)), "doc_id").groupBy("toxic", "kept").count().collect()}
    print("held-out labels of quality 1, (toxic, kept):", n)
    assert n[1, False] >= 0.55 * (n[1, False] + n[1, True])
    assert n[0, True] >= 0.96 * (n[0, True] + n[0, False])


def test_toxic_words_weigh_the_same_in_long_texts(spark):
    clean = [(i, " ".join(f"w{(i * 7 + j) % 211}" for j in range(40 + 30 * (i % 9))), 0) for i in range(120)]
    toxic = [(200 + i, clean[i][1] + " vile slur " + clean[i][1], 1) for i in range(60)]
    docs = spark.createDataFrame(clean + toxic, "doc_id long, text string, toxic int")
    labels = docs.filter("doc_id % 4 != 0").select("doc_id", F.lit(1).alias("quality"), "toxic")
    kept = {r.doc_id: r.kept for r in classifier.classify(docs.drop("toxic"), labels).collect()}
    assert not any(kept[i] for i, _, _ in toxic)
    assert sum(kept[i] for i, _, _ in clean) >= 110


# --- 6: personal data ------------------------------------------------------------------------------

PHONES = ("+1-202-555-0143", "+1 202 555 0143", "+12025550143", "(202) 555-0143", "202-555-0143", "202.555.0143", "1-202-555-0143",
          "+44 20 7946 0958", "+44 (0)20 7946 0958", "+33 1 23 45 67 89", "+49-30-123-4567", "020 7946 0958", "+1 (017) 555-7713")
DATES = ("12/31/2024", "31/12/2024", "31.12.2024", "12.31.2024", "31-12-2024", "12-31-2024", "2024/12/31", "2024.12.31", "2024-02-29",
         "03/04/2024", "04.03.2024", "29/02/2024")
CARDS = ("3782-822463-10005", "3782 822463 10005", "4111111111111111", "4111-1111-1111-1111")


def test_common_layouts_get_pseudonyms_and_go_back(spark):
    wanted = {v: kind for kind, values in (("phone", PHONES), ("date", DATES), ("card", CARDS)) for v in values}
    text = "; ".join(f"see No.{v} now" if k == "card" else f"see {v}, now" for v, k in wanted.items())
    row = pii.pseudonymize_text(cases.documents(spark, [(1, text)]), "k").first()
    assert (row.n_phone, row.n_date, row.n_card) == (len(PHONES), len(DATES), len(CARDS))
    assert not any(v in row.text for v in wanted)
    assert re.sub("[0-9]", "9", row.text) == re.sub("[0-9]", "9", text)
    df = spark.createDataFrame([(v,) for v in wanted], "v string").withColumn("kind", pii.kind_of(F.col("v")))
    df = df.withColumn("new", pii.pseudonym(F.col("v"), F.col("kind"), "k")).withColumn("kind2", pii.kind_of(F.col("new")))
    rows = df.withColumn("back", pii.pseudonym(F.col("new"), F.col("kind"), "k", back=True)).collect()
    for r in rows:
        assert r.kind == wanted[r.v] == r.kind2 and r.back == r.v and re.fullmatch(pii.KINDS[r.kind], r.new), r


def test_dates_of_a_layout_are_permuted(spark):
    days = spark.range(0, 73_049, 7).select(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")).alias("d"))
    both = days.select(F.date_format("d", "MM/dd/yyyy").alias("v")).union(days.select(F.date_format("d", "dd/MM/yyyy"))).distinct()
    new = both.select("v", pii.pseudonym(F.col("v"), pii.kind_of(F.col("v")), "k").alias("new"))
    new = new.withColumn("back", pii.pseudonym(F.col("new"), pii.kind_of(F.col("new")), "k", back=True))
    n, different, returned = new.agg(F.count("*"), F.count_distinct("new"), F.count_if(F.col("back") == F.col("v"))).first()
    assert n == different == returned


def test_dates_without_zeros_and_what_is_no_number_of_these(spark):
    text = "1/5/2024 13/13/2024 2024/13/01 32.01.2024 1.2.3.4 10.1.2.3.4 123-45-678 102-555-0143 1.4111111111111111 v3.10.2024.1"
    row = pii.pseudonymize_text(cases.documents(spark, [(1, text)]), "k").first()
    assert (row.n_date, row.n_phone, row.n_card, row.n_ipv4) == (1, 0, 0, 1)
    old, new = text.split(), row.text.split()
    assert old[1:4] == new[1:4] and old[5:] == new[5:]
    assert re.fullmatch("[1-9][0-9]?/[1-9][0-9]?/[12][0-9]{3}", new[0])


# --- 2: secrets ------------------------------------------------------------------------------------

def test_weak_values_of_few_owners_are_secrets(spark):
    own, two, many, filler = "Tr0ub4dor9", "aabbaabbaabb", "hunter2hunter2", "your-key-here"
    rows = [(1, f'password = "{own}"', "a"), (2, f"token={two}", "a"), (3, f"token={two}", "b"), (4, f"api_key={filler}", "a")]
    rows += [(10 + i, f"secret={many}", f"src{i}") for i in range(3)] + [(20, "token=xxxxxxxxxx", "a")]
    docs = cases.documents(spark, rows)
    verdicts = {r.hash: r.verdict for r in secrets.ownership(secrets.scan(docs, *secrets.owners(docs))).collect()}
    of = lambda s: verdicts[hashlib.sha256(s.encode()).hexdigest()]
    assert [of(v) for v in (own, two, many, filler, "xxxxxxxxxx")] == ["weak", "weak", "example", "example", "example"]
    masked = {r.doc_id: r.text for r in secrets.mask_secrets(docs, *secrets.owners(docs)).collect()}
    assert masked[1] == 'password = "[secret]"' and masked[2] == masked[3] == "token=[secret]"
    assert all(masked[i] == t for i, t, _ in rows[3:])


# --- 5: pieces -------------------------------------------------------------------------------------

def test_viterbi_of_a_unigram_file_with_fractional_scores(tmp_path):
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    rng = random.Random(3)
    model = proto.ModelProto()
    model.trainer_spec.model_type, model.trainer_spec.byte_fallback = 1, True
    model.normalizer_spec.name, model.normalizer_spec.remove_extra_whitespaces = "identity", False
    for name, kind in (("<unk>", 2), ("<s>", 3), ("</s>", 3)):
        model.pieces.add(piece=name, score=0, type=kind)
    for b in range(256):
        model.pieces.add(piece=f"<0x{b:02X}>", score=0, type=6)
    score = {}
    for n in (1, 2, 3, 4):
        for word in map("".join, itertools.product("ab", repeat=n)):
            for piece in (word, pieces.MARK + word):
                score[piece] = float(np.float32(-n * 2.5 - rng.random()))
    score[pieces.MARK] = -3.25
    for piece, value in score.items():
        model.pieces.add(piece=piece, score=value, type=1)
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    v = pieces.load(str(path))
    encoder = pieces.Encoder(v)
    near = 0
    for word in ("".join(rng.choices("ab", k=rng.randrange(1, 14))) for _ in range(300)):
        raw = word.encode()
        ids, _ = encoder.slice(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        whole, sums = pieces.MARK + word, [0.0]
        for e in range(1, len(whole) + 1):
            sums.append(max(sums[s] + score[whole[s:e]] for s in range(e) if whole[s:e] in score))
        got = [model.pieces[i].piece for i in ids]
        assert "".join(got) == whole and abs(sum(score[p] for p in got) - sums[-1]) < 1e-9, word
        near += len(got) > 1
    assert near > 200


# --- 8: decontamination ----------------------------------------------------------------------------

def test_parts_of_long_items_are_found(spark):
    rng = random.Random(19)
    noise = lambda n: " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(n))
    item, other = noise(220), noise(150)
    half = len(item) // 2
    docs = [(1, noise(20) + " " + item[:half] + " " + noise(20)), (2, noise(9) + " " + item[half:]), (3, item[len(item) // 5:]),
            (4, noise(30) + " " + item), (5, noise(300)), (6, noise(5) + " " + item[137:137 + 300] + " " + noise(5))]
    edited = list(item[half:])
    for at in range(30, len(edited), 60):
        edited[at] = "z"
    docs += [(7, noise(10) + " " + "".join(edited)), (8, item[:90] + " " + noise(60))]
    benchmark = spark.createDataFrame([(1, item), (2, other)], "item_id long, text string")
    found = decontaminate.with_matches(cases.documents(spark, docs), benchmark)
    got = {r.doc_id: [(m.item_id, m.distance) for m in r.benchmark_matches] for r in found.collect()}
    assert all(got[i] == [(1, 0)] for i in (1, 2, 3, 4, 6)) and [m[0] for m in got[7]] == [1]
    assert got[5] == got[8] == []
    left = decontaminate.drop_contaminated(cases.documents(spark, docs), benchmark)
    assert cases.rows(left, "doc_id") == [(5,), (8,)]
