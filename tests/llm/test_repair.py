"""Conversation repair against a plain search over all edits, in one block and over many."""

import hashlib
import heapq
import itertools
import random

import pytest
from pyspark.sql import functions as F

from caselake.llm import registry, repair
from tests.compare import database, difference
from tests.llm import cases

SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\x0c\r"


def brute_edits(symbols):
    """Cheapest (cost, audit) by best-first search over edits; ends when the cheapest goal is popped."""
    queue = [(0, "", 0, "")]
    done = set()
    while queue:
        cost, audit, i, last = heapq.heappop(queue)
        if i == len(symbols) and last in ("", "a"):
            return cost, audit
        if (i, last) in done:
            continue
        done.add((i, last))
        after = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        for want in after:
            if want != "s":
                heapq.heappush(queue, (cost + 2, audit + "I", i, want))
            if i < len(symbols) and symbols[i] != "-":
                late = symbols[i].isupper()
                if symbols[i].lower() == want:
                    heapq.heappush(queue, (cost + late, audit + "K", i + 1, want))
                elif want != "s":
                    heapq.heappush(queue, (cost + late + 2, audit + "R", i + 1, want))
        if i < len(symbols):
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, last))


def brute(rows):
    out = []
    for conv in dict.fromkeys(r[0] for r in rows):
        turns = sorted(((t is not None, t or 0), " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv)
        symbols, counts, seen, kinds = [], dict.fromkeys(("blank", "duplicate", "truncated"), 0), set(), []
        for _, role, text in turns:
            bare = text.rstrip(SPACES)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            first = role[:1] if role[:1] in ("s", "u", "a") else "x"
            kinds.append(first)
            symbols.append("-" if fault in ("blank", "duplicate") else first.upper() if fault else first)
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
        days = [t for (given, t), _, _ in turns if given]
        gaps = max(days) - min(days) + 1 - len(set(days)) if days else 0
        cost, audit = brute_edits(symbols)
        lines, i, last = [], 0, ""
        for letter in audit:
            want = "assistant" if last == "u" else "user"
            if letter == "I":
                line = (want, "")
            else:
                line = (turns[i][1] if letter == "K" else want, turns[i][2])
                i += 1
                if letter == "D":
                    continue
            lines.append(":".join(line))
            last = line[0][0]
        out.append((conv, len(turns), gaps, *counts.values(), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest() if lines else None))
    return sorted(out, key=repr)


def repaired(spark, rows, partitions=None):
    df = spark.createDataFrame(rows, SCHEMA)
    if partitions:
        df = df.repartition(partitions)
    found = repair.audits(df).cache()
    lines = repair.digests(repair.repaired_turns(df, found)).withColumnRenamed("conv_id", "c")
    joined = found.join(lines, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    return cases.rows(joined, "conv_id", "n_turns", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha256")


@pytest.mark.parametrize("length", [1, 2, 3, 4])
def test_every_short_conversation_equals_the_search(length):
    for symbols in itertools.product("suaxSUA-", repeat=length):
        found = repair.table_of(symbols, True, True)
        assert min(found[0, q] for q in repair.ACCEPTED if (0, q) in found) == brute_edits(symbols), symbols


@pytest.mark.parametrize("block", [1, 2, 5, 32])
def test_blocks_join_to_the_same_audit(monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(60):
        symbols = rng.choices("suaxSUA-", weights=[1, 6, 6, 1, 1, 1, 1, 2], k=rng.randrange(1, 40))
        cut = rng.randrange(len(symbols) + 1)
        whole = repair.table_of(symbols, True, True)
        halves = repair.join_tables(repair.table_of(symbols[:cut], True, False), repair.table_of(symbols[cut:], False, True))
        for found in (whole, halves):
            assert min(found[0, q] for q in repair.ACCEPTED if (0, q) in found) == brute_edits(symbols), symbols


def test_an_alignment_over_its_bound_is_none():
    assert repair.align("uaua", "uaua", 0) == (0, "KKKK")
    assert repair.align("uau", "uaua", 1) is None
    assert repair.align("uau", "uaua", 2) == (2, "KKKI")
    assert repair.align("-ua", "ua", 2) is None


def some_rows(seed, conversations=40, longest=12):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "", " \t", "Sure? ", "é.", "x" * 50 + "."]
    rows = []
    for c in range(conversations):
        for t in range(rng.randrange(1, longest)):
            rows.append((c, t + rng.randrange(2) * 7, rng.choice(["system", "user", "user", "assistant", "assistant", "tool", ""]),
                         rng.choice(texts) + rng.choice(["", f"{rng.random()}."])))
    return rows


def distinct_turns(rows):
    """Rows whose order within a conversation is given by turn alone."""
    return list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())


def test_conversations_equal_brute_force(spark):
    rows = distinct_turns(some_rows(1))
    rows += [r for r in rows if r[0] % 5 == 0]  # repeated rows
    assert repaired(spark, rows) == brute(rows)


def test_a_conversation_over_many_partitions(spark):
    rng = random.Random(4)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["a.", "b", f"t{t}.", f"t{t}.", f"t{t}"])) for t in range(0, 3000, 2)]
    rows += [(c, t, "user", "Hi.") for c in (6, 8) for t in range(3)]
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep the partitions as they are
    try:
        runs = repair._judged(repair._turns(spark.createDataFrame(rows, SCHEMA))).repartitionByRange(6, *repair.ORDER)
        runs = runs.sortWithinPartitions(*repair.ORDER).mapInArrow(repair._runs, repair.RUNS)
        assert runs.filter("conv_id = 7").count() > 2
        assert repaired(spark, rows, 5) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_odd_conversations(spark):
    rows = [(None, None, None, None), (None, 3, "user", "a."), (1, None, "user", "b."), (1, 5, "assistant", "c"), (1, 9, "", "d."),
            (2, None, None, ""), (2, None, None, ""), (3, 0, "system", "e."), (4, 0, "user", "f" * 2_000_000), (5, 1, "user", "g."), (5, 1, "user", "g.")]
    assert repaired(spark, rows) == brute(rows)
    assert repair.audits(spark.createDataFrame([], SCHEMA)).count() == 0
    ids = spark.createDataFrame([(9,), (9,), (None,), (1,)], "conv_id long")
    extra = repair.audits(spark.createDataFrame(rows, SCHEMA), ids).filter("conv_id = 9").collect()
    assert [tuple(r) for r in extra] == [(9, 0, 0, 0, 0, 0, 0, 0, "")]
    clash = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("own").alias(c) for c in ("key", "code", "audit", "n", "blank", "position")])
    assert cases.rows(repair.audits(clash)) == cases.rows(repair.audits(spark.createDataFrame(rows, SCHEMA)))


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(40) for t in range(5)]
    import zlib
    expected = []
    for c, t, role, text in rows:
        way = zlib.crc32(f"{c}:{t}".encode()) % 20
        if way == 0:
            continue
        row = (c, t, "user" if way == 4 else role, {1: "", 2: "One Two Three"}.get(way, text))
        expected += [row] * (2 if way == 3 else 1)
    assert cases.rows(repair.damaged(spark.createDataFrame(rows, SCHEMA))) == sorted(expected, key=repr)


def test_query_equals_sql(spark, data_dir):
    name = "op11_repair"
    assert difference(spark, database(data_dir), data_dir, registry.QUERIES[name], registry.ORACLES[name]) is None
