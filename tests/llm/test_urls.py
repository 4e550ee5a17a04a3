"""URL rules against a search through all rules, and against SQL."""

import random

import pytest
from pyspark.sql import functions as F

from caselake.llm import registry, urls
from tests.compare import database, difference
from tests.llm import cases

SCHEMA = "page_id long, url string"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    tail = rest[end:]
    stop = min([tail.index(c) for c in "?#" if c in tail], default=len(tail))
    return rest[:end].translate(UPPER), tail[:stop]


def brute(rows, rules, default="allow"):
    out = []
    for i, url in rows:
        host, path = parts(url)
        best = (-1,)
        for rule, verdict in rules:
            h, _, p = rule.partition("/")
            h, p = h.translate(UPPER), "/" + p if "/" in rule else ""
            if h and (host == h or host.endswith("." + h)) and path.startswith(p):
                best = max(best, (len(rule), len(h), verdict == "block", rule, verdict))
        out.append((i, host, path, best[3] if len(best) > 1 else None, best[4] if len(best) > 1 else default))
    return sorted(out, key=repr)


def judged(spark, rows, rules):
    pages = spark.createDataFrame(rows, SCHEMA)
    return cases.rows(urls.judge_urls(pages, urls.rule_table(spark, rules)), "_row.page_id", "host", "path", "rule", "verdict")


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_rules_equal_brute_force(spark, broadcast):
    rng = random.Random(3)
    labels, dirs = ["a", "b", "net", "com", "x-y", ""], ["/", "/a/", "/a/b/", "/ab", "/a/b/c/d/e/f", "//", "/é/"]
    hosts = [".".join(rng.choices(labels, k=rng.randrange(1, 9))) for _ in range(300)]
    rows = [(i, rng.choice(["http://", "HTTPS://", "x", "a://b://"]) + h + rng.choice(dirs + [""]) + rng.choice(["", "z/q.html", "?a=/b/", "#/c"]))
            for i, h in enumerate(hosts)]
    rules = {rng.choice(hosts).split(".", rng.randrange(3))[-1] + rng.choice(dirs + ["", "/a/b/c/d/e/"]): rng.choice(["allow", "block"])
             for _ in range(150)}
    rules = sorted(rules.items()) + [("net/", "block"), ("net/", "allow"), ("/a/", "block"), ("NET/a/", "block")]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = judged(spark, rows, rules)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == brute(rows, rules)
    assert sum(r[3] is not None for r in got) > 50


def test_a_rule_ends_at_a_label_and_starts_the_path(spark):
    rows = [(1, "http://net/"), (2, "http://a.net/x"), (3, "http://anet/"), (4, "http://net"), (5, "http://A.Example.NET/en/1?x"),
            (6, "http://example.net/EN/"), (7, "http://example.net/en"), (8, "http://org/fr/")]
    got = {r[0]: r[3] for r in judged(spark, rows, urls.RULES)}
    assert got == {1: "net/", 2: "net/", 3: None, 4: None, 5: "example.net/en/", 6: "net/", 7: "net/", 8: "org/fr/"}


def test_an_address_of_any_length_has_a_bounded_number_of_expressions(spark):
    long = "http://" + "a." * 50_000 + "net/" + "b/" * 50_000
    pages = spark.createDataFrame([(1, long)], SCHEMA)
    host, path = urls._parts(F.col("url"))
    n = urls.expressions(pages.select(host.alias("host"), path.alias("path"), F.lit("").alias("address"))).count()
    assert n == urls.HOST_LEVELS * (urls.PATH_LEVELS + 1)
    assert judged(spark, [(1, long)], [("net/" + "b/" * 9, "block"), ("net/" + "b/" * 8 + "c", "block")])[0][3] == "net/" + "b/" * 9


def test_odd_pages(spark):
    rows = [(1, None), (1, None), (None, "http://a.net/"), (2, ""), (3, "://"), (4, "no scheme.net/"), (5, "http://"), (5, "http://?net/")]
    assert judged(spark, rows, urls.RULES) == brute(rows, urls.RULES)
    clash = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("own").alias(c) for c in
                                                              ("host", "path", "rule", "verdict", "address", "_row", "prefix", "digest")])
    out = urls.judge_urls(clash, urls.rule_table(spark))
    assert cases.rows(out, "_row.page_id", "host", "path", "rule", "verdict") == brute(rows, urls.RULES)
    assert {r["_row"]["host"] for r in out.collect()} == {"own"}
    assert urls.judge_urls(spark.createDataFrame([], SCHEMA), urls.rule_table(spark)).count() == 0
    nothing = spark.createDataFrame([], "rule string, verdict string")
    assert {r["verdict"] for r in urls.judge_urls(clash, nothing, default="block").collect()} == {"block"}


def test_query_equals_sql(spark, data_dir):
    name = "op13_urls"
    assert difference(spark, database(data_dir), data_dir, registry.QUERIES[name], registry.ORACLES[name]) is None
