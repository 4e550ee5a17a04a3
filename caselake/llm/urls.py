"""URL rules found by hashed host-suffix and path-prefix expressions.

1. Every rule (host, path) has one expression: at most the last ``HOST_LEVELS``
   labels of its host and the first ``PATH_LEVELS`` directories of its path.
2. Every different address (host and path of a URL) is expanded into its host
   suffixes times its path prefixes, ``HOST_LEVELS * (PATH_LEVELS + 1)``
   expressions at most, whatever the URL's length.
3. Expressions meet in an equi-join on the first ``PREFIX`` hex digits of their
   SHA-256. Candidates are confirmed by the full digest, then by the rule's whole
   host and path, so rules longer than their expression are exact as well.
4. The longest confirmed rule decides.

A URL's verdict depends on its address alone, so each different address is
expanded once, however many rows carry it, and the join back can be split. No
side is broadcast by force: Spark's own size check decides.

Defined results: the host stands between the first ``://`` and the next ``/``,
``?``, ``#`` or the end, in lower case (A to Z only); the path follows up to
``?``, ``#`` or the end; a null URL and one without ``://`` have both empty. A
rule fits its host and all hosts below it, if the path starts with its path. Of
several rules the one of most characters wins, then the one of the longer host,
then a block. Rules without a host fit nothing; without rules every URL gets
the default verdict. Repeated rows give a result each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.common import packed, table
from caselake.operators.joins import join_summary

HOST_LEVELS = 5
PATH_LEVELS = 4
PREFIX = 8
DEFAULT = "allow"
#: The rules of the registered query.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HOST, _PATH = "://([^/?#]*)", "://[^/?#]*([^?#]*)"


def _lower(column: Column) -> Column:
    return F.translate(column, _UPPER, _LOWER)


def _parts(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    return _lower(F.regexp_extract(url, _HOST, 1)), F.regexp_extract(url, _PATH, 1)


def _count(column: str, mark: str) -> str:
    return f"(length({column}) - length(replace({column}, '{mark}', '')))"


def _suffix(host: str, labels: str) -> str:
    return f"substring_index({host}, '.', -({labels}))"


def _directories(path: str, depth: str) -> str:
    """The first ``depth`` directories of ``path``, slashes included."""
    return f"CASE WHEN {depth} = 0 THEN '' ELSE substring_index({path}, '/', {depth}) || '/' END"


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """(rule, verdict) of pairs like ``("example.net/en/", "allow")``."""
    return spark.createDataFrame(list(rules), "rule string, verdict string")


def keyed_rules(rules: DataFrame) -> DataFrame:
    """(rule, verdict) with host, path, the digest of the rule's expression and the digest's prefix."""
    at = F.instr("rule", "/")
    parts = rules.select("rule", "verdict", _lower(F.substring_index("rule", "/", 1)).alias("rule_host"),
                         F.when(at > 0, F.expr("substr(rule, instr(rule, '/'))")).otherwise("").alias("rule_path"))
    host = _suffix("rule_host", f"least({HOST_LEVELS}, {_count('rule_host', '.')} + 1)")
    path = _directories("rule_path", f"least({PATH_LEVELS}, {_count('rule_path', '/')})")
    digest = F.sha2(F.expr(f"{host} || {path}"), 256)
    return parts.filter("rule_host != ''").withColumn("digest", digest).withColumn("prefix", F.left("digest", F.lit(PREFIX)))


def expressions(addresses: DataFrame) -> DataFrame:
    """(address, host, path, expression), a row for every host suffix and path prefix of an address."""
    hosts = f"transform(sequence(1, least({HOST_LEVELS}, {_count('host', '.')} + 1)), n -> {_suffix('host', 'n')})"
    paths = f"transform(sequence(0, least({PATH_LEVELS}, {_count('path', '/')})), n -> {_directories('path', 'n')})"
    pairs = "flatten(transform(_hosts, h -> transform(_paths, p -> h || p)))"
    return (addresses.withColumn("_hosts", F.expr(hosts)).withColumn("_paths", F.expr(paths))
            .select("address", "host", "path", F.explode(F.expr(pairs)).alias("expression")))


def decided(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """(address, rule, verdict) for the addresses (address, host, path) that a rule fits."""
    digest = F.sha2("expression", 256)
    candidates = (expressions(addresses).withColumn("prefix", F.left(digest, F.lit(PREFIX)))
                  .join(keyed_rules(rules), "prefix"))
    below = F.col("host").endswith(F.concat(F.lit("."), F.col("rule_host")))
    fits = ((digest == F.col("digest")) & ((F.col("host") == F.col("rule_host")) | below)
            & F.col("path").startswith(F.col("rule_path")))
    order = F.struct(F.length("rule").alias("n"), F.length("rule_host").alias("h"),
                     (F.col("verdict") == "block").alias("b"), F.col("rule").alias("rule"), F.col("verdict").alias("verdict"))
    best = candidates.filter(fits).groupBy("address").agg(F.max(order).alias("best"))
    return best.select("address", "best.rule", "best.verdict")


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """Every row of ``pages`` as ``_row`` beside host, path, rule and verdict of its URL."""
    host, path = _parts(F.col(f"`{url}`"))
    rows = packed(pages, host.alias("host"), path.alias("path"))
    # A host holds no slash and a path begins with one, so joined they stay distinct.
    rows = rows.withColumn("address", F.concat("host", "path"))
    found = decided(rows.select("address", "host", "path").distinct(), rules)
    joined = join_summary(rows, found, "address", "left")
    return joined.select("_row", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rule_table(spark)).select("_row.page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    def fits(rule: str) -> str:
        host, path = rule.split("/", 1)
        return f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')"

    longest = sorted(RULES, key=lambda r: -len(r[0]))
    names = " ".join(f"WHEN {fits(r)} THEN '{r}'" for r, _ in longest)
    verdicts = " ".join(f"WHEN '{r}' THEN '{v}'" for r, v in longest)
    return f"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{_HOST}', 1), '{_UPPER}', '{_LOWER}') AS host,
  regexp_extract(coalesce(url, ''), '{_PATH}', 1) AS path FROM pages),
r AS (SELECT *, CASE {names} END AS rule FROM u)
SELECT page_id, host, path, rule, CASE rule {verdicts} ELSE '{DEFAULT}' END AS verdict FROM r"""


OP13_SQL = _sql()
