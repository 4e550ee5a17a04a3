"""Secret scans with corpus-wide ownership, from DataFrame functions only.

Candidates are found by three patterns in whole texts. A hash stands for each
candidate's value; per hash the corpus is asked how many distinct owners and
repositories hold it. Values that many owners copy are published examples, as
are stated placeholders (words of ``PLACEHOLDER``, one character repeated);
values of one owner that look random are taken as live credentials, values that
few owners hold and that look weak are weak secrets. All but examples are masked.
Wherever a text names the value of such a secret again, outside the place where
a pattern found it, the place is a span of the kind ``owned``.

Counts of distinct owners are built in three levels of partial aggregation, so
an example that a third of all rows carry reaches its final task as one row per
map task. Clear values never leave the task that read them; only hashes are
written.

Defined results: a null text is empty; null owners or repositories count as one
owner "" or repository ""; repeated rows give repeated result rows; an empty
table gives no rows. Positions count code points, the end is exclusive. Further
places of a value are its leftmost non-overlapping ones; looking for them costs
a text's length times its different values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm.common import packed, stored, table, text_or_empty

#: kind, pattern, group of the value, least characters of the value; in the order of listing.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = (("assign", ASSIGN, 1, 8), ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32))
#: What a text must contain for the pattern to be tried in full.
GATES = {"assign": ASSIGN, "access": "AKIA[A-Z0-9]{12}", "hex": "[0-9a-f]{32}"}
#: Owners from which on a value counts as a copied example.
EXAMPLE_OWNERS = 3
#: A live-looking value has so many characters and distinct characters at least.
LIVE_LENGTH, LIVE_DISTINCT = 12, 6
PLACEHOLDER = r"(?i)example|changeme|placeholder|your|dummy|xxxx|0123456789|1234567890"
VERDICTS = ("live", "shared", "weak", "example")
MASK = "[secret]"
_BLOCK = 256


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _blocks(steps: Column) -> Column:
    """Sums of every ``_BLOCK`` steps, which keep running sums over many of them cheap."""
    return F.transform(F.sequence(F.lit(0), F.floor(F.size(steps) / _BLOCK).cast("int")),
                       lambda b: _total(F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK))))


def _running(steps: Column, blocks: Column, i: Column) -> Column:
    """Sum of the steps up to the one of index ``i``."""
    block = F.floor(i / _BLOCK).cast("int")
    return _total(F.slice(blocks, F.lit(1), block)) + _total(F.slice(steps, block * _BLOCK + 1, i % _BLOCK + 1))


def _spans(df: DataFrame, kind: str, rank: int, pattern: str, group: int, least: int) -> DataFrame:
    """Adds the array ``_kind`` of (start, rank, end, kind, value) of the matches that pass.

    The pieces between matches and the matches themselves give the positions as
    running sums, taken in two levels so that many matches in one text stay cheap.
    """
    text, found = F.col("_text"), f"_{kind}_found"
    none = F.array().cast("array<string>")
    hit = text.rlike(GATES[kind])
    df = df.withColumn(found, F.when(hit, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn(f"_{kind}_value", F.when(hit, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(none))
    steps = F.transform(F.split(text, pattern, -1), lambda piece, i: F.length(piece) + F.coalesce(F.length(F.get(found, i)), F.lit(0)))
    df = df.withColumn(f"_{kind}_step", F.when(F.size(found) > 0, steps).otherwise(F.array().cast("array<int>")))
    df = df.withColumn(f"_{kind}_block", _blocks(F.col(f"_{kind}_step")))

    def span(whole: Column, i: Column) -> Column:
        end = _running(F.col(f"_{kind}_step"), F.col(f"_{kind}_block"), i)
        return F.struct((end - F.length(whole)).alias("start"), F.lit(rank).alias("rank"), end.alias("end"),
                        F.lit(kind).alias("kind"), F.get(f"_{kind}_value", i).alias("value"))

    passing = F.filter(F.transform(found, span), lambda s: F.length(s["value"]) >= least)
    return df.withColumn(f"_{kind}", passing).drop(found, f"_{kind}_value", f"_{kind}_step", f"_{kind}_block")


def find(docs: DataFrame) -> DataFrame:
    """Adds ``candidates``: array of (start, rank, end, kind, value) by start, then kind."""
    df = docs.withColumn("_text", text_or_empty())
    for rank, (kind, pattern, group, least) in enumerate(PATTERNS):
        df = _spans(df, kind, rank, pattern, group, least)
    own = [f"_{kind}" for kind, *_ in PATTERNS]
    return df.withColumn("candidates", F.sort_array(F.concat(*own))).drop("_text", *own)


def is_placeholder(value: Column) -> Column:
    return value.rlike(PLACEHOLDER) | (F.size(F.array_distinct(F.split(value, ""))) == 1)


def looks_live(value: Column) -> Column:
    distinct = F.size(F.array_distinct(F.split(value, "")))
    return (F.length(value) >= LIVE_LENGTH) & (distinct >= LIVE_DISTINCT) & ~value.rlike(PLACEHOLDER)


def _place(start: Column, end: Column) -> Column:
    """Start and end in one number, so that sets of places are sets of numbers."""
    return F.shiftleft(start.cast("long"), 32) + end


def further_places() -> Column:
    """Array of (hash, places) of a row's candidate values: where each stands beside the places the patterns found."""
    text, candidates = text_or_empty(), F.col("candidates")
    known = F.transform(candidates, lambda s: _place(s["end"] - F.length(s["value"]), s["end"]))

    def places(value: Column) -> Column:
        pieces = F.split(text, F.concat(F.lit(r"\Q"), value, F.lit(r"\E")), -1)
        steps = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda piece: F.length(piece) + F.length(value))

        def place(steps: Column, blocks: Column, i: Column) -> Column:
            return _let(_running(steps, blocks, i), lambda end: _place(end - F.length(value), end))

        return _let(steps, lambda steps: _let(_blocks(steps), lambda blocks: F.transform(
            steps, lambda _, i: place(steps, blocks, i))))

    values = F.array_distinct(F.transform(candidates, lambda s: s["value"]))
    found = _let(known, lambda known: F.transform(values, lambda v: F.struct(
        F.sha2(v, 256).alias("hash"), F.array_except(places(v), known).alias("places"))))
    return F.filter(found, lambda f: F.size(f["places"]) > 0)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, owner: Column, repository: Column, *more: Column) -> DataFrame:
    """Per document, stored once: keys, owner, repository, counts, spans, hashed candidates and ``more``."""
    def digest(kind: str) -> Column:
        return F.size(F.filter("candidates", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    hashed = F.transform("candidates", lambda s: F.struct(F.sha2(s["value"], 256).alias("hash"), looks_live(s["value"]).alias("live"), is_placeholder(s["value"]).alias("placeholder")))
    rows = docs.select("doc_id", "text", F.coalesce(owner, F.lit("")).alias("owner"),
                       F.coalesce(repository, F.lit("")).alias("repository"))
    return stored(find(rows).select(
        "doc_id", F.xxhash64(text_or_empty()).alias("text_hash"), "owner", "repository",
        *[digest(kind) for kind, *_ in PATTERNS], _joined(F.col("candidates")).alias("spans"), hashed.alias("found"), *more), "secret-scan")


def ownership(scanned: DataFrame) -> DataFrame:
    """One row per value hash: occurrences, n_owners, n_repositories, verdict."""
    rows = scanned.select("owner", "repository", F.explode("found").alias("f")).select("owner", "repository", "f.hash", "f.live", "f.placeholder")
    per_repository = rows.groupBy("hash", "live", "placeholder", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    per_owner = per_repository.groupBy("hash", "live", "placeholder", "owner").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("r"))
    counts = per_owner.groupBy("hash", "live", "placeholder").agg(
        F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("n_owners"), F.sum("r").alias("n_repositories"))
    verdict = (F.when(F.col("placeholder") | (F.col("n_owners") >= EXAMPLE_OWNERS), "example")
               .when(~F.col("live"), "weak")
               .when(F.col("n_owners") == 1, "live").otherwise("shared"))
    return counts.withColumn("verdict", verdict)


def by_document(scanned: DataFrame) -> DataFrame:
    """Per document with candidates (doc_id, text_hash): counts by verdict and the hashes to mask."""
    found = (scanned.select("doc_id", "text_hash", F.explode("found").alias("f"))
             .groupBy("doc_id", "text_hash", F.col("f.hash").alias("hash")).agg(F.count(F.lit(1)).alias("n")))
    judged = found.join(ownership(scanned).select("hash", "verdict", "n_owners"), "hash")
    return judged.groupBy("doc_id", "text_hash").agg(
        *[F.count(F.when(F.col("verdict") == v, 1)).alias(f"n_{v}") for v in VERDICTS],
        F.max("n_owners").alias("most_owners"),
        F.collect_set(F.when(F.col("verdict") != "example", F.col("hash"))).alias("secret_hashes"))


def _same(a: str = "a", b: str = "b") -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_hash") == F.col(f"{b}.text_hash"))


def mask_secrets(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """``docs`` with every secret that is no copied example replaced by ``MASK``; no row is dropped.

    Only documents that hold a candidate are joined with the verdicts.
    """
    names = docs.columns
    rows = packed(docs, "doc_id", "text", owner.alias("_owner"), repository.alias("_repository"))
    verdicts = by_document(scan(rows, F.col("_owner"), F.col("_repository"))).select("doc_id", "text_hash", "secret_hashes")
    holds = F.lit(False)
    for gate in GATES.values():
        holds = holds | text_or_empty().rlike(gate)
    rest = rows.filter(~holds)
    held = find(rows.filter(holds)).withColumn("text_hash", F.xxhash64(text_or_empty()))
    secrets = F.transform(F.filter("candidates", lambda s: F.array_contains("secret_hashes", F.sha2(s["value"], 256))),
                          lambda s: F.struct((-F.length(s["value"])).alias("n"), s["value"].alias("value")))
    clean = F.aggregate(F.sort_array(F.array_distinct(secrets)), F.col("text"),
                        lambda text, s: F.replace(text, s["value"], F.lit(MASK)))
    masked = (held.alias("a").join(verdicts.alias("b"), _same(), "left")
              .select("a.*", F.coalesce("b.secret_hashes", F.array().cast("array<string>")).alias("secret_hashes"))
              .withColumn("text", F.when(F.col("text").isNotNull(), clean)))
    both = rest.select("_row", "text").unionByName(masked.select("_row", "text"))
    return both.select(*[F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in names])


def owners(docs: DataFrame) -> tuple[Column, Column]:
    """Owner and repository of the test table: the source, and the source's texts in one language."""
    return F.col("source"), F.concat_ws("/", "source", "lang")


def all_spans(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """Per document: doc_id, counts by kind and verdict, ``most_owners``, base spans and ``spans``, ``owned`` ones included."""
    base = F.transform("candidates", lambda s: s.dropFields("value")).alias("base")
    scanned = scan(docs, owner, repository, base, further_places().alias("further"))
    none, no_hash = F.lit(0).cast("long"), F.array().cast("array<string>")
    owned = F.flatten(F.transform(
        F.filter("further", lambda f: F.array_contains(F.coalesce("secret_hashes", no_hash), f["hash"])), lambda f: f["places"]))
    owned = F.transform(F.array_distinct(owned), lambda p: F.struct(
        F.shiftright(p, 32).cast("int").alias("start"), F.lit(len(PATTERNS)).alias("rank"),
        p.bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("end"), F.lit("owned").alias("kind")))
    return scanned.alias("a").join(by_document(scanned).alias("b"), _same(), "left").select(
        "a.doc_id", *[f"n_{kind}" for kind, *_ in PATTERNS], F.size(owned).cast("long").alias("n_owned"),
        F.col("spans").alias("base_spans"), _joined(F.sort_array(F.concat("base", owned))).alias("spans"),
        *[F.coalesce(f"n_{v}", none).alias(f"n_{v}") for v in VERDICTS], F.coalesce("most_owners", none).alias("most_owners"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return all_spans(docs, *owners(docs)).withColumn("base_sha256", F.sha2("base_spans", 256)).drop("base_spans")


def _sql() -> str:
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    found = " UNION ALL ".join(
        f"SELECT rid, {rank} AS rank, '{kind}' AS kind, {least} AS least, string_split_regex(text, {text(pattern)}) AS gaps, "
        f"regexp_extract_all(text, {text(pattern)}) AS whole, regexp_extract_all(text, {text(pattern)}, {group}) AS value FROM d"
        for rank, (kind, pattern, group, least) in enumerate(PATTERNS))
    counts = ", ".join(f"count(*) FILTER (kind = '{kind}') AS n_{kind}" for kind, *_ in PATTERNS)
    verdicts = ", ".join(f"count(DISTINCT hash) FILTER (verdict = '{v}') AS n_{v}" for v in VERDICTS)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, concat_ws('/', source, lang) AS repository, coalesce(text, '') AS text FROM documents),
f AS ({found}),
m AS (SELECT *, unnest(generate_series(1, len(whole))) AS i FROM f WHERE len(whole) > 0),
sp AS (SELECT rid, rank, kind, value[i] AS value, length(whole[i]) AS n,
         list_sum(list_transform(gaps[1:i], lambda x: length(x)))
         + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS s
       FROM m WHERE length(value[i]) >= least),
c AS (SELECT sp.*, sha256(value) AS hash, source, repository,
        length(value) >= {LIVE_LENGTH} AND len(list_distinct(string_split(value, ''))) >= {LIVE_DISTINCT}
        AND NOT regexp_matches(value, {text(PLACEHOLDER)}) AS live,
        regexp_matches(value, {text(PLACEHOLDER)}) OR len(list_distinct(string_split(value, ''))) = 1 AS placeholder
      FROM sp JOIN d USING (rid)),
o AS (SELECT hash, count(DISTINCT source) AS n_owners,
        CASE WHEN any_value(placeholder) OR count(DISTINCT source) >= {EXAMPLE_OWNERS} THEN 'example'
             WHEN NOT any_value(live) THEN 'weak'
             WHEN count(DISTINCT source) = 1 THEN 'live' ELSE 'shared' END AS verdict FROM c GROUP BY 1),
g AS (SELECT rid, {counts}, string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT), ',' ORDER BY s, rank) AS spans,
        {verdicts}, max(n_owners) AS most_owners FROM c JOIN o USING (hash) GROUP BY rid),
v AS (SELECT DISTINCT rid, value, string_split(text, value) AS gaps FROM c JOIN o USING (hash) JOIN d USING (rid) WHERE verdict <> 'example'),
w AS (SELECT *, unnest(generate_series(1, len(gaps) - 1)) AS i FROM v WHERE len(gaps) > 1),
p AS (SELECT rid, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + (i - 1) * length(value) AS BIGINT) AS s, length(value) AS n FROM w),
x AS (SELECT DISTINCT rid, s, s + n AS e FROM p ANTI JOIN
        (SELECT rid, CAST(c.s + c.n AS BIGINT) - length(value) AS s, length(value) AS n FROM c) AS k USING (rid, s, n)),
t AS (SELECT rid, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans, count(*) FILTER (kind = 'owned') AS n_owned
      FROM (SELECT rid, rank, kind, CAST(s AS BIGINT) AS s, CAST(s + n AS BIGINT) AS e FROM c
            UNION ALL SELECT rid, {len(PATTERNS)}, 'owned', s, e FROM x) GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{x}, 0) AS n_{x}" for x in [*(kind for kind, *_ in PATTERNS), *VERDICTS, "owned"])},
  coalesce(most_owners, 0) AS most_owners, coalesce(t.spans, '') AS spans, sha256(coalesce(g.spans, '')) AS base_sha256
FROM d LEFT JOIN g USING (rid) LEFT JOIN t USING (rid)"""


OP2_SQL = _sql()
