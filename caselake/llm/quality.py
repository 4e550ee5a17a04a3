"""Quality rules with thresholds that follow the data, from DataFrame functions only.

Per document: words, characters in words, symbols, repeated lines and words in
repeated three-word windows. The fixed base rule drops short texts and texts
that mostly repeat. All further cutoffs come from mergeable quantile sketches
per language and source: histograms whose bucket of a value keeps its leading
six binary digits (relative error below 1/32, exact below 64). Sketches of
parts of a corpus merge by adding counts, which is what the partial aggregation
does. A cutoff is the upper quartile plus ``SPREAD`` times the distance of the
quartiles (the lower quartile minus as much, for a lower cutoff). Where the
quartiles lie closer than ``LEAST_SPREAD``, as in groups whose texts all have
rate 0, that distance takes their place. A group of fewer than ``LEAST_GROUP``
texts is too small to judge by: the merged sketch of its language takes its
place, or that of the whole corpus if the language is as small.

Defined results: a null text has no words and fails the base rule; null
languages or sources form groups of their own; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caselake.llm.common import SPACES, split_words, stored, table, text_or_empty

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SPREAD = 3
#: Least distance of the quartiles of a measure, in its units; measures with a lower cutoff as well.
LEAST_SPREAD = {"symbol_rate": 30, "dup_line_rate": 100, "repeat_rate": 100, "word_length": 60}
LOWER = ("word_length",)
#: Texts with words that a group needs for cutoffs of its own.
LEAST_GROUP = 50


def base_measures(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    text = F.col("_text")
    has_word = F.filter(F.split(text, "\n"), lambda s: F.length(F.translate(s, SPACES, "")) > 0)
    window = F.transform(
        "_words", lambda w, i: F.struct(
            F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"), i.alias("i")))
    same = F.transform(F.filter("_windows", lambda x, i: (F.get("_windows", i - 1)["h"] == x["h"])
                                | (F.get("_windows", i + 1)["h"] == x["h"])), lambda x: x["i"])
    covered = F.aggregate(
        "_repeats", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda acc, p: F.struct((acc["n"] + p + 3 - F.greatest(acc["end"], p)).alias("n"), (p + 3).alias("end")),
        lambda acc: acc["n"])
    return (
        docs.withColumn("_text", text_or_empty())
        .withColumn("_words", split_words(text)).withColumn("_lines", has_word)
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.translate(text, SPACES, "")).cast("long"))
        .withColumn("n_symbols", (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"))
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("_windows", F.sort_array(F.slice(window, F.lit(1), F.greatest(F.size("_words") - 2, F.lit(0)))))
        .withColumn("_repeats", F.sort_array(same))
        .withColumn("n_repeat_words", covered)
        .drop("_text", "_words", "_lines", "_windows", "_repeats"))


def with_rates(measured: DataFrame) -> DataFrame:
    """Adds the measures that have adaptive cutoffs; whole numbers, NULL without words."""
    return measured.selectExpr(
        "*",
        "100 * word_chars DIV nullif(n_words, 0) AS word_length",
        "1000 * n_symbols DIV nullif(n_words, 0) AS symbol_rate",
        "1000 * n_dup_lines DIV nullif(n_lines, 0) AS dup_line_rate",
        "1000 * n_repeat_words DIV nullif(n_words, 0) AS repeat_rate")


def bucket(value: str) -> Column:
    """Lower edge of the sketch bucket of a whole number: its leading six binary digits."""
    shift = f"greatest(0, length(bin({value})) - 6)"
    return F.expr(f"shiftleft(shiftright({value}, {shift}), {shift})")


def sketches(rated: DataFrame, groups: list[str]) -> DataFrame:
    """Mergeable quantile sketches: groups, measure, bucket, n. Add the counts of two to merge them."""
    entries = F.array(*[F.struct(F.lit(m).alias("measure"), bucket(m).alias("bucket")) for m in LEAST_SPREAD])
    return (rated.select(*groups, F.explode(entries).alias("e")).filter("e.bucket IS NOT NULL")
            .groupBy(*groups, F.col("e.measure").alias("measure"), F.col("e.bucket").alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def cutoffs(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """Per group: its size (texts with words) and the upper and lower cutoffs, one column each."""
    merged = sketch.groupBy(*groups, "measure", "bucket").agg(F.sum("n").alias("n"))
    per = Window.partitionBy(*groups, "measure")
    up_to = per.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.withColumn("below", F.sum("n").over(up_to)).withColumn("total", F.sum("n").over(per))
    quartiles = ranked.groupBy(*groups, "measure").agg(
        F.min(F.when(4 * F.col("below") >= F.col("total"), F.col("bucket"))).alias("q1"),
        F.min(F.when(4 * F.col("below") >= 3 * F.col("total"), F.col("bucket"))).alias("q3"),
        F.max("total").alias("total"))
    columns = [F.max("total").alias("size")]
    for m, least in LEAST_SPREAD.items():
        reach = SPREAD * F.greatest(F.col("q3") - F.col("q1"), F.lit(least))
        columns.append(F.max(F.when(F.col("measure") == m, F.col("q3") + reach)).alias(f"max_{m}"))
        if m in LOWER:
            columns.append(F.max(F.when(F.col("measure") == m, F.col("q1") - reach)).alias(f"min_{m}"))
    return quartiles.groupBy(*groups).agg(*columns)


def applied_cutoffs(sketch: DataFrame, groups: list[str]) -> DataFrame:
    """Per group the cutoffs that apply: its own, those of its first key (the language), or those of all texts.

    A row for each language and one for the corpus; all are far smaller than the sketches.
    """
    names = [f"max_{m}" for m in LEAST_SPREAD] + [f"min_{m}" for m in LOWER]
    first = groups[0]
    corpus = cutoffs(sketch.withColumn("_all", F.lit(0)), ["_all"]).agg(F.struct(*[F.max(c).alias(c) for c in names])).scalar()
    wider = cutoffs(sketch, [first]).select(
        F.col(first).alias("_first"), F.when(F.col("size") >= LEAST_GROUP, F.struct(*names)).alias("_wider"))
    own = cutoffs(sketch, groups).join(wider, F.col(first).eqNullSafe(F.col("_first")))
    chosen = F.when(F.col("size") >= LEAST_GROUP, F.struct(*names)).otherwise(F.coalesce("_wider", corpus))
    return own.select(*groups, chosen.alias("_c")).select(*groups, "_c.*")


def judge(docs: DataFrame, groups: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """doc_id, groups, base measures, base_failed, cutoffs that apply and kept.

    Texts are read once; the measures, a few numbers per document, are stored
    and serve both the sketches and the joined filter. A hot group's join is
    split by the adaptive skew join.
    """
    keys = list(groups)
    rated = stored(with_rates(base_measures(docs.select("doc_id", *keys, "text"))).drop("text"), "quality")
    limits = applied_cutoffs(stored(sketches(rated, keys), "quantile-sketches"), keys)
    limits = limits.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in limits.columns if c not in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    # Quartiles are edges of buckets, so the edge of the value's own bucket is compared.
    inside = [bucket(m) <= F.col(f"max_{m}") for m in LEAST_SPREAD] + [bucket(m) >= F.col(f"min_{m}") for m in LOWER]
    within = F.coalesce(reduce(lambda a, b: a & b, inside), F.lit(False))
    return (rated.join(limits, same, "left").withColumn("base_failed", base_failed)
            .withColumn("kept", ~F.col("base_failed") & within))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    space = r"[\x20\x09-\x0D]"
    quartile = "min(bucket) FILTER (WHERE 4 * below >= {0} * total)"
    shift = "greatest(0, length(bin(v)) - 6)"
    names = [f"max_{m}" for m in LEAST_SPREAD] + [f"min_{m}" for m in LOWER]

    def limits(by: str) -> str:
        """Cutoffs of the sketches merged by some of the group's columns."""
        keys = f"{by}, " if by else ""
        reach = f"{SPREAD} * greatest(q3 - q1, {{0}})"
        columns = [f"max(q3 + {reach.format(v)}) FILTER (WHERE measure = '{m}') AS max_{m}" for m, v in LEAST_SPREAD.items()]
        columns += [f"max(q1 - {reach.format(LEAST_SPREAD[m])}) FILTER (WHERE measure = '{m}') AS min_{m}" for m in LOWER]
        return (f"SELECT {keys}max(total) AS size, {', '.join(columns)} FROM (SELECT {keys}measure, {quartile.format(1)} AS q1, "
                f"{quartile.format(3)} AS q3, max(total) AS total FROM (SELECT *, sum(n) OVER (PARTITION BY {keys}measure ORDER BY bucket) "
                f"AS below, sum(n) OVER (PARTITION BY {keys}measure) AS total FROM (SELECT {keys}measure, bucket, sum(n) AS n FROM sk GROUP BY ALL)) "
                f"GROUP BY {keys}measure) {'GROUP BY ' + by if by else ''}")

    applied = ", ".join(f"CASE WHEN g.size >= {LEAST_GROUP} THEN g.{c} WHEN l.size >= {LEAST_GROUP} THEN l.{c} ELSE c.{c} END AS {c}" for c in names)
    rows = " UNION ALL ".join(f"SELECT rid, lang, source, '{m}' AS measure, {m} AS v FROM rated" for m in LEAST_SPREAD)

    def edge(m: str) -> str:
        return f"((CAST({m} AS BIGINT) >> greatest(0, length(bin({m})) - 6)) << greatest(0, length(bin({m})) - 6))"

    inside = " AND ".join([f"{edge(m)} <= max_{m}" for m in LEAST_SPREAD] + [f"{edge(m)} >= min_{m}" for m in LOWER])
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
      FROM (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d)),
tri AS (SELECT rid, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS t
        FROM w WINDOW o AS (PARTITION BY rid ORDER BY i)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, t) AS n FROM tri WHERE t IS NOT NULL) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM dup, (VALUES (0), (1), (2)) AS s(k) GROUP BY rid),
ln AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
          FROM ln WHERE regexp_replace(line, '{space}', '', 'g') <> '' GROUP BY rid),
words AS (SELECT rid, count(*) AS n FROM w GROUP BY rid),
base AS (SELECT d.rid, doc_id, lang, source, coalesce(words.n, 0) AS n_words,
           length(regexp_replace(text, '{space}', '', 'g')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
         FROM d LEFT JOIN words USING (rid) LEFT JOIN lines USING (rid) LEFT JOIN rep USING (rid)),
rated AS (SELECT *, 100 * word_chars // nullif(n_words, 0) AS word_length, 1000 * n_symbols // nullif(n_words, 0) AS symbol_rate,
            1000 * n_dup_lines // nullif(n_lines, 0) AS dup_line_rate, 1000 * n_repeat_words // nullif(n_words, 0) AS repeat_rate FROM base),
v AS ({rows}),
sk AS (SELECT lang, source, measure, (v >> {shift}) << {shift} AS bucket, count(*) AS n
       FROM (SELECT * REPLACE (CAST(v AS BIGINT) AS v) FROM v WHERE v IS NOT NULL) GROUP BY ALL),
lim AS (SELECT g.lang, g.source, {applied} FROM ({limits("lang, source")}) g
  JOIN ({limits("lang")}) l ON l.lang IS NOT DISTINCT FROM g.lang, ({limits("")}) c)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, n_dup_lines, n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND coalesce({inside}, false) AS kept
FROM rated r LEFT JOIN lim ON r.lang IS NOT DISTINCT FROM lim.lang AND r.source IS NOT DISTINCT FROM lim.source"""


OP4_SQL = _sql()
