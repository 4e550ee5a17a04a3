"""Small tables for the edge cases every operator has to handle."""

from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return.
CLASHES = ("kept _row _text n size class label text_hash slot shard bucket token_ids decoded r u at mark kind many "
           "mixed candidates found log_weight noisy_weight has_words benchmark_matches n_email n_card virtual_slot "
           "_id _hash _found spans node value terms _owner _repository").split()


def documents(spark, rows):
    """Rows of (doc_id, text[, source[, lang]])."""
    full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def odd(spark):
    """Nulls in any column, empty and blank texts, repeated rows, an id with two texts, a long text."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(20_000))
    rows = [(None, None, None, None), (1, None, "a", "en"), (2, "", "a", None), (3, " \t\n ", None, "en"), (4, "one", "a", "en"),
            (4, "one", "a", "en"), (5, "same id", "a", "en"), (5, "other text", "b", "en"), (6, long, "a", "en"),
            (7, long, "b", "de"), (None, "no id here", "a", "en"), (8, "é 你 🙂 ▁ ß", "a", "en"), (-1, "minus one", "a", "en")]
    return documents(spark, rows)


def clashing(docs):
    return docs.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
