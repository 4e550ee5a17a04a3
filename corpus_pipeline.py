"""From raw documents to token ids in five stages; each works on all that the stage before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm import classifier, decontaminate, neardup, pieces, secrets
from caselake.llm.common import small_batches, stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling towards the labelled good texts keeps."""
    small_batches(spark)
    judged = classifier.classify(docs, table(spark, sf_dir, "labels"))
    return judged.filter("kept").select("_row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates (five-word shingles, similarity of 0.8 or more)."""
    small_batches(spark)
    return neardup.drop_near_duplicates(docs, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    small_batches(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets that are no widely copied examples masked; ``n_chars`` follows the text."""
    masked = secrets.mask_secrets(docs, *secrets.owners(docs))
    n_chars = F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", n_chars).select(*docs.columns)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of what they decode to."""
    small_batches(spark)
    back = pieces.round_trip(docs.select("doc_id", "lang", "source", "text"))
    return back.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("piece_encoding", piece_encoding),
]

#: The stages are not SQL: hashed models, searches over sketches, alignments and merges of pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the table ``documents``; each result is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
