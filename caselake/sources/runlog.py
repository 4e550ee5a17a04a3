"""Quality log stored by run, with a summary that finds a run.

``<path>/rows/block=<block>/run_id=<run>/`` holds a run's log rows,
``<path>/runs/block=<block>/`` one short row per run and dimension. A consumer
picks its run by the summary and then reads that run's folder alone. A block of
the same name (a repeated run) is replaced; a block shows once its summary is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake.operators import dedup

RUNS = "run_id string, dimensao_dmbok string, dh_execucao timestamp, regras long"


def append_runs(log: DataFrame, path: str, block: str) -> None:
    """Stores the log rows of one or more runs as a block."""
    spark, root = log.sparkSession, path.rstrip("/")
    rows = f"{root}/rows/block={block}"
    # all rules of a run go to one file: a run has one row per rule
    log.repartition("run_id").write.mode("overwrite").partitionBy("run_id").parquet(rows)
    narrow = "run_id string, dimensao_dmbok string, dh_execucao timestamp"
    summary = spark.read.schema(narrow).parquet(rows).groupBy("run_id", "dimensao_dmbok").agg(
        F.max("dh_execucao").alias("dh_execucao"), F.count(F.lit(1)).alias("regras"))
    summary.coalesce(1).write.mode("overwrite").parquet(f"{root}/runs/block={block}")


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """The summary of all blocks: run_id, dimensao_dmbok, dh_execucao, regras."""
    return spark.read.schema(RUNS).parquet(f"{path.rstrip('/')}/runs").select("run_id", "dimensao_dmbok", "dh_execucao", "regras")


def read_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Log rows of the blocks whose summary is written."""
    given = T.StructType([f for f in schema.fields if f.name != "run_id"]).add("block", "string").add("run_id", "string")
    rows = spark.read.schema(given).parquet(f"{path.rstrip('/')}/rows")
    done = spark.read.schema("block string").parquet(f"{path.rstrip('/')}/runs").select("block").distinct()
    return rows.join(F.broadcast(done), "block", "left_semi").select(*schema.names)


def latest_complete_run(spark: SparkSession, path: str, schema: T.StructType, min_dimensions: int | None = 5) -> DataFrame:
    """Rows of the newest run that covers enough dimensions, found by the summary."""
    return dedup.latest_complete_run(read_rows(spark, path, schema), min_dimensions=min_dimensions, runs=read_runs(spark, path))
