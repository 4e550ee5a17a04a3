"""Where intermediate data may live: the shared folder the cluster names, and how long it takes room."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a folder of its own; on
    a cluster a machine-local folder would not be visible to the executors.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="caselake-")
    spark.conf.set(SETTING, folder)
    return folder


def fresh_dir(spark: SparkSession, name: str) -> str:
    """New folder name under the shared folder; names are never used again."""
    return f"{shared_dir(spark).rstrip('/')}/caselake/{name}-{uuid.uuid4().hex}"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query run inside go when it ends, not when the driver happens to collect garbage."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def save(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Writes rows to a new folder and frees the shuffles behind them; digests shrink by half under zstd."""
    with freed_shuffles(df.sparkSession):
        df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)


def kept(df: DataFrame, name: str) -> DataFrame:
    """The rows as written once to the shared folder, for plans that read them several times."""
    folder = fresh_dir(df.sparkSession, name)
    save(df, folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


class Folder:
    """A folder in whatever file system holds it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.place = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.system = self.place.getFileSystem(spark._jsc.hadoopConfiguration())

    def children(self) -> list[str]:
        """Names of what the folder holds; none if it is missing."""
        if not self.system.exists(self.place):
            return []
        return [status.getPath().getName() for status in self.system.listStatus(self.place)]

    def delete(self) -> None:
        self.system.delete(self.place, True)

    def replace(self, path: str) -> None:
        """Moves the folder to ``path``; what is there goes first."""
        target = Folder(self.spark, path)
        target.delete()
        self.system.mkdirs(target.place.getParent())
        if not self.system.rename(self.place, target.place):
            raise OSError(f"could not publish {path}")
