"""Incremental ingestion of delimited case files.

The stream discovers files (paths only, contents unread) and remembers them in
its checkpoint; each micro-batch then reads its files with the batch CSV
reader, once per header layout, so columns are matched by name and may appear,
move or disappear between files. A micro-batch owns its folders, which a replay
overwrites, so the sink is idempotent. Rows are written once as they come; the
format label of a file is taken from the one date column of what was written.

Duplicates are found when they arrive, on a narrow index: run, natural key,
place in the settling order and place in the table of every row. A batch compares
its keys with the run's index and lists the rows that lose; readers leave those
out by an anti join with the list, so wide rows are never sorted or shuffled.
Streams of one run write one after the other.
"""

from __future__ import annotations

import csv
import hashlib
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from caselake.catalogs import FALLBACK_KEY_COLUMNS, LINEAGE_COLUMNS, SOURCE_SYSTEM, UNKNOWN_VERSION
from caselake.functions import as_col, dates, keys
from caselake.functions.names import sanitize_names
from caselake.operators.joins import join_summary

CSV_OPTIONS = {
    "sep": ";", "header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "mode": "PERMISSIVE",
}
PATH = "_caminho_arquivo"
#: Place of a row in the raw table, and what duplicates are found and settled by.
BATCH, LINE, KEY, CONTENT = "_lote", "_linha", "_chave", "_conteudo"
_SETTLED = ("nome_arquivo_origem", "versao_arquivo_origem", CONTENT, "dh_ingestao_bronze", BATCH, LINE)
_LISTING = "path string, modificationTime timestamp, length long, content binary"


def _first_line(spark: SparkSession, path: str) -> str:
    """First line of one file, read through the file system Spark uses for it."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()


def _first_lines(spark: SparkSession, paths: list[str], readers: int = 32) -> dict[str, str]:
    """Header line of each file of one micro-batch, read side by side; an empty file has none."""
    with ThreadPoolExecutor(min(readers, len(paths))) as pool:
        heads = pool.map(lambda p: _first_line(spark, p), paths)
        return {p: h for p, h in zip(paths, heads) if h is not None}


def header_names(header: str, sep: str = ";") -> list[str]:
    """Clean, unique column names of a header line."""
    cells = next(csv.reader([header.lstrip("\ufeff")], delimiter=sep))
    return sanitize_names(c.strip() for c in cells)


def read_files(
    spark: SparkSession, paths: list[str], options: Mapping[str, str] = CSV_OPTIONS
) -> DataFrame | None:
    """All rows of the files as text, with clean column names, file name and path.

    Files are grouped by header; layouts are united by name, absent columns read NULL.
    """
    layouts: dict[str, list[str]] = {}
    for path, header in sorted(_first_lines(spark, paths).items()):
        layouts.setdefault(header, []).append(path)
    frames = []
    for header, files in layouts.items():
        names = header_names(header, options["sep"])
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
        raw = spark.read.options(**options).schema(schema).csv(files)
        located = raw.select("*", "_metadata.file_name", "_metadata.file_path")
        frames.append(located.toDF(*names, "nome_arquivo_origem", PATH))
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def file_version(path: Column | str, versions: Mapping[str, str]) -> Column:
    """Version of the first listed part the file's path contains."""
    path = as_col(path)
    return F.coalesce(*[F.when(path.contains(part), F.lit(v)) for part, v in versions.items()],
                      F.lit(UNKNOWN_VERSION))


def detect_date_format(
    df: DataFrame, column: str = "dt_notific", file: str = PATH
) -> DataFrame:
    """Date format label per file, from all its values."""
    value = F.col(column)
    seen = df.groupBy(file).agg(
        F.bool_or(value.isNotNull() & (value != "")).alias("_any"),
        F.bool_or(value.contains("T")).alias("_time"),
    )
    return seen.select(file, dates.date_format_label("_any", "_time").alias("formato_data_origem"))


def add_file_lineage(
    df: DataFrame, run_id: str, ingested_at: Column, versions: Mapping[str, str],
    system: str = SOURCE_SYSTEM,
) -> DataFrame:
    """Stamp ingest time, version, run and system; the file's name and path are there already."""
    return df.withColumns(
        {
            "dh_ingestao_bronze": ingested_at,
            "run_id": F.lit(run_id),
            "nome_sistema_origem": F.lit(system),
            "versao_arquivo_origem": file_version(PATH, versions),
        }
    )


def mark_rows(df: DataFrame, batch: str, fallback: Iterable[str] = FALLBACK_KEY_COLUMNS) -> DataFrame:
    """Adds each row's natural key, content hash and place. Columns a layout lacks count as empty, so layouts agree."""
    content = sorted(c for c in df.columns if c not in (*LINEAGE_COLUMNS, PATH))  # the hash passes over absent columns
    parts = [F.col(c) if c in df.columns else F.lit(None).cast("string") for c in fallback]
    identifier = F.col("nu_notific") if "nu_notific" in df.columns else F.lit(None).cast("string")
    return df.withColumns({
        KEY: keys.natural_key(identifier, parts), CONTENT: F.xxhash64(*content), BATCH: F.lit(batch),
        LINE: F.monotonically_increasing_id(),
    })


def losing_rows(index: DataFrame, batch: str) -> DataFrame:
    """Places of all rows but one per natural key, for the keys of a batch; ``index`` holds one run.

    The row that stays is the first by file, version and content. Neither the
    order of files nor the limits of micro-batches take part.
    """
    arrived = index.filter(F.col(BATCH) == batch).select(KEY)
    rivals = index.join(arrived, KEY, "left_semi")
    place = F.struct(*_SETTLED)
    first = rivals.groupBy(KEY).agg(F.min(place).alias("_first"))
    return join_summary(rivals, first, KEY).filter(place != F.col("_first")).select(BATCH, LINE)


def ingest_csv_stream(
    spark: SparkSession,
    directory: str,
    sink: str,
    checkpoint: str,
    run_id: str,
    versions: Mapping[str, str],
    system: str = SOURCE_SYSTEM,
    ingested_at: Column | None = None,
    files_per_batch: int = 256,
    pattern: str = "*.csv",
) -> StreamingQuery:
    """Ingest all files not seen before, then stop (available-now trigger).

    Returns the running query; ``awaitTermination()`` waits for it.
    """
    stream_key = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    run_folder = f"run={hashlib.sha256(run_id.encode()).hexdigest()[:12]}"
    stamp = F.current_timestamp() if ingested_at is None else ingested_at

    def process_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        paths = [r.path for r in batch.collect()]  # at most files_per_batch paths
        files = read_files(session, paths) if paths else None
        if files is None:
            return
        own, name = f"stream={stream_key}/batch={batch_id}", f"{stream_key}/{batch_id}"
        rows = mark_rows(add_file_lineage(files, run_id, stamp, versions, system), name)
        rows.write.mode("overwrite").parquet(f"{sink}/rows/{own}")
        written = session.read.parquet(f"{sink}/rows/{own}")  # of which a few columns are read
        detect_date_format(written).write.mode("overwrite").parquet(f"{sink}/formats/{own}")
        index = f"{sink}/index/{run_folder}"
        written.select(KEY, *_SETTLED).write.mode("overwrite").parquet(f"{index}/{own}")
        found = session.read.schema(written.select(KEY, *_SETTLED).schema).parquet(index)
        losing_rows(found, name).write.mode("overwrite").parquet(f"{sink}/losers/{own}")

    discovered = (
        spark.readStream.format("binaryFile").schema(_LISTING)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(directory)
        .select("path")
    )
    return (
        discovered.writeStream.foreachBatch(process_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_bronze(
    spark: SparkSession, sink: str, schema: T.StructType | None = None, run_id: str | None = None
) -> DataFrame:
    """The raw table: columns of all layouts, one row per run and natural key.

    Rows that a batch found to lose are left out by an anti join, over all
    batches of a run, so the rows do not depend on how many files a batch took.
    ``run_id`` reads one run. Without a schema the columns are merged from the
    files; pass the known one to plan large tables without reading their footers.
    """
    if schema:
        marks = [T.StructField(c, T.LongType() if c == LINE else T.StringType()) for c in (PATH, BATCH, LINE)]
        schema = T.StructType([*schema.fields, *[m for m in marks if m.name not in schema.names]])
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")
    rows = reader.parquet(f"{sink}/rows")
    if run_id is not None:
        rows = rows.filter(F.col("run_id") == run_id)
    formats = spark.read.parquet(f"{sink}/formats")
    losers = spark.read.schema(f"{BATCH} string, {LINE} long").parquet(f"{sink}/losers").select(BATCH, LINE)
    kept = rows.join(losers, [BATCH, LINE], "left_anti").join(formats, ["stream", "batch", PATH], "left")
    kept = kept.drop("stream", "batch", PATH, BATCH, LINE, KEY, CONTENT)
    missing = [c for c in LINEAGE_COLUMNS if c not in kept.columns]
    if missing:
        raise ValueError(f"mandatory columns missing: {missing}")
    return kept
