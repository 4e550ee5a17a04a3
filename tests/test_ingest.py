import time

import pytest
from pyspark.sql import functions as F

from caselake.sources import storage, tables
from caselake.streaming import ingest

VERSIONS = {"lote-a": "2025", "lote-b": "2026"}


def drop(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def run(spark, tmp_path, run_id, **options):
    query = ingest.ingest_csv_stream(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "chk"), run_id, VERSIONS,
        ingested_at=F.lit("2025-01-01").cast("timestamp"), **options)
    query.awaitTermination()
    return ingest.read_bronze(spark, str(tmp_path / "out"))


def test_incremental_files_new_columns_and_restart(spark, tmp_path):
    inbox = tmp_path / "in"
    drop(inbox, "lote-a.csv", 'NU_NOTIFIC;DT_NOTIFIC;"RAZÃO SOCIAL"\n1;2025-01-15;"x;y"\n2; 2025-01-16 ;\n1;2025-01-15;z\n')
    first = run(spark, tmp_path, "r1")
    rows = {r.nu_notific: r for r in first.collect()}
    assert set(rows) == {"1", "2"} and first.count() == 2
    assert rows["2"].dt_notific == "2025-01-16" and rows["2"].razao_social is None
    assert {r.versao_arquivo_origem for r in rows.values()} == {"2025"}
    assert {r.formato_data_origem for r in rows.values()} == {"ISO_DATE"}

    # second drop: another order, a new column, another date format; plus a file of unknown version
    drop(inbox, "lote-b.csv", "NOVA;DT_NOTIFIC;NU_NOTIFIC\nn;2026-01-15T00:00:00.000Z;3\n")
    drop(inbox, "resto.csv", "NU_NOTIFIC;DT_NOTIFIC\n4;\n")
    both = {r.nu_notific: r for r in run(spark, tmp_path, "r2").collect()}
    assert set(both) == {"1", "2", "3", "4"}
    assert both["3"].nova == "n" and both["3"].dt_notific.startswith("2026-01-15T") and both["1"].nova is None
    assert (both["3"].formato_data_origem, both["4"].formato_data_origem) == ("ISO_DATETIME_UTC", "DESCONHECIDO")
    assert both["4"].versao_arquivo_origem == "desconhecida" and both["4"].run_id == "r2"
    assert both["3"].nome_arquivo_origem == "lote-b.csv"

    # nothing new: a restart adds nothing
    assert run(spark, tmp_path, "r3").count() == 4


def test_rows_do_not_depend_on_the_batch_size(spark, tmp_path):
    for i in range(5):
        drop(tmp_path / "in", f"f{i}.csv", f"NU_NOTIFIC;DT_NOTIFIC;X\n{i};2025-01-15;{i}\n7;2025-01-16;{i % 2}\n;2025-01-17;\n")
    found = []
    for size, batches in ((1, 5), (2, 3), (256, 1)):
        query = ingest.ingest_csv_stream(
            spark, str(tmp_path / "in"), str(tmp_path / f"out{size}"), str(tmp_path / f"chk{size}"), "r", VERSIONS,
            ingested_at=F.lit("2025-01-01").cast("timestamp"), files_per_batch=size)
        query.awaitTermination()
        got = ingest.read_bronze(spark, str(tmp_path / f"out{size}"))
        found.append(sorted(map(repr, got.collect())))
        assert len(list((tmp_path / f"out{size}").glob("rows/stream=*/batch=*"))) == batches
    assert len(found[0]) == 7 and found[0] == found[1] == found[2]


def test_reading_never_shuffles_wide_rows(spark, tmp_path):
    for i in range(3):
        drop(tmp_path / "in", f"f{i}.csv", f"NU_NOTIFIC;DT_NOTIFIC;X\n{i};2025-01-15;{i}\n7;2025-01-16;{i}\n")
    got = run(spark, tmp_path, "r", files_per_batch=1)
    assert sorted((r.nu_notific, r.x) for r in got.collect()) == [("0", "0"), ("1", "1"), ("2", "2"), ("7", "0")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and "hashpartitioning" not in plan and "Window" not in plan


def test_a_later_batch_can_win_and_a_replay_changes_nothing(spark, tmp_path):
    """The earliest file by name stays, whichever batch brings it; each batch lists what loses by then."""
    for i, name in enumerate(("z", "m", "a")):
        drop(tmp_path / "in", f"{name}.csv", f"NU_NOTIFIC;DT_NOTIFIC;X\n7;2025-01-16;{name}\n{i};2025-01-16;{name}\n")
        got = run(spark, tmp_path, "r")
        assert [r.x for r in got.filter("nu_notific = '7'").collect()] == [name]
    assert got.count() == 4
    index = spark.read.parquet(*[str(p) for p in (tmp_path / "out" / "index").glob("run=*")])
    batches = sorted(r[0] for r in index.select(ingest.BATCH).distinct().collect())
    lost = [sorted(map(tuple, ingest.losing_rows(index.filter(F.col(ingest.BATCH) <= b), b).collect())) for b in batches]
    assert [len(x) for x in lost] == [0, 1, 2]
    other = run(spark, tmp_path, "s")  # nothing new
    assert other.count() == 4


def test_headers_of_many_files(spark, tmp_path):
    for i in range(256):
        drop(tmp_path / "in", f"f{i:03d}.csv", f"A;C{i % 3}\n1;2\n")
    paths = [str(p) for p in sorted((tmp_path / "in").glob("*.csv"))]
    start = time.perf_counter()
    heads = ingest._first_lines(spark, paths)
    assert time.perf_counter() - start < 3
    assert [heads[p] for p in paths[:3]] == ["A;C0", "A;C1", "A;C2"] and len(heads) == 256


def test_rows_without_identifier_are_deduplicated_by_content_key(spark, tmp_path):
    drop(tmp_path / "in", "f.csv", "NU_NOTIFIC;DT_NOTIFIC;CS_SEXO\n;2025-01-15;F\n;2025-01-15;F\n ;2025-01-15;M\n")
    assert run(spark, tmp_path, "r").count() == 2


def test_colliding_headers(spark, tmp_path):
    drop(tmp_path / "in", "f.csv", "NU_NOTIFIC;DT_NOTIFIC;a b;A-B;a.b\n1;x;p;q;r\n")
    row = run(spark, tmp_path, "r").first()
    assert (row.a_b, row.a_b_dup, row.a_b_dup2) == ("p", "q", "r")


def test_shared_dir_comes_from_the_session(spark):
    assert storage.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert storage.fresh_dir(spark, "x") != storage.fresh_dir(spark, "x")


def test_clustering_splits_a_hot_value(spark, tmp_path):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    path = str(tmp_path / "c")
    tables.compact_and_cluster(df, path, ["k"], files=6)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) < 1000 and len(sizes) == 6
    plain = str(tmp_path / "p")
    tables.compact_and_cluster(df, plain, files=2)
    assert len(list((tmp_path / "p").glob("*.parquet"))) == 2


def test_table_rebuilt_from_itself(spark, tmp_path):
    name = "tabela_teste"
    assert not tables.table_exists(spark, name)
    tables.overwrite(spark.range(3), name, str(tmp_path))
    tables.overwrite(tables.read_table(spark, name).withColumn("n", F.col("id") + 1), name, str(tmp_path))
    assert tables.table_exists(spark, name)
    assert sorted(r.n for r in tables.read_table(spark, name).collect()) == [1, 2, 3]
    spark.sql(f"DROP VIEW {name}")


def test_log_blocks_merge_schemas_and_repeat(spark, tmp_path):
    path = str(tmp_path / "log")
    for _ in range(2):  # a repeated run
        tables.append(spark.range(1), path, "a")
        tables.append(spark.range(1, 2).withColumn("x", F.lit("v")), path, "b")
    assert sorted((r.id, r.x or "") for r in tables.read_log(spark, path).collect()) == [(0, ""), (1, "v")]


def test_checked_write(spark, tmp_path):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    path = str(tmp_path / "w" / "one")
    whole = {"k": F.col("k").isNotNull()}
    assert tables.write_checked(df.filter("k is not null"), path, whole) == 1
    with pytest.raises(ValueError, match="k: 1 rows"):
        tables.write_checked(df, path, whole)
    with pytest.raises(ValueError, match="no rows"):
        tables.write_checked(df.filter("false"), path)
    assert [r.k for r in spark.read.parquet(path).collect()] == ["a"]  # a rejected write leaves what was there
    assert [p.name for p in (tmp_path / "w").iterdir()] == ["one"]


def test_readers_during_a_rebuild_find_the_table(spark, tmp_path):
    name = "tabela_lida"
    tables.overwrite(spark.range(3), name, str(tmp_path))
    before = tables.read_table(spark, name)
    tables.overwrite(spark.range(5), name, str(tmp_path))
    assert before.count() == 3 and tables.read_table(spark, name).count() == 5
    with pytest.raises(Exception):
        tables.overwrite(spark.range(3).select(F.raise_error(F.lit("no")).alias("x")), name, str(tmp_path))
    assert tables.read_table(spark, name).count() == 5
    spark.sql(f"DROP VIEW {name}")


def test_compaction_without_a_file_count(spark, tmp_path):
    path = str(tmp_path / "r")
    tables.compact_and_cluster(spark.range(0, 1000, 1, 20), path)
    assert spark.read.parquet(path).count() == 1000 and len(list((tmp_path / "r").glob("*.parquet"))) < 20
    clustered = str(tmp_path / "s")
    tables.compact_and_cluster(spark.range(1000), clustered, ["id"])
    assert spark.read.parquet(clustered).count() == 1000
