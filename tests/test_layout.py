"""What stored layouts save: files and runs skipped, months rewritten."""

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from caselake.operators import dedup, metrics, quality
from caselake.sources import runlog, series, tables

LOG = "run_id string, dimensao_dmbok string, dh_execucao timestamp, regra_qualidade string"
SUMS = {"total": "1", "peso": "n"}


def surviving(folder, column, value):
    """Files whose smallest and largest value of ``column`` leave room for ``value``."""
    n = 0
    for file in folder.glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        n += any(s.min <= value <= s.max for s in stats)
    return n


@pytest.mark.parametrize("kind", ["int", "string"])
def test_interleaved_files_are_skipped_by_every_column(spark, tmp_path, kind):
    df = spark.range(40_000).select(
        F.pmod(F.xxhash64("id"), F.lit(5000)).cast(kind).alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5000)).cast(kind).alias("b"), "id")
    count = {}
    for interleave in (False, True):
        path = tmp_path / f"{kind}{interleave}"
        tables.compact_and_cluster(df, str(path), ["a", "b"], files=64, interleave=interleave)
        value = 2500 if kind == "int" else "2500"
        count[interleave] = surviving(path, "a", value), surviving(path, "b", value)
        assert spark.read.parquet(str(path)).count() == 40_000
    assert count[False][1] == 64 and 3 * count[True][1] <= count[False][1] and 3 * count[True][0] <= 64


def test_interleaved_key_of_odd_columns(spark, tmp_path):
    df = spark.createDataFrame([(None, "x", 1.5), (None, None, None), (dt.date(2020, 1, 1), "x", 2.5)] * 5, "d date, s string, f double")
    tables.compact_and_cluster(df, str(tmp_path / "t"), ["d", "s", "f"], files=3, interleave=True)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 15
    tables.compact_and_cluster(df.limit(0), str(tmp_path / "e"), ["d", "s"], interleave=True)
    assert spark.read.schema(df.schema).parquet(str(tmp_path / "e")).count() == 0


def test_best_run_is_found_without_a_window(spark):
    rows = [("a", d, 3) for d in range(5)] + [("b", d % 4, 9) for d in range(8)] + [("c", d, 5) for d in range(5)] + [(None, d, 4) for d in range(5)]
    log = spark.createDataFrame(rows, "run_id string, dimensao_dmbok int, dh_execucao int")
    best = dedup.latest_complete_run(log)
    assert sorted(map(tuple, best.collect())) == [r for r in rows if r[0] == "c"]
    assert "Window" not in best._jdf.queryExecution().toString()
    assert sorted(map(tuple, dedup.latest_complete_run(log.filter("run_id IS NULL")).collect())) == [r for r in rows if r[0] is None]
    assert dedup.latest_complete_run(log.limit(0)).count() == 0


def test_a_consumer_of_the_run_log_reads_one_run(spark, tmp_path):
    path, day = str(tmp_path / "log"), lambda d: dt.datetime(2025, 1, d)
    rows = [(f"r{d}", dim, day(d), f"{dim}-{i}") for d in range(1, 9) for dim in ("abcde" if d < 8 else "ab") for i in range(2)]
    log = spark.createDataFrame(rows, LOG)
    for _ in range(2):  # a repeated block
        runlog.append_runs(log.filter("dh_execucao < '2025-01-05'"), path, "one")
    runlog.append_runs(log.filter("dh_execucao >= '2025-01-05'"), path, "two")
    log.limit(1).write.partitionBy("run_id").parquet(f"{path}/rows/block=torn")  # an interrupted block has no summary
    assert runlog.read_runs(spark, path).count() == 7 * 5 + 2
    assert runlog.read_rows(spark, path, log.schema).count() == len(rows)
    kept = runlog.latest_complete_run(spark, path, log.schema)
    assert sorted(map(tuple, kept.collect())) == sorted(r for r in rows if r[0] == "r7")
    scan = [line for line in kept._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line and "regra_qualidade" in line]
    assert scan and all("PartitionFilters: [(run_id" in line and "ScalarSubquery" in line or "Subquery" in line for line in scan)
    assert {r.run_id for r in runlog.latest_complete_run(spark, path, log.schema, min_dimensions=2).collect()} == {"r8"}


def test_run_summary_names_what_the_rules_will_log(spark):
    df = spark.createDataFrame([("r1", "a"), ("r2", None), ("r2", "b")], "run_id string, uti string")
    rules = [*quality.completeness(["uti"]), quality.RowRule("v", "Validade", "uti", F.col("uti") == "a")]
    at = F.when(F.col("run_id") == "r1", F.lit("2025-01-01")).otherwise(F.lit("2025-01-02")).cast("timestamp")
    log = quality.run_rules(df, rules, "Bronze", "t", F.current_date(), at, by_run="run_id")
    runs = quality.run_summary(df, rules, at, "run_id")
    columns = ["run_id", "dimensao_dmbok", "dh_execucao"]
    assert sorted(map(tuple, runs.select(columns).collect())) == sorted(map(tuple, log.select(columns).distinct().collect()))
    chosen = dedup.latest_complete_run(log, min_dimensions=2, runs=runs)
    assert sorted(map(tuple, chosen.collect())) == sorted(map(tuple, log.filter("run_id = 'r2'").collect()))
    assert sorted(map(tuple, dedup.latest_run(log, "run_id", "dh_execucao", runs).collect())) == sorted(map(tuple, chosen.collect()))


def test_trailing_series_needs_the_newest_observed_days_only(spark):
    base = dt.date(2025, 6, 1)
    days = [base - dt.timedelta(days=i * (1 if i < 20 else 3)) for i in range(120)]
    fact = spark.createDataFrame([(d, i) for i, d in enumerate(days)] + [(None, 0)], "dia date, n int")
    recent = metrics.newest_days(fact, "dia")
    assert sorted(r.dia for r in recent.collect()) == sorted(days)[-36:]
    series_of = lambda df: metrics.trailing_days(metrics.moving_average(metrics.daily_totals(df, "dia", {"n": "n"}), "n", "m"))
    assert sorted(map(tuple, series_of(recent).collect())) == sorted(map(tuple, series_of(fact).collect()))
    assert metrics.newest_days(fact.limit(0), "dia").count() == 0


def changes(spark, *rows):
    """Rows of (day, n, current, start, end)."""
    return spark.createDataFrame(
        [(dt.date.fromisoformat(d), n, c, dt.datetime(2025, 1, s), e and dt.datetime(2025, 1, e)) for d, n, c, s, e in rows],
        "dia date, n long, registro_mais_atual boolean, dh_inicio_vigencia timestamp, dh_fim_vigencia timestamp")


def test_a_delivery_rewrites_the_months_it_touches(spark, tmp_path):
    path = str(tmp_path / "serie")
    first = changes(spark, ("2024-01-05", 2, True, 1, None), ("2024-01-06", 3, True, 1, None), ("2024-02-01", 5, True, 1, None),
                    ("2024-03-09", 7, True, 1, None), ("2024-03-09", 1, False, 1, 1))
    # one case of January closed and moved to March, one of February closed for good, one new in April
    second = changes(spark, ("2024-01-06", 3, False, 1, 2), ("2024-03-10", 4, True, 2, None), ("2024-02-01", 5, False, 1, 2),
                     ("2024-04-01", 9, True, 2, None), ("2024-04-01", 8, False, 2, 2))
    series.apply_delivery(first, path, 1, "dia", SUMS)
    files = {m: {p.name for p in (tmp_path / "serie" / f"mes=2024-0{m}").glob("*.parquet")} for m in (1, 2, 3)}
    moved = second.filter("dia >= '2024-03-01'")
    series.apply_delivery(moved, path, 2, "dia", SUMS)
    now = {m: {p.name for p in (tmp_path / "serie" / f"mes=2024-0{m}").glob("*.parquet")} for m in (1, 2, 3)}
    assert now[1] == files[1] and now[2] == files[2] and now[3] != files[3]
    series.apply_delivery(second, path, 2, "dia", SUMS)  # the run repeated after March and April had been written
    days = sorted(map(tuple, series.read_days(spark, path, SUMS).collect()))
    assert days == [(dt.date(2024, 1, 5), 1, 2), (dt.date(2024, 3, 9), 1, 7), (dt.date(2024, 3, 10), 1, 4), (dt.date(2024, 4, 1), 1, 9)]
    months = sorted(map(tuple, series.read_months(spark, path, SUMS).collect()))
    assert months == [("2024-01", 1, 2), ("2024-03", 2, 11), ("2024-04", 1, 9)]
    series.apply_delivery(second, path, 2, "dia", SUMS)
    assert sorted(map(tuple, series.read_days(spark, path, SUMS).collect())) == days
