import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from caselake import stages
from caselake.operators import dedup, versioning
from caselake.sources import history, storage

SCHEMA = "hash_caso string, hash_registros string, dh_ultima_atualizacao timestamp, valor string"


def ts(day):
    return dt.datetime(2025, 1, day)


def rows(spark, *items):
    return spark.createDataFrame([(k, f, ts(d), f"{k}{f}") for k, f, d in items], SCHEMA)


def now(day):
    return F.lit(ts(day)).cast("timestamp")


def summary(df):
    return sorted(
        (r.hash_caso, r.hash_registros, r.registro_mais_atual, r.dh_inicio_vigencia.day,
         r.dh_fim_vigencia and r.dh_fim_vigencia.day)
        for r in df.collect()
    )


@pytest.fixture()
def loaded(spark):
    return versioning.scd2_first_load(rows(spark, ("a", "1", 1), ("b", "1", 1), ("c", "1", 1)), now(10))


def test_first_load_keeps_last_version_current(spark):
    got = versioning.scd2_first_load(rows(spark, ("a", "1", 1), ("a", "2", 2)), now(10))
    assert summary(got) == [("a", "1", False, 10, 10), ("a", "2", True, 10, None)]


def test_merge_transitions(spark, loaded):
    delivery = rows(spark, ("a", "1", 5), ("b", "2", 5), ("d", "1", 5))
    got = versioning.scd2_merge(loaded, delivery, now(20))
    assert summary(got) == [
        ("a", "1", True, 10, None),            # unchanged
        ("b", "1", False, 10, 20), ("b", "2", True, 20, None),  # changed
        ("c", "1", True, 10, None),            # absent from the delivery
        ("d", "1", True, 20, None),            # new
    ]


def test_several_versions_in_one_delivery_chain(spark, loaded):
    delivery = rows(spark, ("a", "1", 5), ("a", "2", 6), ("a", "3", 7), ("e", "1", 5), ("e", "2", 6))
    got = versioning.scd2_merge(loaded, delivery, now(20)).filter("hash_caso in ('a', 'e')")
    assert summary(got) == [
        ("a", "1", False, 10, 20), ("a", "2", False, 20, 20), ("a", "3", True, 20, None),
        ("e", "1", False, 20, 20), ("e", "2", True, 20, None),
    ]


def test_return_to_an_earlier_content_is_a_new_version(spark, loaded):
    once = versioning.scd2_merge(loaded, rows(spark, ("a", "2", 5)), now(20))
    back = versioning.scd2_merge(once, rows(spark, ("a", "1", 6)), now(21)).filter("hash_caso = 'a'")
    assert summary(back) == [
        ("a", "1", False, 10, 20), ("a", "1", True, 21, None), ("a", "2", False, 20, 21)]


def test_repeating_a_delivery_changes_nothing(spark, loaded):
    delivery = rows(spark, ("a", "2", 5), ("z", "1", 5))
    once = versioning.scd2_merge(loaded, delivery, now(20))
    assert summary(versioning.scd2_merge(once, delivery, now(21))) == summary(once)


def test_key_known_only_from_closed_rows(spark, loaded):
    closed = loaded.withColumn("registro_mais_atual", F.col("hash_caso") != "a")
    again = rows(spark, ("a", "1", 5))
    reopened = versioning.scd2_merge(closed, again, now(20)).filter("hash_caso = 'a'")
    assert [r[2] for r in summary(reopened)] == [False, True]
    kept = versioning.scd2_merge(closed, again, now(20), mode="close_only").filter("hash_caso = 'a'")
    assert [r[2] for r in summary(kept)] == [False]


def test_close_only_never_opens_the_new_version(spark, loaded):
    got = versioning.scd2_merge(loaded, rows(spark, ("b", "2", 5), ("d", "1", 5)), now(20), mode="close_only")
    assert summary(got) == [
        ("a", "1", True, 10, None), ("b", "1", False, 10, 20), ("c", "1", True, 10, None),
        ("d", "1", True, 20, None)]


def test_unknown_mode(spark, loaded):
    with pytest.raises(ValueError):
        versioning.scd2_merge(loaded, rows(spark, ("b", "2", 5)), now(20), mode="x")


def test_added_column_reads_null_in_old_rows(spark, loaded):
    wider = rows(spark, ("b", "2", 5)).withColumn("nova", F.lit("n"))
    got = versioning.scd2_merge(loaded, wider, now(20))
    assert Counter(r.nova for r in got.collect()) == {None: 3, "n": 1}


def test_one_current_row_per_key_with_a_hot_key(spark):
    """A third of all delivered rows belong to one key."""
    base = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("hash_caso"),
        F.col("id").cast("string").alias("hash_registros"),
        F.timestamp_seconds(F.col("id")).alias("dh_ultima_atualizacao"), F.lit("x").alias("valor"),
    )
    first = versioning.scd2_first_load(base.filter("id < 1500"), now(10))
    got = versioning.scd2_merge(first, base.filter("id >= 1500"), now(20))
    per_key = got.groupBy("hash_caso").agg(F.count_if("registro_mais_atual").alias("n"))
    assert got.count() == 3000 and per_key.filter("n <> 1").count() == 0
    assert got.filter("hash_caso = 'hot' and registro_mais_atual").first().hash_registros == "2997"


def test_stored_history(spark):
    name, root = "historia_teste", storage.fresh_dir(spark, "test-history")
    history.merge_delivery(spark, name, root, "d1", rows(spark, ("a", "1", 1), ("b", "1", 1)), now(10))
    second = rows(spark, ("a", "2", 5), ("c", "1", 5))
    for _ in range(2):  # the second time is a replay
        history.merge_delivery(spark, name, root, "d2", second, now(20))
    history.merge_delivery(spark, name, root, "d3", rows(spark, ("a", "3", 6)), now(21))
    expected = [
        ("a", "1", False, 10, 20), ("a", "2", False, 20, 21), ("a", "3", True, 21, None),
        ("b", "1", True, 10, None), ("c", "1", True, 20, None)]
    assert summary(history.read_history(spark, name)) == expected
    # an interrupted later delivery left a folder behind: it does not show
    rows(spark, ("x", "1", 9)).withColumns({
        "registro_mais_atual": F.lit(False), "dh_inicio_vigencia": now(22), "dh_fim_vigencia": now(22), "balde": F.lit(0),
        "numero_entrega": F.lit(4),
    }).write.partitionBy("balde", "registro_mais_atual").parquet(f"{root}/{name}/parte=lost")
    assert summary(history.read_history(spark, name)) == expected
    assert {r.hash_registros for r in history.read_current(spark, name).collect()} == {"3", "1"}
    assert "parte=lost" in history.vacuum(spark, name) and history.vacuum(spark, name) == []
    assert summary(history.read_history(spark, name)) == expected
    spark.sql(f"DROP VIEW {name}")


def test_keep_first_reduces_hot_keys_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    kept = dedup.keep_first(df, ["k"], ["id"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    assert sorted(r.id for r in kept.collect()) == [0, 1, 2]


def test_latest_run_and_fallbacks(spark):
    df = spark.createDataFrame([("r1", 1), ("r2", 3), ("r1", 2)], "run_id string, dh_ingestao_bronze int")
    assert [r.run_id for r in dedup.latest_run(df).collect()] == ["r2"]
    log = spark.createDataFrame(
        [("r1", d, 1) for d in "abcde"] + [("r2", d, 2) for d in "abc"] + [("r3", "a", 3)],
        "run_id string, dimensao_dmbok string, dh_execucao int")
    run = lambda df: {r.run_id for r in df.collect()}
    assert run(dedup.latest_complete_run(log)) == {"r1"}
    assert run(dedup.latest_complete_run(log, min_dimensions=9)) == {"r3"}
    assert run(dedup.latest_complete_run(log, min_dimensions=None)) == {"r1"}
    assert run(dedup.latest_complete_run(log, min_dimensions=3)) == {"r2"}


@pytest.fixture()
def eager_skew_splitting(spark):
    """Lets small test data count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_key_is_split_over_tasks(spark, eager_skew_splitting):
    base = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("hash_caso"),
        F.sha2(F.col("id").cast("string"), 256).alias("hash_registros"),
        F.timestamp_seconds(F.col("id")).alias("dh_ultima_atualizacao"),
    )
    first = versioning.scd2_first_load(base, now(10))
    rows = first.collect()
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    assert len(rows) == 60000 and sum(r.registro_mais_atual for r in rows) == 40001


def expected_history(deliveries):
    """Plain-Python model: per key a list of [content, current, opened, closed]."""
    state = {}
    for stamp, items in deliveries:
        by_key = {}
        for key, content, day in items:
            by_key.setdefault(key, []).append((day, content))
        for key, versions in by_key.items():
            for _, content in sorted(versions):
                history_of_key = state.setdefault(key, [])
                if history_of_key and history_of_key[-1][1]:
                    if history_of_key[-1][0] == content:
                        continue
                    history_of_key[-1][1:] = [False, history_of_key[-1][2], stamp]
                history_of_key.append([content, True, stamp, None])
    return sorted((k, *v) for k, rows_of_key in state.items() for v in rows_of_key)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_deliveries_equal_the_model(spark, seed):
    rng = random.Random(seed)
    deliveries = []
    for stamp in (10, 15, 20):
        items = {}
        for _ in range(400):
            key, content = f"k{rng.choice([0, 0, rng.randrange(120)])}", str(rng.randrange(6))
            items[key, content] = rng.randrange(1, 9)  # one row per key and content
        deliveries.append((stamp, [(k, c, d) for (k, c), d in items.items()]))
    got = versioning.scd2_first_load(rows(spark, *deliveries[0][1]), now(10))
    for stamp, items in deliveries[1:]:
        got = versioning.scd2_merge(got, rows(spark, *items), now(stamp))
    as_tuple = lambda r: tuple((x is None, x) for x in r)
    assert sorted(summary(got), key=as_tuple) == sorted(map(tuple, expected_history(deliveries)), key=as_tuple)


def test_sending_an_older_delivery_again_changes_nothing(spark):
    name, root = "historia_repetida", storage.fresh_dir(spark, "test-replay")
    first, second = rows(spark, ("a", "1", 1), ("b", "1", 1)), rows(spark, ("a", "2", 5), ("c", "1", 5))
    history.merge_delivery(spark, name, root, "d1", first, now(10))
    history.merge_delivery(spark, name, root, "d3", second, now(20))
    expected = summary(history.read_history(spark, name))
    history.merge_delivery(spark, name, root, "d1", first, now(30))
    history.merge_delivery(spark, name, root, "d3", second, now(31))
    assert summary(history.read_history(spark, name)) == expected
    assert ("a", "1", False, 10, 20) in expected and ("a", "2", True, 20, None) in expected
    with pytest.raises(ValueError, match="older"):
        history.merge_delivery(spark, name, root, "d2", second, now(28))
    spark.sql(f"DROP VIEW {name}")


def test_stored_close_only(spark):
    name, root = "historia_fecha", storage.fresh_dir(spark, "test-close")
    deliveries = [[("a", "1", 1), ("b", "1", 1)], [("a", "2", 5), ("c", "1", 5)], [("a", "3", 6), ("b", "1", 6), ("d", "1", 6)]]
    got = versioning.scd2_first_load(rows(spark, *deliveries[0]), now(10))
    for i, items in enumerate(deliveries):
        history.merge_delivery(spark, name, root, f"d{i}", rows(spark, *items), now(10 + i), mode="close_only")
        if i:
            got = versioning.scd2_merge(got, rows(spark, *items), now(10 + i), mode="close_only")
    assert summary(history.read_history(spark, name)) == summary(got)
    assert {r.hash_caso for r in history.read_current(spark, name).collect()} == {"b", "c", "d"}
    spark.sql(f"DROP VIEW {name}")


def test_a_delivery_writes_its_own_size(spark):
    name, root = "historia_delta", storage.fresh_dir(spark, "test-delta")
    for n in (500, 5000):
        history.merge_delivery(spark, f"{name}{n}", root, "d1", rows(spark, *[(f"k{i}", "1", 1) for i in range(n)]), now(10))
        history.merge_delivery(spark, f"{name}{n}", root, "d2", rows(spark, ("k1", "2", 5), ("new", "1", 5), ("k2", "1", 5)), now(20))
        assert [r.rows for r in history.deliveries(spark, f"{name}{n}").orderBy("number").collect()] == [n, 3]  # k1 closed and opened, one new
        assert history.read_current(spark, f"{name}{n}").count() == n + 1
        spark.sql(f"DROP VIEW {name}{n}")


def test_pending_cases(spark):
    name, root = "historia_pendente", storage.fresh_dir(spark, "test-pending")
    with_stamp = lambda df, day: df.withColumn("dh_ingestao_bronze", now(day))
    bronze = with_stamp(rows(spark, ("a", "1", 1)), 1).unionByName(with_stamp(rows(spark, ("b", "1", 1)), 5))
    assert stages.pending_cases(spark, bronze, name).count() == 2
    history.merge_delivery(spark, name, root, "d1", bronze.filter("hash_caso = 'a'"), now(10))
    assert [r.hash_caso for r in stages.pending_cases(spark, bronze, name).collect()] == ["b"]
    spark.sql(f"DROP VIEW {name}")


def test_history_gains_columns(spark):
    name, root = "historia_colunas", storage.fresh_dir(spark, "test-columns")
    history.merge_delivery(spark, name, root, "d1", rows(spark, ("a", "1", 1)), now(10))
    wider = rows(spark, ("a", "2", 5)).withColumn("nova", F.lit("n"))
    history.merge_delivery(spark, name, root, "d2", wider, now(20))
    got = {r.hash_registros: r.nova for r in history.read_history(spark, name).collect()}
    assert got == {"1": None, "2": "n"}
    spark.sql(f"DROP VIEW {name}")


def input_bytes(spark):
    """Bytes that all jobs so far have read from files."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    sc = spark.sparkContext
    none = sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList()
    run = sc._jsc.sc().statusStore().stageList(None, False, False, *none)
    return sum(run.apply(i).inputBytes() for i in range(run.size()))


def test_a_small_delivery_reads_as_much_from_a_table_ten_times_larger(spark):
    name, root, read = "historia_baldes", storage.fresh_dir(spark, "test-buckets"), {}
    for n in (2_000, 20_000):
        wide = spark.range(n).select(
            F.concat(F.lit("k"), "id").alias("hash_caso"), F.lit("1").alias("hash_registros"), F.lit(ts(1)).alias("dh_ultima_atualizacao"),
            F.sha2(F.col("id").cast("string"), 512).alias("valor"))
        history.merge_delivery(spark, f"{name}{n}", root, "d1", wide, now(10), bucket_rows=100)
        source = rows(spark, ("k1", "2", 5), ("new", "1", 5))
        before = input_bytes(spark)
        history.merge_delivery(spark, f"{name}{n}", root, "d2", source, now(20))
        read[n] = input_bytes(spark) - before
        got = history.read_history(spark, f"{name}{n}")
        assert got.count() == n + 2 and summary(got.filter("hash_caso = 'k1'")) == [("k1", "1", False, 10, 20), ("k1", "2", True, 20, None)]
        spark.sql(f"DROP VIEW {name}{n}")
    assert read[20_000] < 1.5 * read[2_000]


def test_deliveries_are_numbered_and_compacted_in_levels(spark):
    """16 small deliveries: about log n parts, and the rows of the plain merge."""
    name, root = "historia_niveis", storage.fresh_dir(spark, "test-levels")
    rng = random.Random(5)
    deliveries = []
    for d in range(1, 17):
        items = {(f"k{rng.randrange(12)}", str(rng.randrange(3))): rng.randrange(1, 28) for _ in range(3)}
        stamp = 1 + d % 28
        deliveries.append((stamp, [(k, c, day) for (k, c), day in items.items()]))
        history.merge_delivery(spark, name, root, f"d{d}", rows(spark, *deliveries[-1][1]), now(stamp), bucket_rows=8)
    with pytest.raises(ValueError, match="older"):
        history.merge_delivery(spark, name, root, "d9b", rows(spark, ("a", "1", 1)), now(28))
    as_tuple = lambda r: tuple((x is None, x) for x in r)
    assert sorted(summary(history.read_history(spark, name)), key=as_tuple) == sorted(
        map(tuple, expected_history(deliveries)), key=as_tuple)
    state = history._state(spark, name)
    assert history.merged_deliveries(spark, name) == [f"d{d}" for d in range(1, 17)]
    assert len(state.parts) <= 8 and max(p.buckets for p in state.parts) > 1
    history.vacuum(spark, name)
    assert len([c for c in storage.Folder(spark, f"{root}/{name}").children() if c.startswith("parte=")]) == len(state.parts)
    assert sorted(summary(history.read_history(spark, name)), key=as_tuple) == sorted(
        map(tuple, expected_history(deliveries)), key=as_tuple)
    spark.sql(f"DROP VIEW {name}")


def test_a_merge_opens_the_buckets_of_delivered_keys_only(spark):
    name, root = "historia_alvo", storage.fresh_dir(spark, "test-target")
    history.merge_delivery(spark, name, root, "d1", rows(spark, *[(f"k{i}", "1", 1) for i in range(400)]), now(10), bucket_rows=10)
    state = history._state(spark, name)
    (part,) = state.parts
    assert part.buckets == 64
    bucket = spark.range(1).select(F.lit("k7").alias("k")).select(history._hash("k", 64)).first()[0]
    opened = history._read(spark, state, state.parts, {bucket}, 64)
    assert {p.split("balde=")[1].split("/")[0] for p in opened.inputFiles()} == {str(bucket)}
    assert opened.filter("hash_caso = 'k7'").count() == 1
    spark.sql(f"DROP VIEW {name}")


def test_pending_cases_reads_the_manifest_alone(spark):
    name, root = "historia_manifesto", storage.fresh_dir(spark, "test-manifest")
    base = rows(spark, ("a", "1", 1)).withColumn("dh_ingestao_bronze", now(3))
    history.merge_delivery(spark, name, root, "d1", base, now(10))
    history.merge_delivery(spark, name, root, "d2", base.withColumn("dh_ingestao_bronze", now(6)), now(11))  # changes nothing
    bronze = base.withColumn("dh_ingestao_bronze", F.explode(F.array(now(6), now(7))))
    pending = stages.pending_cases(spark, bronze, name)
    assert [r.dh_ingestao_bronze for r in pending.collect()] == [ts(7)]
    plan = pending._jdf.queryExecution().executedPlan().toString()
    assert "manifest" in plan and "parte=" not in plan
    spark.sql(f"DROP VIEW {name}")
