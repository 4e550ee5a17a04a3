"""What jobs send through shuffles and leave on disk."""

import datetime as dt
import time
import uuid

import pytest
from pyspark.sql import functions as F

from caselake.catalogs import FLAG_NAMES
from caselake.functions import keys
from caselake.operators import star, versioning
from caselake.plans import casebook
from caselake.plans.queries import REGISTRY
from caselake.sources import history, storage, tables

N = 20_000


def shuffled_bytes(spark):
    """Bytes that all jobs so far have written for shuffles."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    sc = spark.sparkContext
    none = sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList()
    run = sc._jsc.sc().statusStore().stageList(None, False, False, *none)
    return sum(run.apply(i).shuffleWriteBytes() for i in range(run.size()))


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(blocks.getAllFiles())
            if f.getName().startswith("shuffle_")}


def left_behind(spark, before):
    """Shuffle files newer than ``before`` that are still there after a while: files are deleted in the background."""
    until = time.time() + 10
    while (new := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return new


def stamp(day):
    return F.lit(dt.datetime(2025, 1, day)).cast("timestamp")


def versions(spark, start, end, content="1", day=1):
    """One version with digests a key."""
    return spark.range(start, end, 1, 4).select(
        F.sha2(F.col("id").cast("string"), 256).alias("hash_caso"),
        F.sha2(F.concat(F.col("id").cast("string"), F.lit(content)), 256).alias("hash_registros"),
        stamp(day).alias("dh_ultima_atualizacao"), F.lit("x").alias("valor"))


TEXTS = [None, "", "a", "ab", "é" * 32, " " * 64, "A" * 64, "g" * 64, "0" * 63, "0" * 64, "a" * 64, "a" * 65,
         "0123456789abcdef" * 4, "0123456789ABCDEF" * 4, "\x01x"]


def test_packed_texts_come_back_and_digests_keep_their_order(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string").withColumn("p", keys.pack_digest("t"))
    got = df.withColumn("u", keys.unpack_digest("p")).collect()
    assert all(r.u == r.t for r in got) and len({r.p and bytes(r.p) for r in got}) == len(TEXTS)
    packed = {r.t: bytes(r.p) for r in got if r.t is not None}
    digests = sorted(t for t in packed if len(packed[t]) == 33)
    assert digests == ["0" * 64, "0123456789abcdef" * 4, "a" * 64]
    assert [packed[d] for d in digests] == sorted(packed[d] for d in digests)


def test_a_published_table_leaves_no_shuffle_files(spark, tmp_path):
    """every write of the stages frees the shuffles behind it."""
    before, name = shuffle_files(spark), f"sala_{uuid.uuid4().hex}"
    df = spark.range(2000).repartition(4, "id").withColumn("b", F.pmod(F.xxhash64("id"), F.lit(50)))
    tables.overwrite(tables.cluster(df, ["b", "id"], interleave=True), name, str(tmp_path))
    tables.write_checked(df.groupBy("b").count(), str(tmp_path / "checked"))
    assert tables.read_table(spark, name).filter("id < 0").isEmpty()
    assert not left_behind(spark, before)
    assert spark.conf.get(storage.FREE_SHUFFLES, None) in (None, "false")
    spark.sql(f"DROP VIEW {name}")


def test_the_fact_shuffles_what_its_keys_are_made_of(spark):
    """not the six digests themselves."""
    text = {c: F.pmod(F.col("id"), F.lit(7)).cast("string") for c in (*star.PLACE_KEY, *star.PROFILE_KEY, *star.CLASS_KEY)}
    current = spark.range(0, N, 1, 4).select(
        F.sha2(F.col("id").cast("string"), 256).alias("hash_caso"), *[c.alias(n) for n, c in text.items()],
        *[F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("id"), F.lit(300)).cast("int")).alias(d) for d in star.FACT_DATES],
        *[F.lit(1).alias(c) for c in (*star.FACT_MEASURES, *FLAG_NAMES)], stamp(1).alias("dh_ultima_atualizacao"))
    twice = current.unionByName(current.withColumns({"dh_ultima_atualizacao": stamp(2), "evolucao": F.lit("9")}))
    before = shuffled_bytes(spark)
    got = star.fact_table(twice).agg(F.count(F.lit(1)), F.sum(F.hash("sk_caso", "hash_caso", "sk_tempo", "sk_localidade", "sk_perfil", "sk_classificacao")))
    rows, digest = got.first()
    assert (shuffled_bytes(spark) - before) / (2 * N) < 130
    newest = star.fact_rows(twice.filter(F.col("dh_ultima_atualizacao") == stamp(2)))
    assert (rows, digest) == tuple(newest.agg(F.count(F.lit(1)), F.sum(F.hash(
        "sk_caso", "hash_caso", "sk_tempo", "sk_localidade", "sk_perfil", "sk_classificacao"))).first())


@pytest.mark.parametrize("mode", ["versions", "close_only"])
def test_a_stored_merge_leaves_its_parts_alone(spark, mode):
    """no shuffle files and no scratch folders stay; digests travel packed."""
    name, root = f"sala_{uuid.uuid4().hex}", storage.fresh_dir(spark, "test-room")
    shared = storage.Folder(spark, f"{storage.shared_dir(spark)}/caselake")
    kept, before, sent = set(shared.children()), shuffle_files(spark), shuffled_bytes(spark)
    deliveries = [versions(spark, 0, N), versions(spark, N // 2, 2 * N, "2", 5)]
    for i, source in enumerate(deliveries):
        history.merge_delivery(spark, name, root, f"d{i}", source, stamp(10 + i), mode=mode, bucket_rows=5000)
    assert (shuffled_bytes(spark) - sent) / (2.5 * N) < 235
    assert not left_behind(spark, before)
    assert set(shared.children()) - kept <= {root.rpartition("/")[2]}
    per_key = history.read_history(spark, name).groupBy("hash_caso").agg(F.count(F.lit(1)).alias("n"), F.count_if(versioning.CURRENT).alias("c"))
    found = {(r.n, r.c): r["count"] for r in per_key.groupBy("n", "c").count().collect()}
    assert found == ({(1, 1): 3 * N // 2, (2, 1): N // 2} if mode == "versions" else {(1, 1): 3 * N // 2, (1, 0): N // 2})
    spark.sql(f"DROP VIEW {name}")


@pytest.mark.parametrize("mode", ["versions", "close_only"])
def test_a_merge_shuffles_digests_packed(spark, tmp_path, mode):
    """F6, F7, F8: and keys that are no digests, or missing, end as they did."""
    versioning.scd2_first_load(versions(spark, 0, N), stamp(10)).write.parquet(str(tmp_path / "first"))
    first = spark.read.parquet(str(tmp_path / "first"))
    odd = versions(spark, N // 2, 2 * N, "2", 5).unionByName(versions(spark, 0, 1).withColumn("hash_caso", F.lit("odd"))).unionByName(
        versions(spark, 1, 2).withColumn("hash_caso", F.lit(None).cast("string")))
    before = shuffled_bytes(spark)
    got = versioning.scd2_merge(first, odd, stamp(20), mode=mode).agg(
        F.count(F.lit(1)), F.count_if(versioning.CURRENT), F.count_if(F.col("hash_caso") == "odd"), F.count_if(F.col("hash_caso").isNull()),
        F.count_distinct("hash_caso"), F.max(F.length("hash_caso")), F.max("valor")).first()
    assert (shuffled_bytes(spark) - before) / (2.5 * N) < 160
    rows, current = (N // 2 * 5 + 1, 2 * N + 1) if mode == "versions" else (2 * N + 1, 3 * N // 2 + 1)
    assert tuple(got) == (rows, current, 1, 0, 2 * N + 1, 64, "x")


def write_orders(spark, folder, n=N):
    """Orders with and without line items, one twice, one without a key, with blank statuses, and their line items."""
    day = dt.datetime(1999, 12, 25)
    orders = spark.range(0, n, 1, 4).select(
        F.col("id").alias("o_orderkey"), F.element_at(F.array(*map(F.lit, ("F", "O", " P", "P"))), (F.col("id") % 4 + 1).cast("int")).alias("o_orderstatus"),
        F.date_add(F.lit(day).cast("date"), (F.col("id") % 14).cast("int")).cast("timestamp").alias("o_orderdate"), F.lit("5-LOW").alias("o_orderpriority"))
    odd = spark.createDataFrame([(None, "F", day, "1-X"), (0, "O", day, "2-Y"), (0, None, day, None)],
                                "o_orderkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string")
    orders.unionByName(odd).write.parquet(f"{folder}/orders.parquet")
    spark.range(0, n, 1, 4).filter("id % 3 > 0").select(
        F.col("id").alias("l_orderkey"), F.lit("N").alias("l_returnflag"), F.when(F.col("id") % 5 > 0, "O").otherwise("F").alias("l_linestatus"),
        F.lit(0.1).alias("l_discount"), F.lit(dt.datetime(2000, 1, 1)).alias("l_shipdate")).write.parquet(f"{folder}/lineitem.parquet")


def test_versions_are_reduced_by_their_text(spark, tmp_path):
    """F6, F7, F8: the same versions as a grouping by the digests gives, without shuffling digests."""
    write_orders(spark, tmp_path)
    before = shuffled_bytes(spark)
    first, second = casebook.deliveries(spark, str(tmp_path))
    rows = second.collect()
    assert (shuffled_bytes(spark) - before) / N < 100
    orders = spark.read.parquet(f"{tmp_path}/orders.parquet").collect()
    expected = {}
    for o in orders:
        seen = [(o.o_orderstatus, o.o_orderdate)]
        if o.o_orderkey and o.o_orderkey % 3 > 0:
            seen.append(("O" if o.o_orderkey % 5 > 0 else "F", max(o.o_orderdate, dt.datetime(2000, 1, 1))))
        for status, at in seen:
            known = (o.o_orderkey, (status or "n/a").strip(), (o.o_orderpriority or "n/a")[:1] if o.o_orderpriority else "n/a")
            expected[known] = max(at, expected.get(known, at))
    assert {(r.caso, (r.evolucao or "n/a").strip(), r.classi_fin or "n/a"): r.dh_ultima_atualizacao for r in rows} == expected
    assert len(rows) == len(expected) and len({(r.hash_caso, r.hash_registros) for r in rows}) == len(rows)
    known = spark.createDataFrame([(r.caso, r.hash_caso, r.hash_registros, r.evolucao, r.classi_fin) for r in rows],
                                  "caso long, h string, g string, evolucao string, classi_fin string")
    again = known.filter(~F.col("h").eqNullSafe(F.sha2(F.col("caso").cast("string"), 256)) | (
        F.col("g") != keys.trimmed_hash(["caso", "classi_fin", "evolucao"])))
    assert again.count() == 0
    assert first.count() == sum(o.o_orderdate < dt.datetime(2000, 1, 1) for o in orders)


def test_merge_queries_read_a_stored_target(spark, tmp_path):
    """F6, F7, F8: the first load is computed once, not for each kind of row of the merge."""
    write_orders(spark, tmp_path, 200)
    for name in ("scd2_merge", "scd2_close_only", "current_view"):
        plan = REGISTRY[name](spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [o_orderkey") <= 2, plan  # the second delivery, for its rows and for their summary
