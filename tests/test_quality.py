import datetime as dt

import pytest
from pyspark.sql import functions as F

from caselake import catalogs as cat
from caselake.operators import quality


def as_of():
    return F.lit("2025-02-01").cast("date")


def now():
    return F.lit("2025-02-01").cast("timestamp")


def run(df, rules, **options):
    options.setdefault("run_id", "r")
    return {r.regra_qualidade: r for r in quality.run_rules(df, rules, "Bronze", "t", as_of(), now(), **options).collect()}


def test_forty_case_rules(spark):
    kinds = [type(r).__name__ for r in quality.case_rules()]
    assert len(kinds) == 40 and kinds.count("UniqueRule") == 2 and kinds.count("FreshRule") == 3


def test_completeness_counts_blank_as_missing(spark):
    df = spark.createDataFrame([("a",), (" ",), ("",), (None,)], "uti string")
    r = run(df, quality.completeness(["uti"]))["Completude - uti"]
    assert (r.total_registros, r.registros_validos, r.percentual_validade, r.severidade) == (4, 1, 0.25, "CRÍTICO")


def test_domain_null_is_valid_blank_is_not(spark):
    df = spark.createDataFrame([(" f ",), ("M",), (None,), (" ",), ("Z",)], "cs_sexo string")
    r = run(df, quality.domains({"cs_sexo": cat.DOMAINS["cs_sexo"]}))["Validade Domínio - cs_sexo"]
    assert r.registros_validos == 3 and r.registros_invalidos == 2


def test_temporal_order_tolerates_missing_dates(spark):
    df = spark.createDataFrame(
        [("2025-01-02", "2025-01-01"), ("2025-01-01", "2025-01-01T10:00:00.000Z"), ("x", "2025-01-01"),
         (None, None)], "dt_sin_pri string, dt_notific string")
    rule = quality.date_orders([("dt_sin_pri", "dt_notific", "dt_sin_pri <= dt_notific")])
    r = run(df, rule)["Consistência Temporal - dt_sin_pri <= dt_notific"]
    assert r.registros_validos == 3 and r.coluna_avaliada == "dt_sin_pri / dt_notific"


def test_uniqueness_counts_only_complete_keys(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", None), (None, "b")], "k string, d string")
    got = run(df, quality.unique_keys([("k",), ("k", "d")]))
    one, two = got["Unicidade - k"], got["Unicidade - k + d"]
    assert (one.total_registros, one.registros_validos) == (3, 2)
    assert (two.total_registros, two.registros_validos) == (2, 1)


def test_rules_of_an_empty_table(spark):
    df = spark.createDataFrame([], "k string")
    got = run(df, [*quality.completeness(["k"]), *quality.unique_keys([("k",)]), *quality.freshness(["k"])])
    assert {r.percentual_validade for r in got.values()} == {0.0} and len(got) == 3


@pytest.mark.parametrize("newest,valid", [("2025-01-02", 1), ("2025-01-01", 0), ("junk", 0)])
def test_freshness_limit(spark, newest, valid):
    df = spark.createDataFrame([(newest,), ("2024-01-01",) if newest != "junk" else ("x",)], "dt_digita string")
    r = run(df, quality.freshness(["dt_digita"]))["Atualidade - dt_digita"]
    assert (r.total_registros, r.registros_validos) == (1, valid)


def test_ratio_rule(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 1)], "n int, d int")
    rule = lambda high: quality.RatioRule("x", "Acurácia", "n / d", "n", "d", 0.0, high)
    assert run(df, [rule(0.6)])["x"].registros_validos == 0
    assert run(df, [rule(0.7)])["x"].registros_validos == 1
    assert run(df.withColumn("d", F.lit(0)), [rule(9)])["x"].registros_validos == 0


def test_one_log_per_run(spark):
    df = spark.createDataFrame([("r1", "a"), ("r1", None), ("r2", "a")], "run_id string, k string")
    log = quality.run_rules(df, [*quality.completeness(["k"]), *quality.unique_keys([("k",)])],
                            "Bronze", "t", as_of(), now(), by_run="run_id")
    got = {(r.run_id, r.dimensao_dmbok): r.registros_validos for r in log.collect()}
    assert got == {("r1", "Completude"): 1, ("r2", "Completude"): 1, ("r1", "Unicidade"): 1, ("r2", "Unicidade"): 1}


def test_assert_rules(spark):
    df = spark.createDataFrame([("SP",), (None,)], "uf string")
    with pytest.raises(ValueError, match="Completude - uf: 1 invalid"):
        quality.assert_rules(df, quality.completeness(["uf"]))
    quality.assert_rules(df.filter("uf is not null"), quality.completeness(["uf"]))


def log(spark, rows):
    full = [(run, layer, "t", rule, dim, col, 10, 5, 5, pct, 1 - pct, sev, note, dt.datetime(2025, 1, day))
            for run, layer, rule, dim, col, pct, sev, note, day in rows]
    schema = ("run_id string, camada string, tabela_avaliada string, regra_qualidade string, dimensao_dmbok string, "
              "coluna_avaliada string, total_registros long, registros_validos long, registros_invalidos long, "
              "percentual_validade double, percentual_invalidade double, severidade string, observacao string, "
              "dh_execucao timestamp")
    return spark.createDataFrame(full, schema)


def test_inherited_alerts(spark):
    df = log(spark, [
        ("old", "Bronze", "R0", "Completude", "uti", 0.1, "CRÍTICO", None, 1),
        ("new", "Bronze", "R1", "Completude", "uti", 0.1, "CRÍTICO", None, 2),
        ("new", "Bronze", "R2", "Validade", "febre", 0.85, "ALTO", "nota", 1),  # earlier stamp, same run
        ("new", "Bronze", "R3", "Validade", "tosse", 0.99, "ACEITÁVEL", None, 2),
    ])
    got = {r.regra_qualidade: r for r in quality.inherit_alerts(df, F.lit("g"), now()).collect()}
    assert set(got) == {"[Herdado Bronze] R1", "[Herdado Bronze] R2"}
    assert got["[Herdado Bronze] R1"].impacto_analitico == cat.IMPACTS["uti"]
    assert got["[Herdado Bronze] R2"].impacto_analitico == "nota"
    assert got["[Herdado Bronze] R2"].recomendacao_tratamento == cat.RECOMMENDATION_FALLBACK


def test_summaries(spark):
    df = log(spark, [
        ("a", "Bronze", "R1", "Completude", "x", 0.85, "ALTO", None, 1),
        ("a", "Bronze", "R2", "Validade", "y", 0.97, "BAIXO", None, 1),
        ("a", "Bronze", "Consistência temporal – z", "Consistência", "z", 1.0, "ACEITÁVEL", None, 1),
        ("g", "Gold", "R4", "Acurácia", "w", 0.5, "CRÍTICO", None, 1),
    ])
    bronze = df.filter("camada = 'Bronze'")
    one = quality.severity_summary(bronze).first()
    assert (one.criticos, one.altos, one.medios, one.baixos, one.aceitaveis, one.nivel_geral) == (0, 1, 0, 1, 1, "ALTO")
    alert = quality.alert_summary(bronze).first()
    assert (alert.criticos, alert.altos, alert.nivel_geral, alert.alertas) == (0, 1, "ALTO", "ALTO | x | 85.0")
    empty = quality.alert_summary(bronze.filter("false")).first()
    assert (empty.altos, empty.nivel_geral, empty.alertas) == (0, "ACEITÁVEL", "")
    with pytest.raises(Exception, match="several runs"):
        quality.alert_summary(df).collect()
    assert [r.run_id for r in quality.run_history(df).collect()] == ["a"]
    scores = {r.dimensao_dmbok: (r.score_bronze, r.score_gold) for r in quality.dimension_scores(df).collect()}
    assert scores["Completude"] == (0.85, None) and scores["Acurácia"] == (None, 0.5)
    assert [r.regra_qualidade for r in quality.consistency_extract(df).collect()] == ["z"]
    assert [r.severidade for r in quality.severity_ordered(df).collect()] == ["CRÍTICO", "ALTO", "BAIXO", "ACEITÁVEL"]


def test_row_rules_share_one_pass(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("1", "2025-01-01")], "k string, dt_digita string").write.parquet(path)
    rules = [*quality.completeness(["k"]), *quality.domains({"k": ["1"]}), *quality.freshness(["dt_digita"])]
    plan = quality.run_rules(spark.read.parquet(path), rules, "B", "t", as_of(), now(), "r")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "SortAggregate" not in text
