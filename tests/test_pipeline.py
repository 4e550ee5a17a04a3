"""Case-shaped fixtures through privacy, typing, star schema, capacity and context."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caselake import catalogs as cat
from caselake.functions import text as tx
from caselake.operators import capacity, context, normalize, privacy, star

SALT = "sal"


@pytest.fixture(scope="module")
def bronze(spark):
    base = {
        "nu_notific": "1", "dt_notific": "2025-01-20", "dt_sin_pri": "2025-01-15T00:00:00.000Z",
        "dt_digita": None, "dt_encerra": None, "dt_interna": None, "dt_entuti": "2025-01-21",
        "dt_saiduti": "2025-01-19", "dt_evoluca": "20250201", "dt_nasc": "1980-05-05",
        "sg_uf_not": " sp", "co_mun_not": "35", "sg_uf": "sp ", "co_mun_res": "3550308",
        "id_mn_resi": "SAO PAULO", "cs_sexo": " f ", "nu_idade_n": "44", "tp_idade": "3",
        "cs_raca": "4", "cs_gestant": "5", "cs_escol_n": "0", "hospital": "2", "uti": "1",
        "vacina": "1", "vacina_cov": "2", "suport_ven": "1", "classi_fin": "5", "criterio": "1",
        "evolucao": "2", "dose_1_cov": "x", "dose_2_cov": None, "nm_pacient": "Ana", "nu_cpf": "123",
        "lote_1_cov": "L1", "formato_data_origem": "ISO_DATE", "nome_arquivo_origem": "f.csv",
    }
    other = {**base, "nu_notific": None, "uti": "x", "hospital": "1.0", "evolucao": None,
             "dt_interna": "2025-01-16", "dt_sin_pri": "lixo", "cs_sexo": None, "nm_pacient": "Bia"}
    third = {**other, "nu_notific": " ", "cs_sexo": "M", "dt_notific": None}
    names = list(base)
    rows = [tuple(r[n] for n in names) for r in (base, other, third)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    return df.withColumn("dh_ingestao_bronze", F.lit(dt.datetime(2025, 2, 2)))


@pytest.fixture(scope="module")
def typed(bronze):
    return normalize.type_cases(privacy.mask_for_analytics(privacy.add_case_key(bronze, SALT), SALT))


def test_no_clear_personal_data_in_analytics(typed):
    assert not set(typed.columns) & {*cat.DIRECT_PII, *cat.QUASI_PII_HIGH, *cat.UNANALYTIC_COLUMNS}
    assert "dt_nasc_hash" in typed.columns
    text = typed.select(F.concat_ws("|", *[F.col(c).cast("string") for c in typed.columns])).collect()
    assert not any("Ana" in r[0] or "1980-05-05" in r[0] for r in text)


def test_cases_without_identifier_stay_apart(bronze):
    keys = [r.hash_caso for r in privacy.add_case_key(bronze, SALT).collect()]
    assert len(set(keys)) == 3


def test_vault(bronze):
    vault = privacy.build_pii_vault(bronze.unionByName(bronze), SALT, "r")
    rows = {r.nm_pacient: r for r in vault.collect()}
    assert len(rows) == 2 and vault.count() == 3
    assert rows["Ana"].dt_nasc == "1980-05-05" and len(rows["Ana"].nu_cpf_hash) == 64
    with pytest.raises(ValueError):
        privacy.build_pii_vault(bronze.select("nu_notific"), SALT, "r")


def test_hash_columns_parameter(bronze):
    masked = privacy.mask_for_analytics(bronze, SALT, hash_columns=cat.DIRECT_PII)
    assert {"nu_cpf_hash", "nm_pacient_hash"} <= set(masked.columns) and "nu_cpf" not in masked.columns


def test_typing(typed):
    one, two, three = sorted(typed.collect(), key=lambda r: (r.nu_notific is None, r.nu_notific != "1"))[:3]
    assert one.dt_sin_pri == dt.date(2025, 1, 15) and one.dt_evoluca == dt.date(2025, 2, 1)
    assert one.dias_uti == -2 and one.qtd_doses_covid_registradas == 1
    assert (one.sg_uf_residencia, one.sg_uf_not, one.cs_sexo, one.faixa_etaria) == ("SP", "SP", "F", "40-49")
    assert one.dh_ultima_atualizacao == dt.datetime(2025, 1, 20)
    assert one.flag_obito_srag == 1 and one.flag_hospitalizado == 0 and one.flag_vacinado_covid == 0
    rest = [r for r in typed.collect() if r.nu_notific != "1"]
    assert all(r.uti is None and r.hospital is None and r.dt_sin_pri is None for r in rest)
    assert all(r.flag_hospitalizado == 1 and r.flag_uti == 0 and r.flag_evolucao_informada == 0 for r in rest)
    assert {r.dh_ultima_atualizacao for r in rest} == {dt.datetime(2025, 1, 20), dt.datetime(2025, 2, 2)}


def test_star(typed):
    fact = star.fact_table(typed.unionByName(typed))
    rows = fact.collect()
    assert len(rows) == 3 and sum(r.sk_tempo is None for r in rows) == 2
    dims = {
        "sk_tempo": star.date_dimension(typed), "sk_localidade": star.place_dimension(typed),
        "sk_perfil": star.profile_dimension(typed), "sk_classificacao": star.class_dimension(typed),
    }
    assert {r.chave: r.orfaos for r in star.orphan_counts(fact, dims).collect()} == dict.fromkeys(dims, 0)
    empty = {**dims, "sk_localidade": dims["sk_localidade"].filter("false"), "sk_tempo": dims["sk_tempo"].filter("false")}
    assert {r.chave: r.orfaos for r in star.orphan_counts(fact, empty).collect()} == {
        "sk_tempo": 1, "sk_localidade": 3, "sk_perfil": 0, "sk_classificacao": 0}
    labels = {r.descricao_sexo for r in dims["sk_perfil"].collect()}
    assert labels == {"Feminino", "Masculino", "Não informado"}


def test_fact_keeps_the_latest_update(typed):
    newer = typed.withColumns({"dh_ultima_atualizacao": F.lit(dt.datetime(2026, 1, 1)), "flag_uti": F.lit(7)})
    assert {r.flag_uti for r in star.fact_table(typed.unionByName(newer)).collect()} == {7}


def test_calendar_is_contiguous(typed):
    days = star.generate_calendar(typed, F.lit("2025-01-20").cast("date")).orderBy("data").collect()
    assert len(days) == 6 and days[0].semana_epidemiologica == "2025-03" and days[0].nome_mes == "Janeiro"


def test_null_safe_join(spark):
    left = spark.createDataFrame([(1, None), (2, "a"), (3, "z")], "id int, k string")
    right = spark.createDataFrame([(None, "N"), ("a", "A")], "k string, v string")
    got = star.null_safe_left_join(left, right, {"k": "k"}, ["v"])
    assert sorted((r.id, r.v or "") for r in got.collect()) == [(1, "N"), (2, "A"), (3, "")]


def test_rollup_keeps_unmatched_keys(spark):
    fact = spark.createDataFrame([("a", 1), ("a", 2), ("b", 4)], "sk string, n int")
    dim = spark.createDataFrame([("a", "X")], "sk string, uf string")
    got = star.rollup_by_dimension(fact, dim, "sk", ["uf"], {"n": "n"})
    assert {r.uf: r.n for r in got.collect()} == {"X": 3, None: 4}


def test_beds(spark):
    raw = spark.createDataFrame(
        [(202501, "sudeste", "SP ", "sao paulo", "1", "M", "10", "x", "4"),
         (202501, "sudeste", "SP", "sao paulo", "1", "Z", "5", "2", "1"),
         (202502, "sudeste", "SP", "sao paulo", "2", None, "5", "2", "1")],
        "COMP int, REGIAO string, UF string, MUNICIPIO string, CNES string, TP_GESTAO string, "
        "LEITOS_EXISTENTES string, LEITOS_SUS string, UTI_TOTAL_EXIST string")
    raw = raw.withColumn("NO_EMAIL", F.lit("x@y"))
    beds = capacity.type_beds(raw)
    assert "no_email" not in beds.columns and dict(beds.dtypes)["co_ibge"] == "string"
    assert [r.desc_tp_gestao for r in beds.collect()] == ["Municipal", "Não informado", "Não informado"]
    rollup = {r.ano_mes: r for r in capacity.capacity_rollup(beds).collect()}
    january = rollup["2025-01"]
    assert (january.leitos_existentes_total, january.leitos_sus_total, january.uti_total_exist,
            january.qtd_estabelecimentos, january.uf) == (15, 2, 5, 1, "SP")
    year = capacity.coverage_by_year(capacity.capacity_rollup(beds)).first()
    assert (year.meses_cobertos, year.primeiro_mes, year.total_uti_exist) == (2, "2025-01", 6)


def test_context_and_audit(spark):
    articles = spark.createDataFrame(
        [(1, "Surto de gripe", "https://www.gov.br/a", "r" * 600), (2, "Outro", "https://www.gov.br/a", "r"),
         (3, "INFLUENZA hoje", "https://z.example/b", "r"), (4, "Esporte", "https://z.example/c", "r")],
        "n int, titulo string, url string, resumo string")
    got = {r.n: r for r in context.prepare_context(articles, ["n"]).collect()}
    assert set(got) == {1, 3, 4} and got[1].confiabilidade_fonte == "Alta" and len(got[1].resumo) == 600
    keyed = context.prepare_context(articles, ["n"], keywords=cat.TITLE_KEYWORDS)
    assert {r.n for r in keyed.collect()} == {1, 3}
    assert [r.n for r in context.prepare_context(articles, ["n"], cap=2).collect()] == [1, 3]

    talks = spark.createDataFrame([("u", "q" * 600, "a", True, ["t"])],
                                  "usuario string, pergunta string, resposta string, bloqueado boolean, tools array<string>")
    for name in ("queries", "fontes", "guardrails"):
        talks = talks.withColumn(name, F.col("tools"))
    row = context.audit_rows(talks, F.lit("r"), F.lit(dt.datetime(2025, 1, 1)), ["usuario"]).first()
    assert (len(row.pergunta), row.tools_acionadas, row.status_execucao) == (600, '["t"]', "BLOQUEADO")
    many = talks.withColumn("tools", F.transform(F.sequence(F.lit(1), F.lit(30)), lambda i: F.concat(F.lit("a very long tool name "), i.cast("string"))))
    logged = context.audit_rows(many, F.lit("r"), F.lit(dt.datetime(2025, 1, 1)), ["usuario"])
    back = logged.select(F.from_json("tools_acionadas", "array<string>").alias("t")).first().t
    assert back == [f"a very long tool name {i}" for i in range(1, 31)]


def test_addresses_are_compared_whole(spark):
    rows = [(1, "t", "https://a.example/x?id=1", "r"), (2, "t", "https://a.example/x?id=2", "r"), (3, "t", "https://a.example/x?id=2", "r")]
    articles = spark.createDataFrame(rows, "n int, titulo string, url string, resumo string")
    assert sorted(r.n for r in context.prepare_context(articles, ["n"]).collect()) == [1, 2]


def test_read_queries_only_plan(spark, data_dir):
    """Building a query reads table footers at most; nothing runs before its rows are asked for."""
    from caselake.plans.queries import REGISTRY

    store = spark.sparkContext._jsc.sc().statusStore()
    for name in ("latest_complete_run", "latest_covering_gold_run", "inherit_alerts", "severity_summary", "alert_summary",
                 "completeness_extract", "validity_extract", "consistency_extract", "severity_ordered", "kpi_with_alerts"):
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        before = store.jobsList(None).size()
        REGISTRY[name](spark, data_dir)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
        jobs = store.jobsList(None)
        started = [jobs.apply(i).name() for i in range(jobs.size() - before)]
        assert all(j.startswith("parquet at") for j in started), (name, started)


def test_output_guard(spark):
    df = spark.createDataFrame([("cpf 123.456.789-00",), ("Ocupação de leitos alta",)], "t string")
    got = [(r.aprovado, r.texto) for r in context.guard_answers(df, "t").collect()]
    assert got == [(False, None), (True, "uso de UTI registrado entre casos SRAG hospitalizados alta")]


def test_corrections_equal_the_plain_expression_on_odd_letters(spark):
    """The search before the replacement never skips a text the replacement would change."""
    values = [
        "COBERTURA VACİNAL", "cobertura vacınal", "coberturA vacinal", "ocupação de leitoſ", "OCUPAÇÃO DE UTI",
        "ocupação de uti e cobertura de VACINAÇÃO", "x", "", None, "coberturȧ vacinal", "Åelo", "åelo",
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    pairs = {**cat.MISLEADING_TERMS, "åelo": "anel", "kilo": "k", "anel": "elo"}
    got = context.correct_terms(df, "t", pairs).withColumn("plain", tx.correct_terms("t", pairs)).orderBy("i").collect()
    assert [r.texto_corrigido for r in got] == [r.plain for r in got]
    assert sum(r.t != r.plain for r in got) >= 7
    assert not tx.foldable("straße") and not tx.foldable("ΣΑΣ") and not tx.foldable("µ") and all(map(tx.foldable, cat.MISLEADING_TERMS))
    sharp = context.correct_terms(df.select(F.lit("STRAẞE").alias("t")), "t", {"straße": "rua"})
    assert sharp.first().texto_corrigido == sharp.select(tx.correct_terms("t", {"straße": "rua"})).first()[0]


def test_folding_covers_every_case_blind_match(spark):
    """All characters of the basic plane against all Latin letters."""
    chars = spark.range(1, 0x10000).filter("id < 55296 or id > 57343").select(
        F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')").alias("c"))
    letters = [ch for ch in map(chr, range(0x100)) if ch.isalpha() and ch not in "ßµªº"]
    folded = chars.withColumn("f", tx.fold_case("c"))
    missed = [
        F.count_if(F.col("c").rlike(rf"(?iu)^\Q{ch}\E$") & ~F.col("f").contains(tx.fold_case(F.lit(ch))))
        for ch in letters
    ]
    assert set(folded.agg(*[m.alias(f"m{i}") for i, m in enumerate(missed)]).first()) == {0}
