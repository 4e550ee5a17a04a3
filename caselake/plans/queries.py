"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caselake import catalogs as cat
from caselake import stages
from caselake.functions import codes, dates, keys, text
from caselake.functions.names import sanitize_columns
from caselake.operators import (
    capacity, context, dedup, metrics, normalize, privacy, quality, star, versioning, views,
)
from caselake.plans import casebook as cb
from caselake.sources import history, runlog, series, storage, tables
from caselake.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

DELIVERY = "2002-01-01"
RULES_AT = "2001-08-11"


def _portable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text, so any client compares them alike."""
    formats = {T.DateType(): "yyyy-MM-dd", T.TimestampType(): "yyyy-MM-dd HH:mm:ss"}
    return df.select(*[
        F.date_format(f.name, formats[f.dataType]).alias(f.name)
        if f.dataType in formats else F.col(f.name)
        for f in df.schema
    ])


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        REGISTRY[name] = lambda spark, sf_dir: _portable(build(spark, sf_dir))
        return build
    return register


# --- indicators ---------------------------------------------------------------

@query("daily_metrics")
def daily_metrics(spark, sf):
    return metrics.daily_metrics(cb.indicators(spark, sf))


@query("daily_ma7_rows")
def daily_ma7_rows(spark, sf):
    daily = metrics.daily_totals(cb.indicators(spark, sf), sums={"total_casos": "flag_caso_srag"})
    return metrics.moving_average(daily, "total_casos", "media_movel_7d_casos")


@query("daily_ma7_calendar")
def daily_ma7_calendar(spark, sf):
    daily = metrics.daily_totals(cb.indicators(spark, sf), sums={"total_casos": "flag_caso_srag"})
    return metrics.moving_average(daily, "total_casos", "media_movel_7d_casos", calendar=True)


@query("daily_metrics_by_place")
def daily_metrics_by_place(spark, sf):
    return metrics.daily_metrics(cb.cases(spark, sf), by=["sg_uf_residencia"])


@query("monthly_metrics")
def monthly_metrics(spark, sf):
    return metrics.monthly_metrics(cb.indicators(spark, sf))


def _kpi(spark, sf):
    return metrics.kpi_snapshot(cb.indicators(spark, sf), cb.as_of())


@query("kpi_snapshot")
def kpi_snapshot(spark, sf):
    return _kpi(spark, sf)


@query("kpi_report_long")
def kpi_report_long(spark, sf):
    return metrics.kpi_report_long(_kpi(spark, sf))


@query("measured_rows")
def measured_rows(spark, sf):
    return metrics.measured_rows(cb.table(spark, sf, "lineitem"), {
        "linhas": F.count(F.lit(1)),
        "fornecedores": F.count_distinct("l_suppkey"),
        "maior_pedido": F.max("l_orderkey").cast("long"),
        "linhas_grandes": F.count_if(F.col("l_quantity") > 25),
    }, by=["l_returnflag"])


@query("category_mix")
def category_mix(spark, sf):
    fact = cb.indicators(spark, sf)
    ref = metrics.reference_date(fact, "dt_sin_pri")
    recent = metrics.trailing_month_rows(fact, "dt_sin_pri", ref)
    return metrics.category_mix(metrics.monthly_metrics(recent), ref)


@query("place_month_matrix")
def place_month_matrix(spark, sf):
    cases = cb.cases(spark, sf)
    ref = metrics.reference_date(cases, "dt_sin_pri")
    return metrics.place_month_matrix(cases, ref, place="id_mn_resi")


@query("peak_day")
def peak_day(spark, sf):
    return metrics.peak_day(metrics.daily_totals(cb.indicators(spark, sf)))


@query("trailing_30d")
def trailing_30d(spark, sf):
    fact = cb.indicators(spark, sf)
    ref = metrics.reference_date(fact, "dt_sin_pri")
    recent = metrics.newest_days(fact, "dt_sin_pri")
    return metrics.trailing_days(metrics.daily_metrics(recent), ref=ref).orderBy(
        F.desc("data_referencia")
    )


@query("trailing_12m")
def trailing_12m(spark, sf):
    fact = cb.indicators(spark, sf)
    ref = metrics.reference_date(fact, "dt_sin_pri")
    recent = metrics.trailing_month_rows(fact, "dt_sin_pri", ref)
    return metrics.monthly_metrics(recent).orderBy("ano", "mes")


@query("fact_summary")
def fact_summary(spark, sf):
    return metrics.fact_summary(cb.indicators(spark, sf))


@query("remainder_share")
def remainder_share(spark, sf):
    return metrics.remainder_share(metrics.monthly_metrics(cb.indicators(spark, sf)))


@query("frequency_file_format")
def frequency_file_format(spark, sf):
    bronze = cb.bronze_cases(spark, sf)
    return metrics.frequency(bronze, ["nome_arquivo_origem", "run_id"], "total")


@query("frequency_file_format_version")
def frequency_file_format_version(spark, sf):
    file = "nome_arquivo_origem"
    bronze = cb.bronze_cases(spark, sf).withColumn("versao_arquivo_origem", ingest.file_version(file, VERSIONS))
    formats = ingest.detect_date_format(bronze, "dt_sin_pri", file)
    counted = metrics.frequency(bronze, [file, "versao_arquivo_origem"], "total")
    return counted.join(formats, file)


@query("frequency_by_year")
def frequency_by_year(spark, sf):
    cases = cb.cases(spark, sf)
    return metrics.frequency(cases, [F.year("dt_sin_pri").alias("ano")], "total")


# --- typing and derivation -----------------------------------------------------

@query("parse_date_multi")
def parse_date_multi(spark, sf):
    bronze = cb.bronze_cases(spark, sf)
    return normalize.parse_dates(bronze).select(
        "nu_notific", "dt_notific", "dt_sin_pri", "dt_interna", "dt_encerra", "dt_nasc"
    )


@query("parse_date_prefix")
def parse_date_prefix(spark, sf):
    return cb.bronze_cases(spark, sf).select(
        "nu_notific",
        dates.parse_date_prefix("dt_sin_pri").alias("dt_sin_pri_d"),
        dates.parse_date_prefix("dt_notific").alias("dt_notific_d"),
    )


@query("detect_date_format")
def detect_date_format(spark, sf):
    return ingest.detect_date_format(cb.bronze_cases(spark, sf), file="nome_arquivo_origem")


@query("cast_ints")
def cast_ints(spark, sf):
    typed = normalize.cast_ints(cb.bronze_cases(spark, sf))
    return typed.select("nu_notific", "nu_idade_n", "tp_idade", "cs_escol_n", "fator_risc",
                        "vacina_cov", "classi_fin", "evolucao")


@query("normalize_text")
def normalize_text(spark, sf):
    bronze = cb.bronze_cases(spark, sf).select("nu_notific", "sg_uf", "cs_sexo", "id_mn_resi")
    return normalize.normalize_text(bronze, upper=("sg_uf", "cs_sexo"), title=("id_mn_resi",))


@query("decode_codes")
def decode_codes(spark, sf):
    cases = cb.typed_cases(spark, sf)
    return cases.select(
        "nu_notific",
        codes.decode("cs_sexo", cat.SEX_LABELS).alias("sexo"),
        codes.decode("cs_raca", cat.RACE_LABELS).alias("raca"),
        codes.decode("cs_gestant", cat.PREGNANCY_LABELS).alias("gestante"),
        codes.decode("cs_escol_n", cat.SCHOOLING_LABELS).alias("escolaridade"),
        codes.decode_map("criterio", cat.CRITERION_LABELS).alias("criterio_mapa"),
    )


@query("age_and_band")
def age_and_band(spark, sf):
    return cb.typed_cases(spark, sf).select("nu_notific", "idade_anos_calculada", "faixa_etaria")


@query("period_parts")
def period_parts(spark, sf):
    beds = sanitize_columns(cb.bronze_beds(spark, sf))
    return beds.withColumns(dates.period_parts("comp")).select("cnes", "comp", "ano", "mes", "ano_mes")


@query("duration_days")
def duration_days(spark, sf):
    return cb.typed_cases(spark, sf).select("nu_notific", "dt_entuti", "dt_saiduti", "dias_uti")


@query("count_present")
def count_present(spark, sf):
    return cb.typed_cases(spark, sf).select("nu_notific", "qtd_doses_covid_registradas")


@query("derive_flags")
def derive_flags(spark, sf):
    return cb.typed_cases(spark, sf).select("nu_notific", *cat.FLAG_NAMES)


@query("first_non_null_watermark")
def first_non_null_watermark(spark, sf):
    return cb.typed_cases(spark, sf).select("nu_notific", "dh_ultima_atualizacao")


@query("calendar")
def calendar(spark, sf):
    return star.generate_calendar(cb.cases(spark, sf), cb.as_of())


@query("sanitize_columns")
def sanitize(spark, sf):
    return sanitize_columns(cb.bronze_beds(spark, sf)).select(
        "comp", "cnes", "uf", "nome_estabelecimento", "razao_social", "leitos_sus"
    )


# --- privacy and keys -------------------------------------------------------------

@query("pseudonymize")
def pseudonymize(spark, sf):
    return cb.table(spark, sf, "customer").select(
        "c_custkey", keys.pseudonymize("c_name", cb.SALT).alias("nome_hash"),
        keys.pseudonymize(F.lit(None), cb.SALT).alias("vazio_hash"),
    )


@query("pii_vault")
def pii_vault(spark, sf):
    return privacy.build_pii_vault(cb.bronze_cases(spark, sf), cb.SALT, "vault-run")


@query("masked_view")
def masked_view(spark, sf):
    return privacy.mask_for_analytics(
        privacy.add_case_key(cb.bronze_cases(spark, sf), cb.SALT), cb.SALT
    )


@query("row_fingerprint")
def row_fingerprint(spark, sf):
    people = cb.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return people.select("c_custkey", keys.row_fingerprint(people.columns).alias("hash_registros"))


@query("natural_key")
def natural_key(spark, sf):
    bronze = cb.bronze_cases(spark, sf)
    partly = F.when(F.col("sg_uf_not") == "ASIA", None).when(F.col("sg_uf_not") == "EUROPE", "  ")
    return bronze.select(
        "nu_notific",
        keys.natural_key(partly.otherwise(F.col("nu_notific")), cat.FALLBACK_KEY_COLUMNS)
        .alias("chave_natural"),
    )


@query("surrogate_keys")
def surrogate_keys(spark, sf):
    return cb.cases(spark, sf).select(
        "nu_notific", keys.time_key("dt_interna").alias("sk_interna"),
        star.place_key().alias("sk_localidade"), star.profile_key().alias("sk_perfil"),
        star.class_key().alias("sk_classificacao"),
    )


# --- star schema and capacity ----------------------------------------------------------

@query("dim_date")
def dim_date(spark, sf):
    return star.date_dimension(cb.cases(spark, sf))


@query("dim_place")
def dim_place(spark, sf):
    return star.place_dimension(cb.cases(spark, sf))


@query("dim_profile")
def dim_profile(spark, sf):
    return star.profile_dimension(cb.cases(spark, sf))


@query("dim_class")
def dim_class(spark, sf):
    return star.class_dimension(cb.cases(spark, sf))


@query("fact")
def fact(spark, sf):
    return star.fact_table(cb.cases(spark, sf))


@query("orphan_counts")
def orphan_counts(spark, sf):
    cases = cb.cases(spark, sf)
    earlier = cases.filter(F.col("dt_sin_pri") < F.lit("1995-01-10").cast("date"))
    return star.orphan_counts(
        star.fact_rows(cases),
        {
            "sk_tempo": star.date_dimension(earlier),
            "sk_localidade": star.place_dimension(earlier),
            "sk_perfil": star.profile_dimension(earlier),
            "sk_classificacao": star.class_dimension(earlier),
        },
    )


@query("rollup_by_dimension")
def rollup_by_dimension(spark, sf):
    cases = cb.cases(spark, sf)
    return star.rollup_by_dimension(
        star.fact_rows(cases), star.place_dimension(cases), "sk_localidade", ["sg_uf"],
        {"casos": "flag_caso_srag", "obitos": "flag_obito_srag"}, by=[dates.year_month("dt_sin_pri")],
    ).withColumnRenamed("_by0", "ano_mes")


@query("null_safe_join")
def null_safe_join(spark, sf):
    cases = cb.cases(spark, sf).select("nu_notific", "cs_sexo", "cs_gestant")
    sizes = metrics.frequency(cases, ["cs_sexo", "cs_gestant"], "tamanho").select(
        F.col("cs_sexo").alias("sexo"), F.col("cs_gestant").alias("gestante"), "tamanho"
    )
    return star.null_safe_left_join(
        cases, sizes, {"cs_sexo": "sexo", "cs_gestant": "gestante"}, ["tamanho"]
    )


@query("beds_typed")
def beds_typed(spark, sf):
    return capacity.type_beds(cb.bronze_beds(spark, sf))


@query("capacity_rollup")
def capacity_rollup(spark, sf):
    return capacity.capacity_rollup(capacity.type_beds(cb.bronze_beds(spark, sf)))


@query("capacity_use")
def capacity_use(spark, sf):
    rollup = capacity.capacity_rollup(capacity.type_beds(cb.bronze_beds(spark, sf)))
    return capacity.capacity_use(cb.cases(spark, sf), rollup)


@query("coverage_by_year")
def coverage_by_year(spark, sf):
    rollup = capacity.capacity_rollup(capacity.type_beds(cb.bronze_beds(spark, sf)))
    return capacity.coverage_by_year(rollup)


# --- deduplication and versions ------------------------------------------------------------

@query("dedup_first")
def dedup_first(spark, sf):
    events = cb.table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return dedup.keep_first(events, ["user_id"], ["ts", "event_id"]).drop("ts")


@query("dedup_latest")
def dedup_latest(spark, sf):
    events = cb.table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return dedup.keep_latest(events, ["user_id", "event_type"], "ts", ties=["event_id"]).drop("ts")


@query("dedup_case_versions")
def dedup_case_versions(spark, sf):
    """The whole raw table delivered twice: one row per case and content, the later one."""
    bronze = cb.bronze_cases(spark, sf)
    later = bronze.withColumns({
        "dh_ingestao_bronze": F.col("dh_ingestao_bronze") + F.expr("interval 1 day"),
        "nome_arquivo_origem": F.lit("redelivery.csv"),
    })
    both = versioning.fingerprint_cases(bronze.unionByName(later))
    return versioning.dedup_case_versions(both).select(
        "nu_notific", "nome_arquivo_origem", "dh_ingestao_bronze"
    )


@query("drop_duplicates_by")
def drop_duplicates_by(spark, sf):
    lines = cb.table(spark, sf, "lineitem").select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    return dedup.keep_first(
        lines, ["l_partkey"],
        ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"],
    )


@query("distinct_projection")
def distinct_projection(spark, sf):
    return dedup.distinct_projection(
        cb.table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag", "l_linestatus"]
    )


@query("scd2_first_load")
def scd2_first_load(spark, sf):
    first, _ = cb.deliveries(spark, sf)
    return versioning.scd2_first_load(first, cb.stamp(cb.FIRST_DELIVERY_BEFORE))


def _merged(spark, sf, mode="versions"):
    first, second = cb.deliveries(spark, sf)
    # a merge reads its target once for each kind of row, so it is stored as a history is
    target = storage.kept(versioning.scd2_first_load(first, cb.stamp(cb.FIRST_DELIVERY_BEFORE)), "target")
    return versioning.scd2_merge(target, second, cb.stamp(DELIVERY), mode=mode)


@query("scd2_merge")
def scd2_merge(spark, sf):
    return _merged(spark, sf)


@query("scd2_close_only")
def scd2_close_only(spark, sf):
    return _merged(spark, sf, "close_only")


@query("current_view")
def current_view(spark, sf):
    return versioning.current_view(_merged(spark, sf)).select("caso", "evolucao", "classi_fin")


@query("scd2_table_roundtrip")
def scd2_table_roundtrip(spark, sf):
    """First load and merge through the stored history, the second delivery sent twice."""
    first, second = cb.deliveries(spark, sf)
    name, root = f"casos_{uuid.uuid4().hex}", storage.fresh_dir(spark, "scd2")
    for delivery, source in ((cb.FIRST_DELIVERY_BEFORE, first), (DELIVERY, second), (DELIVERY, second)):
        history.merge_delivery(spark, name, root, f"d{delivery}", source, cb.stamp(delivery))
    return history.read_history(spark, name)


@query("scd2_table_close_only")
def scd2_table_close_only(spark, sf):
    """The stored history in the mode that closes only; an older delivery sent again at the end."""
    first, second = cb.deliveries(spark, sf)
    name, root = f"casos_{uuid.uuid4().hex}", storage.fresh_dir(spark, "scd2")
    for delivery, source in ((cb.FIRST_DELIVERY_BEFORE, first), (DELIVERY, second), (cb.FIRST_DELIVERY_BEFORE, first)):
        history.merge_delivery(spark, name, root, f"d{delivery}", source, cb.stamp(delivery), mode="close_only")
    return history.read_history(spark, name)


def _three_runs(spark, sf) -> tuple[str, DataFrame]:
    """Case versions in three runs by year; two are delivered, then the last versions of the second once more."""
    _, versions = cb.deliveries(spark, sf)
    year = F.year("dh_ultima_atualizacao")
    run = F.when(year < 1997, 1).when(year < 1999, 2).otherwise(3)
    path = storage.fresh_dir(spark, "runs")
    versions.withColumn("corrida", run).withColumn(
        "dh_ingestao_bronze", F.make_timestamp(F.lit(2002), F.col("corrida"), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    ).write.partitionBy("corrida").parquet(path)
    bronze = tables.read_table(spark, path)
    name = f"casos_{uuid.uuid4().hex}"
    first, second = (bronze.filter(F.col("corrida") == c).drop("corrida") for c in (1, 2))
    again = dedup.keep_latest(second, ["hash_caso"], "dh_ultima_atualizacao", ties=[F.desc("hash_registros")])
    for delivery, source in (("d9", first), ("d10", second), ("d11", again)):
        history.merge_delivery(spark, name, path + "-history", delivery, source, cb.stamp(DELIVERY))
    return name, bronze


@query("scd2_delivery_manifest")
def scd2_delivery_manifest(spark, sf):
    """What the manifest says of three deliveries; the third brings nothing new."""
    name, _ = _three_runs(spark, sf)
    return history.deliveries(spark, name).select("number", "delivery", "rows", "newest")


@query("pending_cases")
def pending_cases(spark, sf):
    """Raw rows of the run that was not delivered, found by the manifest alone."""
    name, bronze = _three_runs(spark, sf)
    return stages.pending_cases(spark, bronze, name).select("caso", "evolucao", "classi_fin", "dh_ingestao_bronze")


@query("latest_run")
def latest_run(spark, sf):
    return dedup.latest_run(cb.bronze_cases(spark, sf)).select("nu_notific", "run_id")


@query("unmerged_runs")
def unmerged_runs(spark, sf):
    rows = versioning.unmerged_runs(cb.bronze_cases(spark, sf), cb.stamp("1999-06-30"))
    return metrics.frequency(rows, ["run_id"], "total")


# --- data quality ------------------------------------------------------------------------

def _case_log(spark, sf, rules):
    return quality.run_rules(
        cb.bronze_cases(spark, sf), rules, "Bronze", "casos", cb.as_of(), cb.stamp(RULES_AT), "run-q"
    )


@query("rules_completeness")
def rules_completeness(spark, sf):
    return _case_log(spark, sf, quality.completeness(cat.COMPLETENESS_COLUMNS))


@query("rules_domain")
def rules_domain(spark, sf):
    return _case_log(spark, sf, quality.domains(cat.DOMAINS))


@query("rules_temporal")
def rules_temporal(spark, sf):
    return _case_log(spark, sf, quality.date_orders(cat.DATE_ORDERS))


@query("rules_uniqueness")
def rules_uniqueness(spark, sf):
    """Key rules over the raw cases, and keys that do repeat over line items and events."""
    lines = quality.run_rules(
        cb.table(spark, sf, "lineitem"),
        quality.unique_keys([("l_orderkey",), ("l_orderkey", "l_linenumber")]),
        "Bronze", "itens", cb.as_of(), cb.stamp(RULES_AT), "run-q",
    )
    events = quality.run_rules(
        cb.table(spark, sf, "events"), quality.unique_keys([("event_id",), ("user_id",)]),
        "Bronze", "eventos", cb.as_of(), cb.stamp(RULES_AT), "run-q",
    )
    return _case_log(spark, sf, quality.unique_keys(cat.UNIQUE_KEYS)).unionByName(lines).unionByName(events)


@query("rules_freshness")
def rules_freshness(spark, sf):
    return _case_log(spark, sf, quality.freshness(cat.FRESH_COLUMNS))


@query("rules_all")
def rules_all(spark, sf):
    return _case_log(spark, sf, quality.case_rules())


def _gold_source(spark, sf):
    cases = cb.cases(spark, sf)
    return cases.withColumns(
        {"sk_tempo": keys.time_key("dt_sin_pri"), "sk_classificacao": star.class_key()}
    )


@query("gold_checks")
def gold_checks(spark, sf):
    return quality.run_rules(
        star.fact_rows(cb.cases(spark, sf)), quality.fact_rules(), "Gold", "fato", cb.as_of(),
        cb.stamp(RULES_AT), "run-g",
    )


def _year_end():
    return F.concat(F.substring("run_id", 5, 4), F.lit("-12-31")).cast("timestamp")


def _case_run_source(spark, sf):
    """Raw cases, one quality run per year."""
    return cb.bronze_cases(spark, sf), quality.case_rules(), _year_end()


def _event_run_source(spark, sf):
    """Events with two-dimension rules, one quality run per day."""
    events = cb.table(spark, sf, "events").withColumns({
        "run_id": F.date_format("ts", "yyyy-MM-dd"),
        "event_type": F.when(F.col("event_type") != "error", F.col("event_type")),
    })
    rules = [*quality.completeness(["event_type"]),
             quality.RowRule("Validade - value", "Validade", "value", F.col("value") < 20)]
    return events, rules, F.col("run_id").cast("timestamp")


def case_log(spark, sf):
    rows, rules, at = _case_run_source(spark, sf)
    return quality.run_rules(rows, rules, "Bronze", "casos", cb.as_of(), at, by_run="run_id")


def quality_log(spark, sf):
    """Rule history: one run per year of raw cases, one two-dimension run per day of events."""
    rows, rules, at = _event_run_source(spark, sf)
    daily = quality.run_rules(rows, rules, "Bronze", "eventos", cb.as_of(), at, by_run="run_id")
    return case_log(spark, sf).unionByName(daily)


def quality_runs(spark, sf):
    """Runs of that history with the dimensions they cover, no rule evaluated."""
    summaries = [quality.run_summary(*source(spark, sf), "run_id") for source in (_case_run_source, _event_run_source)]
    return summaries[0].unionByName(summaries[1])


def gold_log(spark, sf):
    """Fact checks, one run per year."""
    return quality.run_rules(
        _gold_source(spark, sf), quality.fact_rules(), "Gold", "fato", cb.as_of(), _year_end(),
        by_run="run_id",
    )


def _complete(spark, sf):
    return dedup.latest_complete_run(quality_log(spark, sf), runs=quality_runs(spark, sf))


@query("stored_quality_run")
def stored_quality_run(spark, sf):
    """The rule history stored by run; the newest complete run read back by its summary."""
    path, log = storage.fresh_dir(spark, "runs"), quality_log(spark, sf)
    runlog.append_runs(log, path, "all")
    kept = runlog.latest_complete_run(spark, path, log.schema)
    return kept.select("run_id", "regra_qualidade", "registros_validos", "severidade")


@query("quality_log_by_run")
def quality_log_by_run(spark, sf):
    return quality_log(spark, sf)


@query("latest_complete_run")
def latest_complete_run(spark, sf):
    return _complete(spark, sf).select("run_id", "regra_qualidade", "registros_validos", "severidade")


@query("latest_covering_gold_run")
def latest_covering_gold_run(spark, sf):
    runs = quality.run_summary(_gold_source(spark, sf), quality.fact_rules(), _year_end(), "run_id")
    return dedup.latest_complete_run(gold_log(spark, sf), min_dimensions=None, runs=runs)


@query("inherit_alerts")
def inherit_alerts(spark, sf):
    runs = quality.run_summary(*_case_run_source(spark, sf), "run_id")
    return quality.inherit_alerts(case_log(spark, sf), F.lit("run-g"), cb.stamp(RULES_AT), runs=runs)


@query("severity_summary")
def severity_summary(spark, sf):
    return quality.severity_summary(_complete(spark, sf))


@query("alert_summary")
def alert_summary(spark, sf):
    return quality.alert_summary(_complete(spark, sf))


@query("dimension_scores")
def dimension_scores(spark, sf):
    return quality.dimension_scores(quality_log(spark, sf).unionByName(gold_log(spark, sf)))


@query("run_history")
def run_history(spark, sf):
    return quality.run_history(quality_log(spark, sf).unionByName(gold_log(spark, sf)))


@query("completeness_extract")
def completeness_extract(spark, sf):
    return quality.completeness_extract(_complete(spark, sf))


@query("validity_extract")
def validity_extract(spark, sf):
    return quality.validity_extract(_complete(spark, sf))


@query("consistency_extract")
def consistency_extract(spark, sf):
    return quality.consistency_extract(_complete(spark, sf))


@query("accuracy_extract")
def accuracy_extract(spark, sf):
    return quality.accuracy_extract(gold_log(spark, sf))


@query("severity_ordered")
def severity_ordered(spark, sf):
    return quality.severity_ordered(_complete(spark, sf)).select(
        "severidade", "percentual_validade", "regra_qualidade"
    )


# --- text guards, context, consumers --------------------------------------------------------

# wordings that occur in the test texts, corrected next to the domain's own
TEXT_CORRECTIONS = {"éti": "E-ti", "the ": "[the] ", **cat.MISLEADING_TERMS}


@query("blocked_terms")
def blocked_terms(spark, sf):
    docs = cb.documents(spark, sf)
    return context.flag_blocked_terms(docs, "text", cat.BLOCKED_TERMS_APP).drop("text")


@query("blocked_questions")
def blocked_questions(spark, sf):
    talk = cb.table(spark, sf, "conversations")
    return context.flag_blocked_terms(talk, "text").drop("text")


@query("pii_detect")
def pii_detect(spark, sf):
    docs = cb.documents(spark, sf)
    patterns = {"cpf": cat.CPF_BOUNDED, "cpf_solto": cat.CPF_ANYWHERE, "cns": cat.CNS_BOUNDED}
    return context.detect_pii(docs, "text", patterns).drop("text")


@query("correct_terms")
def correct_terms(spark, sf):
    docs = cb.documents(spark, sf)
    return context.correct_terms(docs, "text", TEXT_CORRECTIONS).drop("text")


@query("length_gate")
def length_gate(spark, sf):
    talk = cb.table(spark, sf, "conversations")
    return context.length_gate(talk, "text").drop("text")


@query("guard_answers")
def guard_answers(spark, sf):
    docs = cb.documents(spark, sf)
    return context.guard_answers(docs, "text").select("doc_id", "aprovado", F.md5("texto").alias("m"))


@query("prepare_context")
def prepare_context(spark, sf):
    return context.prepare_context(cb.articles(spark, sf), order=["page_id"])


@query("context_by_keyword")
def context_by_keyword(spark, sf):
    """Articles whose title mentions a keyword (words of the test texts next to the domain's own)."""
    words = (*cat.TITLE_KEYWORDS, "reti", "eau")
    found = context.prepare_context(cb.articles(spark, sf), order=["page_id"], keywords=words)
    return found.select("page_id", "news_id", "titulo")


@query("context_top")
def context_top(spark, sf):
    """The log's top-k: the first articles by page id."""
    return context.prepare_context(
        cb.articles(spark, sf), order=["page_id"], cap=cat.ARTICLE_CAP
    ).select("page_id", "news_id", "fonte", "confiabilidade_fonte")


@query("news_log")
def news_log(spark, sf):
    ready = context.prepare_context(cb.articles(spark, sf), order=["page_id"])
    return context.news_log_rows(ready, F.lit("run-n"), cb.stamp(RULES_AT))


@query("audit_log")
def audit_log(spark, sf):
    asked = cb.interactions(spark, sf)
    blocked = text.blocked_term("pergunta", cat.BLOCKED_TERMS_APP).isNotNull()
    none = F.array().cast("array<string>")
    ready = asked.select(
        "conv_id", "turn", F.concat(F.lit("user-"), F.col("conv_id")).alias("usuario"),
        "pergunta", F.coalesce("resposta", F.lit("")).alias("resposta"), blocked.alias("bloqueado"),
        F.when(blocked, none).otherwise(F.array(F.lit("indicadores"), F.lit("series"))).alias("tools"),
        F.when(blocked, none).otherwise(F.array(F.lit("kpi"))).alias("queries"),
        none.alias("fontes"),
        F.when(blocked, F.array(F.lit("G1_input_bloqueado"))).otherwise(none).alias("guardrails"),
    )
    return context.audit_rows(ready, F.lit("run-a"), cb.stamp(RULES_AT), ["conv_id", "turn"])


@query("kpi_with_alerts")
def kpi_with_alerts(spark, sf):
    return views.kpi_with_alerts(_kpi(spark, sf), _complete(spark, sf))


@query("daily_series_view")
def daily_series_view(spark, sf):
    fact = cb.indicators(spark, sf)
    ref = metrics.reference_date(fact, "dt_sin_pri")
    return views.daily_series(metrics.daily_metrics(metrics.newest_days(fact, "dt_sin_pri")), ref)


@query("monthly_series_view")
def monthly_series_view(spark, sf):
    fact = cb.indicators(spark, sf)
    ref = metrics.reference_date(fact, "dt_sin_pri")
    recent = metrics.trailing_month_rows(fact, "dt_sin_pri", ref)
    return views.monthly_series(metrics.monthly_metrics(recent), ref)


# --- ingestion and layout ----------------------------------------------------------------------

VERSIONS = {"cases_F": "F-1995", "cases_O": "O-1996"}
_LINEAGE = ("dh_ingestao_bronze", "nome_arquivo_origem", "run_id")


def stage_case_files(spark, sf) -> str:
    """The raw cases as delimited files, one layout per status, the F files delivered twice.

    F files lack a column the others have, O files carry it first; P files
    come from a source no version rule knows.
    """
    root, whole = storage.fresh_dir(spark, "staged"), storage.fresh_dir(spark, "raw")
    cb.bronze_cases(spark, sf).write.parquet(whole)
    raw = tables.read_table(spark, whole)
    data = [c for c in raw.columns if c not in _LINEAGE]
    short = [c for c in data if c != "dose_adic"]
    layouts = {
        "cases_F": ("cases_F.csv", short),
        "cases_F_again": ("cases_F.csv", short),
        "cases_O": ("cases_O.csv", ["dose_adic", *short]),
        "cases_P": ("cases_P.csv", data),
    }
    for folder, (file, columns) in layouts.items():
        part = raw.filter(F.col("nome_arquivo_origem") == file)
        part.select(*[F.col(c).alias(c.upper()) for c in columns]).write.options(
            header=True, sep=";", quote='"', escape='"', encoding="UTF-8"
        ).csv(f"{root}/{folder}")
    return root


def ingested(spark, sf) -> DataFrame:
    """The staged files through the stream into the raw table."""
    source = stage_case_files(spark, sf)
    sink, checkpoint = storage.fresh_dir(spark, "bronze"), storage.fresh_dir(spark, "checkpoint")
    ingest.ingest_csv_stream(
        spark, source, sink, checkpoint, run_id="run-i", versions=VERSIONS,
        ingested_at=cb.stamp(RULES_AT),
    ).awaitTermination()
    return ingest.read_bronze(spark, sink)


@query("ingest_stream")
def ingest_stream(spark, sf):
    return ingested(spark, sf).drop("nome_arquivo_origem")


@query("schema_evolution")
def schema_evolution(spark, sf):
    return ingested(spark, sf).groupBy("versao_arquivo_origem").agg(
        F.count(F.lit(1)).alias("total"), F.count("dose_adic").alias("com_dose_adic")
    )


@query("file_lineage")
def file_lineage(spark, sf):
    return metrics.frequency(
        ingested(spark, sf),
        ["versao_arquivo_origem", "formato_data_origem", "nome_sistema_origem", "run_id"], "total",
    )


@query("compact_and_cluster")
def compact_and_cluster(spark, sf):
    path = storage.fresh_dir(spark, "clustered")
    orders = cb.table(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    tables.compact_and_cluster(orders, path, ["o_orderdate", "o_orderstatus"], interleave=True)
    return tables.read_table(spark, path)


@query("interleaved_clustering")
def interleaved_clustering(spark, sf):
    """Line items laid out so that filters on ship date, part or supplier skip files; each supplier read back."""
    path = storage.fresh_dir(spark, "interleaved")
    lines = cb.table(spark, sf, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    tables.compact_and_cluster(lines, path, ["l_shipdate", "l_partkey", "l_suppkey"], files=16, interleave=True)
    stored = tables.read_table(spark, path)
    return stored.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("linhas"), F.min("l_shipdate").alias("primeira"), F.max("l_partkey").alias("maior_peca"))


_CASE_SUMS = {"total_casos": "1", "total_obitos": "CASE WHEN evolucao = 'F' THEN 1 ELSE 0 END",
              "total_graves": "CASE WHEN classi_fin <= '2' THEN 1 ELSE 0 END"}


def _updated_series(spark, sf) -> str:
    """The daily series of the current cases after two deliveries, each applied by its own changes."""
    name, root = f"casos_{uuid.uuid4().hex}", storage.fresh_dir(spark, "series")
    for delivery, source in zip((cb.FIRST_DELIVERY_BEFORE, DELIVERY), cb.deliveries(spark, sf)):
        history.merge_delivery(spark, name, root, f"d{delivery}", source, cb.stamp(delivery))
        number, changes = history.last_changes(spark, name)
        series.apply_delivery(changes, f"{root}/serie", number, "dh_ultima_atualizacao", _CASE_SUMS)
    return f"{root}/serie"


@query("incremental_daily_series")
def incremental_daily_series(spark, sf):
    days = series.read_days(spark, _updated_series(spark, sf), _CASE_SUMS)
    rated = metrics.add_rates(days, {"taxa_mortalidade": ("total_obitos", "total_casos")})
    return metrics.moving_average(rated, "total_casos", "media_movel_7d_casos")


@query("incremental_monthly_series")
def incremental_monthly_series(spark, sf):
    return series.read_months(spark, _updated_series(spark, sf), _CASE_SUMS)


@query("append_log")
def append_log(spark, sf):
    """Two quality runs appended to one history."""
    path = storage.fresh_dir(spark, "log")
    tables.append(_case_log(spark, sf, quality.completeness(cat.COMPLETENESS_COLUMNS)), path, "completude")
    tables.append(_case_log(spark, sf, quality.date_orders(cat.DATE_ORDERS)), path, "consistencia")
    return tables.read_log(spark, path)


@query("overwrite_table")
def overwrite_table(spark, sf):
    """A table rebuilt from its own contents with another schema."""
    name, root = f"dim_{uuid.uuid4().hex}", storage.fresh_dir(spark, "tables")
    tables.overwrite(star.class_dimension(cb.cases(spark, sf)), name, root)
    rebuilt = tables.read_table(spark, name).select(
        "sk_classificacao", F.col("descricao_evolucao").alias("desfecho")
    )
    tables.overwrite(rebuilt, name, root)
    return tables.read_table(spark, name)


@query("vault_checked_write")
def vault_checked_write(spark, sf):
    path = storage.fresh_dir(spark, "vault")
    vault = privacy.build_pii_vault(cb.bronze_cases(spark, sf), cb.SALT, "vault-run")
    tables.write_checked(vault, path, {"hash_caso": F.col("hash_caso").isNotNull()})
    return tables.read_table(spark, path).select("hash_caso", "nu_cpf_hash", "nm_pacient")


def _gold(spark, sf):
    """Raw cases through the stored history to the published star schema and indicators."""
    run = uuid.uuid4().hex
    root = storage.fresh_dir(spark, "stages")
    bronze_path = f"{root}/bronze"
    storage.save(cb.bronze_cases(spark, sf), bronze_path)
    stages.load_cases(
        spark, tables.read_table(spark, bronze_path), f"casos_{run}", root, f"{root}/vault", cb.SALT,
        "d1", cb.stamp(RULES_AT),
    )
    current = history.read_current(spark, f"casos_{run}", settle=True)
    return stages.build_gold(current, f"g{run}", root, "run-g", cb.as_of(), cb.stamp(RULES_AT))


@query("stages_gold")
def stages_gold(spark, sf):
    """Every published table of the case stages: rows, and the cases they account for."""
    gold = _gold(spark, sf)
    cases = {"fact": "flag_caso_srag", "agg_diarias": "total_casos", "agg_mensais": "total_casos",
             "orfaos": "orfaos", "quality": "registros_invalidos"}
    counted = [
        df.agg(F.count(F.lit(1)).alias("linhas"), F.sum(cases[n]).alias("casos")
               if n in cases else F.lit(None).cast("long").alias("casos"))
        .select(F.lit(n).alias("tabela"), "linhas", "casos")
        for n, df in gold.items()
    ]
    return reduce(DataFrame.unionByName, counted)


@query("stages_beds")
def stages_beds(spark, sf):
    root = storage.fresh_dir(spark, "stages")
    beds = stages.build_beds(
        cb.bronze_beds(spark, sf), f"b{uuid.uuid4().hex}", root, "run-b", cb.stamp(RULES_AT)
    )
    return beds["leitos_por_uf"].select("uf", "ano_mes", "uti_total_exist", "run_id", "dh_ingestao_silver")
