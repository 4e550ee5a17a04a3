"""Star schema: dimensions and fact joined on content-hash keys.

Keys are computed from the row itself, so the fact needs no join to get them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.catalogs import (
    CLASSIFICATION_LABELS, CRITERION_LABELS, FLAG_NAMES, MONTH_NAMES, OUTCOME_LABELS,
    PREGNANCY_LABELS, RACE_LABELS, SCHOOLING_LABELS, SEX_LABELS,
)
from caselake.functions import codes, dates, keys
from caselake.functions.names import ensure_column
from caselake.operators import dedup
from caselake.operators.metrics import reference_date

PLACE_KEY = ("sg_uf_residencia", "co_mun_res")
PROFILE_KEY = ("cs_sexo", "faixa_etaria", "cs_raca", "cs_gestant", "cs_escol_n")
CLASS_KEY = ("classi_fin", "criterio", "evolucao")
FACT_DATES = ("dt_sin_pri", "dt_notific", "dt_interna", "dt_entuti", "dt_saiduti", "dt_evoluca")
FACT_MEASURES = ("dias_uti", "qtd_doses_covid_registradas")


def place_key() -> Column:
    return keys.surrogate_key(*PLACE_KEY)


def profile_key() -> Column:
    return keys.surrogate_key(*PROFILE_KEY, missing={1: "Ignorado"})


def class_key() -> Column:
    return keys.surrogate_key(*CLASS_KEY)


def _calendar_columns(day: str) -> dict[str, Column]:
    return {
        "sk_tempo": keys.time_key(day),
        "ano": F.year(day),
        "mes": F.month(day),
        "ano_mes": dates.year_month(day),
        "dia": F.dayofmonth(day),
        "semana_epidemiologica": F.weekofyear(day),
        "trimestre": F.quarter(day),
        "nome_mes": codes.decode(F.month(day), MONTH_NAMES, default=None),
    }


def date_dimension(df: DataFrame, day: str = "dt_sin_pri") -> DataFrame:
    """Observed days with calendar parts (ISO week) and window markers against the newest day."""
    ref = reference_date(df, day)
    days = df.filter(F.col(day).isNotNull()).select(F.col(day).alias("data")).distinct()
    return days.withColumns(
        {
            **_calendar_columns("data"),
            "eh_ultimos_30_dias": F.col("data") >= F.date_sub(ref, 29),
            "eh_ultimos_12_meses": F.col("data") >= F.add_months(ref, -11),
        }
    )


def generate_calendar(df: DataFrame, as_of: Column, day: str = "dt_sin_pri") -> DataFrame:
    """Every day from the first date to the later of the last date and ``as_of``."""
    span = df.agg(F.min(day).alias("a"), F.greatest(F.max(day), as_of).alias("b"))
    days = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("data"))
    calendar = days.withColumns(_calendar_columns("data"))
    week = F.lpad(F.weekofyear("data").cast("string"), 2, "0")
    return calendar.withColumns(
        {
            "semana_epidemiologica": F.concat(F.year("data").cast("string"), F.lit("-"), week),
            "nome_mes": codes.decode_map(F.month("data"), MONTH_NAMES),
            "eh_ultimos_30_dias": F.col("data") >= F.date_sub(as_of, 30),
            "eh_ultimos_12_meses": F.col("data") >= F.add_months(as_of, -12),
        }
    )


PLACE_ATTRIBUTES = ("id_mn_resi", "sg_uf_inte", "co_mu_inte", "id_mn_inte")


def place_dimension(df: DataFrame, attributes: Sequence[str] = PLACE_ATTRIBUTES) -> DataFrame:
    """Residence places with the name and the hospital place of one of their cases.

    Where cases of a place differ, the attributes come together from the case whose values sort
    first (absent ones before all others), so every row is a combination that occurs. Cases are
    reduced to distinct combinations by hash before that. Attributes a source lacks read NULL.
    """
    for a in attributes:
        df = ensure_column(df, a, "string")
    combos = dedup.distinct_projection(
        df,
        [F.coalesce(F.col("sg_uf_residencia"), F.lit("n/a")).alias("sg_uf"),
         F.coalesce(F.col("co_mun_res"), F.lit("n/a")).alias("co_mun_residencia"), *attributes],
    )
    places = combos.groupBy("sg_uf", "co_mun_residencia").agg(
        F.min_by(F.struct(*attributes), F.array(*[F.coalesce(F.col(a).cast("string"), F.lit("")) for a in attributes]))
        .alias("_one")
    )
    return places.select(
        keys.surrogate_key("sg_uf", "co_mun_residencia").alias("sk_localidade"), "sg_uf", "co_mun_residencia", "_one.*"
    )


def profile_dimension(df: DataFrame) -> DataFrame:
    """Distinct person profiles with their labels."""
    combos = dedup.distinct_projection(
        df,
        [F.coalesce(F.col("cs_sexo"), F.lit("n/a")).alias("cs_sexo"),
         F.coalesce(F.col("faixa_etaria"), F.lit("Ignorado")).alias("faixa_etaria"),
         "cs_raca", "cs_gestant", "cs_escol_n"],
    )
    return combos.withColumns(
        {
            "sk_perfil": profile_key(),
            "descricao_sexo": codes.decode("cs_sexo", SEX_LABELS),
            "descricao_raca": codes.decode("cs_raca", RACE_LABELS),
            "descricao_gestant": codes.decode("cs_gestant", PREGNANCY_LABELS),
            "descricao_escol": codes.decode("cs_escol_n", SCHOOLING_LABELS),
        }
    )


def class_dimension(df: DataFrame) -> DataFrame:
    """Distinct classification, criterion and outcome combinations with their labels."""
    return dedup.distinct_projection(df, CLASS_KEY).withColumns(
        {
            "sk_classificacao": class_key(),
            "descricao_classificacao_final": codes.decode("classi_fin", CLASSIFICATION_LABELS),
            "descricao_criterio": codes.decode("criterio", CRITERION_LABELS),
            "descricao_evolucao": codes.decode("evolucao", OUTCOME_LABELS),
        }
    )


FACT_VALUES = ("hash_caso", *FACT_DATES, *FACT_MEASURES, *FLAG_NAMES, "dh_ultima_atualizacao")


def _fact_columns() -> list[Column]:
    return [
        keys.surrogate_key("hash_caso").alias("sk_caso"),
        F.col("hash_caso"),
        keys.time_key("dt_sin_pri").alias("sk_tempo"),
        place_key().alias("sk_localidade"),
        profile_key().alias("sk_perfil"),
        class_key().alias("sk_classificacao"),
        *[F.col(c) for c in FACT_VALUES[1:]],
    ]


def fact_rows(current: DataFrame) -> DataFrame:
    """Fact projection of the current case versions: keys, dates, measures, flags."""
    return current.select(*_fact_columns())


def fact_table(current: DataFrame) -> DataFrame:
    """One fact row per case: the most recently updated one.

    What the keys are computed from is shuffled, not the keys: five digests a row.
    """
    needed = dict.fromkeys((*FACT_VALUES, *PLACE_KEY, *PROFILE_KEY, *CLASS_KEY))
    rows = current.select(*needed, F.xxhash64(*_fact_columns()).alias("_tie"))
    digests = keys.digest_columns(rows)
    kept = dedup.keep_latest(keys.pack_digests(rows, digests), ["hash_caso"], "dh_ultima_atualizacao", ties=["_tie"])
    return fact_rows(keys.unpack_digests(kept, digests))


def orphan_counts(fact: DataFrame, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Per foreign key: fact rows whose non-NULL key is missing in the dimension.

    One pass over the fact for all keys. It is counted per key before the
    join, so a key shared by a third of all rows joins as a single row.
    """
    entries = [
        F.struct(F.lit(k).alias("chave"), F.col(k).cast("string").alias("valor")) for k in dimensions
    ]
    used = fact.select(F.inline(F.array(*entries))).groupBy("chave", "valor").agg(
        F.count(F.lit(1)).alias("_n")
    )
    known = reduce(DataFrame.unionByName, [
        d.select(F.lit(k).alias("chave"), F.col(k).cast("string").alias("valor")).distinct()
        for k, d in dimensions.items()
    ]).withColumn("_known", F.lit(True))
    missing = F.col("valor").isNotNull() & F.col("_known").isNull()
    return used.join(known, ["chave", "valor"], "left").groupBy("chave").agg(
        F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias("orfaos")
    )


def rollup_by_dimension(
    fact: DataFrame, dimension: DataFrame, key: str, attributes: Sequence[str],
    sums: Mapping[str, str], by: Sequence[Column] = (),
) -> DataFrame:
    """Sums by dimension attributes (NULL where the key has no dimension row).

    Partial sums per key meet the dimension, not fact rows.
    """
    names = [f"_by{i}" for i in range(len(by))]
    partial = fact.groupBy(key, *[c.alias(n) for c, n in zip(by, names)]).agg(
        *[F.sum(c).alias(n) for n, c in sums.items()]
    )
    joined = partial.join(dimension.select(key, *attributes), key, "left")
    return joined.groupBy(*attributes, *names).agg(*[F.sum(n).alias(n) for n in sums])


def null_safe_left_join(
    left: DataFrame, right: DataFrame, on: Mapping[str, str], values: Sequence[str]
) -> DataFrame:
    """Left join on keys (left name to right name) where NULL matches NULL."""
    renamed = right.select(
        *[F.col(r).alias(f"_r_{r}") for r in on.values()], *values
    )
    condition = None
    for l, r in on.items():
        term = left[l].eqNullSafe(renamed[f"_r_{r}"])
        condition = term if condition is None else condition & term
    return left.join(renamed, condition, "left").drop(*[f"_r_{r}" for r in on.values()])
