"""Consumer views: the latest snapshot with its alerts, the trailing series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.catalogs import KPI_CAVEATS
from caselake.functions import codes
from caselake.operators import metrics, quality

RATE_COLUMNS = (
    "taxa_aumento_casos_7d", "taxa_mortalidade_30d", "taxa_uso_uti_30d",
    "taxa_vacinacao_gripe_30d", "taxa_vacinacao_covid_30d",
)


def kpi_with_alerts(kpi: DataFrame, log: DataFrame) -> DataFrame:
    """Newest snapshot row, rates as percentages, next to the alerts of the latest quality run.

    The alert text is a one-row scalar subquery, bounded by the rules of a run.
    """
    alerts = quality.alert_summary(log).select(F.struct("nivel_geral", "alertas")).scalar()
    latest = kpi.orderBy(F.desc("data_execucao")).limit(1)
    growth_caveat = F.concat(F.lit("taxa_aumento: "), F.col("obs_aumento"))
    return latest.select(
        "data_referencia", "data_maxima_dataset", "defasagem_dias",
        "casos_ultimos_7_dias", "casos_7_dias_anteriores",
        "casos_ultimos_30_dias", "obitos_ultimos_30_dias",
        *[codes.scale_percent(c).alias(f"{c}_pct") for c in RATE_COLUMNS],
        F.col("observacao_confiabilidade").alias("confiabilidade"),
        alerts.getField("nivel_geral").alias("nivel_geral"),
        alerts.getField("alertas").alias("alertas_qualidade"),
        F.concat_ws("; ", *[F.lit(c) for c in KPI_CAVEATS], growth_caveat).alias("limitacoes"),
    )


def daily_series(daily: DataFrame, ref: Column, days: int = 30) -> DataFrame:
    return metrics.trailing_days(daily, days=days, ref=ref).select(
        "data_referencia", "total_casos", "total_obitos", "total_uti",
        codes.scale_percent("taxa_mortalidade").alias("taxa_mortalidade_pct"),
        codes.scale_percent("taxa_uso_uti").alias("taxa_uso_uti_pct"),
        F.round("media_movel_7d_casos", 1).alias("media_movel_7d"),
    ).orderBy("data_referencia")


def monthly_series(monthly: DataFrame, ref: Column, months: int = 12) -> DataFrame:
    return metrics.trailing_months(monthly, ref, months).select(
        "ano_mes", "total_casos", "total_obitos", "total_uti", "total_hospitalizados",
        codes.scale_percent("taxa_mortalidade").alias("taxa_mortalidade_pct"),
        codes.scale_percent("taxa_uso_uti").alias("taxa_uso_uti_pct"),
    ).orderBy("ano_mes")
