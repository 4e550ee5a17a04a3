"""Single-pass data-quality rules.

All rules that look at one row, newest dates and summed ratios share one
aggregate over the data. Uniqueness counts each key in its own group-by, where
partial counts keep a repeated key from piling up in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.catalogs import (
    ALERT_SEVERITIES, COMPLETENESS_COLUMNS, CONSISTENCY_PREFIX, DATE_ORDERS, DOMAINS,
    FRESH_COLUMNS, FRESHNESS_LIMIT_DAYS, IMPACT_FALLBACK, IMPACTS, INHERITED_PREFIX,
    RECOMMENDATION_FALLBACK, RECOMMENDATIONS, SEVERITY_OK, SEVERITY_ORDER, UNIQUE_KEYS,
)
from caselake.functions import as_col, codes, dates
from caselake.operators import dedup

LOG_COLUMNS = (
    "run_id", "camada", "tabela_avaliada", "regra_qualidade", "dimensao_dmbok",
    "coluna_avaliada", "total_registros", "registros_validos", "registros_invalidos",
    "percentual_validade", "percentual_invalidade", "severidade", "observacao", "dh_execucao",
)


@dataclass(frozen=True)
class RowRule:
    """Valid when ``valid`` holds for the row.

    ``derived`` are columns the condition reads; all rules that name the same
    one share its computation.
    """

    name: str
    dimension: str
    column: str
    valid: Column
    note: str | None = None
    derived: tuple[tuple[str, Column], ...] = ()


@dataclass(frozen=True)
class UniqueRule:
    """Rows with a complete key against distinct keys."""

    name: str
    dimension: str
    column: str
    keys: tuple[str, ...]
    note: str | None = None


@dataclass(frozen=True)
class FreshRule:
    """Valid when the newest date lags the run date by no more than ``limit`` days."""

    name: str
    dimension: str
    column: str
    date: Column
    limit: int = FRESHNESS_LIMIT_DAYS
    note: str | None = None
    derived: tuple[tuple[str, Column], ...] = ()


@dataclass(frozen=True)
class RatioRule:
    """Valid when the rounded ratio of two sums lies in [low, high]."""

    name: str
    dimension: str
    column: str
    numerator: str
    denominator: str
    low: float
    high: float
    note: str | None = None


Rule = RowRule | UniqueRule | FreshRule | RatioRule


def filled(column: Column | str) -> Column:
    column = as_col(column)
    return column.isNotNull() & (F.trim(column.cast("string")) != "")


def completeness(columns: Iterable[str], notes: Mapping[str, str] | None = None) -> list[Rule]:
    notes = notes or {}
    return [RowRule(f"Completude - {c}", "Completude", c, filled(c), notes.get(c)) for c in columns]


def domains(allowed: Mapping[str, Sequence[str]]) -> list[Rule]:
    """NULL is valid; any other value has to be listed once trimmed and upper-cased."""
    return [
        RowRule(f"Validade Domínio - {c}", "Validade", c,
                F.col(c).isNull() | F.trim(F.upper(F.col(c).cast("string"))).isin(*values))
        for c, values in allowed.items()
    ]


def _parsed(column: str, parse: Callable[[str], Column]) -> tuple[str, Column]:
    return f"_{parse.__name__}_{column}", parse(column)


def date_orders(orders: Iterable[tuple[str, str, str]],
                parse: Callable[[str], Column] = dates.parse_date_prefix) -> list[Rule]:
    """Earlier date not after the later one; an absent or unreadable date is valid."""
    rules = []
    for earlier, later, name in orders:
        derived = (_parsed(earlier, parse), _parsed(later, parse))
        involved = name.replace(">=", "<=").split(" <= ")
        rules.append(RowRule(
            f"Consistência Temporal - {name}", "Consistência", " / ".join(involved),
            F.coalesce(F.col(derived[0][0]) <= F.col(derived[1][0]), F.lit(True)), derived=derived,
        ))
    return rules


def unique_keys(keys: Iterable[tuple[str, ...]]) -> list[Rule]:
    return [UniqueRule(f"Unicidade - {' + '.join(k)}", "Unicidade", " / ".join(k), k) for k in keys]


def freshness(columns: Iterable[str], parse: Callable[[str], Column] = dates.parse_date_prefix,
              limit: int = FRESHNESS_LIMIT_DAYS) -> list[Rule]:
    rules = []
    for c in columns:
        derived = _parsed(c, parse)
        rules.append(FreshRule(f"Atualidade - {c}", "Atualidade", c, F.col(derived[0]), limit,
                               derived=(derived,)))
    return rules


def case_rules() -> list[Rule]:
    """The 40 rules of the raw case table."""
    return [
        *completeness(COMPLETENESS_COLUMNS), *domains(DOMAINS), *date_orders(DATE_ORDERS),
        *unique_keys(UNIQUE_KEYS), *freshness(FRESH_COLUMNS),
    ]


def fact_rules() -> list[Rule]:
    """Checks of the fact: keys, plausible rates, freshness."""
    def rate(name, num, den, high):
        return RatioRule(f"Validade - {name}", "Acurácia", f"{num} / {den}", num, den, 0.0, high)

    return [
        RowRule("Completude - sk_tempo", "Completude", "sk_tempo", F.col("sk_tempo").isNotNull()),
        RowRule("Completude - sk_classificacao", "Completude", "sk_classificacao",
                F.col("sk_classificacao").isNotNull()),
        rate("taxa_mortalidade", "flag_obito_srag", "flag_evolucao_informada", 0.60),
        rate("taxa_uso_uti", "flag_uti", "flag_hospitalizado", 1.0),
        rate("taxa_vacinacao_gripe", "flag_vacinado_gripe", "flag_info_vacina_gripe", 1.0),
        rate("taxa_vacinacao_covid", "flag_vacinado_covid", "flag_info_vacina_covid", 1.0),
        FreshRule("Atualidade - dt_sin_pri", "Atualidade", "dt_sin_pri", F.col("dt_sin_pri")),
    ]


def _entry(rule: Rule, total: Column, valid: Column) -> Column:
    return F.struct(
        F.lit(rule.name).alias("regra_qualidade"),
        F.lit(rule.dimension).alias("dimensao_dmbok"),
        F.lit(rule.column).alias("coluna_avaliada"),
        F.lit(rule.note).cast("string").alias("observacao"),
        total.cast("long").alias("total_registros"),
        valid.cast("long").alias("registros_validos"),
    )


def _single_pass(df: DataFrame, rules: Sequence[Rule], as_of: Column, by: Sequence[str]) -> DataFrame:
    """All rules in one aggregate over one scan.

    Distinct keys are counted in the same pass: a row is repeated once per key
    rule with the key's columns only, and reduced by key before the shuffle, so
    a key that most rows share costs one row per map task.
    """
    derived = dict(d for rule in rules for d in getattr(rule, "derived", ()))
    aggregates, entries = [F.count(F.lit(1)).alias("_n")], []
    for i, rule in enumerate(rules):
        name = f"_r{i}"
        if isinstance(rule, RowRule):
            aggregates.append(F.count_if(rule.valid).alias(name))
            entries.append(_entry(rule, F.col("_n"), F.col(name)))
        elif isinstance(rule, FreshRule):
            aggregates.append(F.max(rule.date).alias(name))
            fresh = F.datediff(as_of, F.col(name)) <= rule.limit
            entries.append(_entry(rule, F.lit(1), F.coalesce(fresh, F.lit(False)).cast("int")))
        elif isinstance(rule, UniqueRule):
            complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in rule.keys])
            aggregates += [F.count_if(complete).alias(f"{name}t"), F.count_distinct(*rule.keys).alias(f"{name}d")]
            entries.append(_entry(rule, F.col(f"{name}t"), F.col(f"{name}d")))
        else:
            aggregates += [F.sum(rule.numerator).alias(f"{name}n"),
                           F.sum(rule.denominator).alias(f"{name}d")]
            inside = codes.safe_rate(f"{name}n", f"{name}d").between(rule.low, rule.high)
            entries.append(_entry(rule, F.lit(1), F.coalesce(inside, F.lit(False)).cast("int")))
    grouped = df.withColumns(derived).groupBy(*by).agg(*aggregates)
    return grouped.select(*by, F.inline(F.array(*entries)))


def run_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    layer: str,
    table: str,
    as_of: Column,
    executed_at: Column,
    run_id: str | None = None,
    by_run: str | None = None,
) -> DataFrame:
    """One log row per rule, or per rule and run when ``by_run`` names the run column.

    ``executed_at`` stamps all rules of a run alike.
    """
    by = [by_run] if by_run else []
    checked = _single_pass(df, rules, as_of, by)
    total, valid = F.col("total_registros"), F.col("registros_validos")
    invalid = total - valid

    def share(part: Column) -> Column:
        return F.when(total > 0, F.round(part / total, 6)).otherwise(0.0)

    return checked.withColumns(
        {
            "run_id": F.col(by_run) if by_run else F.lit(run_id),
            "camada": F.lit(layer),
            "tabela_avaliada": F.lit(table),
            "registros_invalidos": invalid,
            "percentual_validade": share(valid),
            "percentual_invalidade": share(invalid),
            "severidade": codes.severity(share(valid)),
            "dh_execucao": executed_at,
        }
    ).select(*LOG_COLUMNS)


def run_summary(df: DataFrame, rules: Sequence[Rule], executed_at: Column, by_run: str) -> DataFrame:
    """What :func:`run_rules` will log per run, without evaluating a rule: run_id, dimensao_dmbok, dh_execucao.

    Run selection needs no more; the rules then run over the chosen run's rows.
    """
    covered = F.array(*[F.lit(d) for d in dict.fromkeys(rule.dimension for rule in rules)])
    return df.select(F.col(by_run).alias("run_id")).distinct().select(
        "run_id", F.explode(covered).alias("dimensao_dmbok"), executed_at.alias("dh_execucao"))


def assert_rules(df: DataFrame, rules: Sequence[Rule], as_of: Column | None = None) -> None:
    """Raise when a rule has invalid rows. One job; its result holds one row per rule."""
    now = F.current_timestamp()
    log = run_rules(df, rules, "", "", F.current_date() if as_of is None else as_of, now, "assert")
    failed = log.filter(F.col("registros_invalidos") > 0).select(
        "regra_qualidade", "registros_invalidos"
    ).collect()
    if failed:
        raise ValueError("; ".join(f"{r[0]}: {r[1]} invalid" for r in failed))


def alerts(log: DataFrame) -> DataFrame:
    return log.filter(F.col("severidade").isin(*ALERT_SEVERITIES))


def inherit_alerts(
    log: DataFrame, run_id: Column, executed_at: Column,
    impacts: Mapping[str, str] = IMPACTS, recommendations: Mapping[str, str] = RECOMMENDATIONS,
    runs: DataFrame | None = None,
) -> DataFrame:
    """Critical and high alerts of the latest run, with impact and recommendation by column."""
    latest = alerts(dedup.latest_run(log, "run_id", "dh_execucao", runs))
    fallback = F.coalesce(F.col("observacao"), F.lit(IMPACT_FALLBACK))
    return latest.withColumns(
        {
            "run_id": run_id,
            "regra_qualidade": F.concat(F.lit(INHERITED_PREFIX), F.col("regra_qualidade")),
            "impacto_analitico": codes.decode("coluna_avaliada", impacts, fallback),
            "recomendacao_tratamento": codes.decode(
                "coluna_avaliada", recommendations, RECOMMENDATION_FALLBACK
            ),
            "dh_execucao": executed_at,
        }
    ).drop("observacao")


def _severity_counts() -> dict[str, Column]:
    names = ("criticos", "altos", "medios", "baixos", "aceitaveis")
    return {
        n: F.count_if(F.col("severidade") == s) for n, s in zip(names, SEVERITY_ORDER)
    }


def severity_summary(log: DataFrame) -> DataFrame:
    """Rules per severity (zero where absent) and the worst of the three upper classes present."""
    counts = log.agg(*[c.alias(n) for n, c in _severity_counts().items()])
    return counts.withColumn(
        "nivel_geral",
        F.when(F.col("criticos") > 0, "CRÍTICO")
        .when(F.col("altos") > 0, "ALTO")
        .when(F.col("medios") > 0, "MÉDIO")
        .otherwise(SEVERITY_OK),
    )


def alert_summary(log: DataFrame) -> DataFrame:
    """Critical and high counts, overall level and the alerts as text, worst first, of one run's log.

    Lists are built per run, so the rules of a run bound them; a log with alerts
    of several runs raises an error.
    """
    line = F.concat_ws(" | ", "severidade", "coluna_avaliada",
                       F.format_string("%.1f", F.round(F.col("percentual_validade") * 100, 1)))
    items = F.array_sort(F.collect_list(
        F.struct(codes.severity_rank("severidade").alias("r"), F.col("regra_qualidade").alias("k"),
                 line.alias("t"))
    ))
    by_run = alerts(log).groupBy("run_id").agg(
        F.count_if(F.col("severidade") == "CRÍTICO").alias("criticos"),
        F.count_if(F.col("severidade") == "ALTO").alias("altos"),
        F.concat_ws("; ", F.transform(items, lambda x: x["t"])).alias("alertas"),
    )

    def only(value: Column, empty: int | str) -> Column:
        several = F.raise_error(F.lit("the log holds alerts of several runs; choose one first"))
        return F.when(F.count(F.lit(1)) > 1, several).otherwise(F.coalesce(F.max(value), F.lit(empty)))

    counted = by_run.agg(
        only(F.col("criticos"), 0).cast("long").alias("criticos"),
        only(F.col("altos"), 0).cast("long").alias("altos"),
        only(F.col("alertas"), "").alias("alertas"),
    )
    return counted.withColumn(
        "nivel_geral",
        F.when(F.col("criticos") > 0, "CRÍTICO").when(F.col("altos") > 0, "ALTO")
        .otherwise(SEVERITY_OK),
    )


def dimension_scores(log: DataFrame, layers: Sequence[str] = ("Bronze", "Gold")) -> DataFrame:
    """Mean validity per quality dimension, one column per layer."""
    return log.groupBy("dimensao_dmbok").agg(
        *[F.round(F.avg(F.when(F.col("camada") == layer, F.col("percentual_validade"))), 6)
          .alias(f"score_{layer.lower()}") for layer in layers]
    )


def run_history(log: DataFrame, min_rules: int = 3) -> DataFrame:
    """Per run: newest timestamp, severity counts, mean validity; runs with few rules are left out."""
    return (
        log.groupBy("camada", "run_id")
        .agg(
            F.max("dh_execucao").alias("dh_execucao"),
            *[c.alias(n) for n, c in _severity_counts().items()],
            F.round(F.avg("percentual_validade"), 6).alias("score_medio"),
            F.count(F.lit(1)).alias("total_regras"),
        )
        .filter(F.col("total_regras") >= min_rules)
    )


def completeness_extract(log: DataFrame) -> DataFrame:
    return log.filter(F.col("dimensao_dmbok") == "Completude").orderBy(
        "percentual_validade", "coluna_avaliada"
    )


def validity_extract(log: DataFrame) -> DataFrame:
    """One row per column, worst first."""
    rows = log.filter(F.col("dimensao_dmbok") == "Validade")
    return dedup.keep_first(rows, ["coluna_avaliada"], ["regra_qualidade", "run_id"]).orderBy(
        F.desc("percentual_invalidade"), "coluna_avaliada"
    )


def consistency_extract(log: DataFrame) -> DataFrame:
    """Temporal rules without their common prefix, worst first."""
    rows = log.filter(F.col("dimensao_dmbok") == "Consistência")
    return rows.withColumn(
        "regra_qualidade", F.regexp_replace("regra_qualidade", CONSISTENCY_PREFIX, "")
    ).orderBy("percentual_validade", "regra_qualidade")


def accuracy_extract(log: DataFrame) -> DataFrame:
    return log.filter(F.col("dimensao_dmbok").isin("Acurácia", "Atualidade"))


def severity_ordered(log: DataFrame) -> DataFrame:
    return log.orderBy(codes.severity_rank("severidade"), "percentual_validade", "regra_qualidade")
