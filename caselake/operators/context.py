"""Text guards, article context and audit log over whole text tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselake.catalogs import (
    BLOCKED_TERMS_AGENT, CNS_BOUNDED, CPF_BOUNDED, MISLEADING_TERMS,
    RELIABILITY_DEFAULT, SOURCE_RELIABILITY, STATUS_BLOCKED, STATUS_OK,
)
from caselake.functions import text as tx
from caselake.operators import dedup


def flag_blocked_terms(
    df: DataFrame, text: str, terms: Iterable[str] = BLOCKED_TERMS_AGENT, whole_words: bool = False
) -> DataFrame:
    """Add ``termo_bloqueado`` (first term hit) and ``aprovado``.

    The lower-cased text is a projection of its own, computed once for all terms.
    """
    lowered = df.withColumn("_lower", F.lower(text))
    found = lowered.withColumn("termo_bloqueado", tx.first_term("_lower", terms, whole_words))
    return found.withColumn("aprovado", F.col("termo_bloqueado").isNull()).drop("_lower")


def detect_pii(
    df: DataFrame, text: str, patterns: Mapping[str, str] = {"cpf": CPF_BOUNDED, "cns": CNS_BOUNDED}
) -> DataFrame:
    """Add the number of matches per pattern and ``contem_pii``."""
    counted = df.withColumns(
        {f"n_{name}": F.regexp_count(text, F.lit(p)) for name, p in patterns.items()}
    )
    hits = F.greatest(F.lit(0), *[F.col(f"n_{name}") for name in patterns])
    return counted.withColumn("contem_pii", hits > 0)


def correct_terms(
    df: DataFrame, text: str, corrections: Mapping[str, str] = MISLEADING_TERMS,
    output: str = "texto_corrigido",
) -> DataFrame:
    """Add the text with each wrong wording replaced in turn, ignoring case.

    The first replacement needs a wording that stands in the original text, so
    texts without any (one plain search each) skip the regular expressions.
    """
    corrected = tx.correct_terms(text, corrections)
    if not all(tx.foldable(wrong) for wrong in corrections):
        return df.withColumn(output, corrected)
    searched = df.withColumn("_folded", tx.fold_case(text))
    hit = tx.mentions_any("_folded", corrections)
    return searched.withColumn(output, F.when(hit, corrected).otherwise(F.col(text))).drop("_folded")


def length_gate(df: DataFrame, text: str) -> DataFrame:
    """Add ``motivo_tamanho`` (NULL when the length is fine) and ``tamanho_ok``."""
    gated = df.withColumn("motivo_tamanho", tx.length_problem(text))
    return gated.withColumn("tamanho_ok", F.col("motivo_tamanho").isNull())


def guard_answers(df: DataFrame, text: str) -> DataFrame:
    """Output guard: blocked (text withheld) when personal numbers occur, else corrected wording."""
    checked = df.withColumn("aprovado", ~tx.matches_any(text, (CPF_BOUNDED, CNS_BOUNDED)))
    corrected = correct_terms(checked, text, output="_corrected")
    return corrected.withColumn("texto", F.when(F.col("aprovado"), F.col("_corrected"))).drop("_corrected")


def title_mentions(title: Column | str, keywords: Sequence[str]) -> Column:
    return tx.blocked_term(title, keywords).isNotNull()


def prepare_context(
    articles: DataFrame,
    order: Sequence[str | Column],
    keywords: Sequence[str] | None = None,
    cap: int | None = None,
) -> DataFrame:
    """Articles for the news log: one per whole address, stable id, source reliability, whole texts.

    ``cap`` is for callers that want a top-k: the first articles in ``order``.
    """
    if keywords:
        articles = articles.filter(title_mentions("titulo", keywords))
    unique = dedup.keep_first(articles, ["url"], [*order, F.xxhash64(*articles.columns)])
    if cap is not None:
        unique = unique.orderBy(*order, "url").limit(cap)
    return unique.withColumns(
        {
            "news_id": F.md5("url"),
            "confiabilidade_fonte": tx.source_reliability(
                "url", SOURCE_RELIABILITY, RELIABILITY_DEFAULT
            ),
            "usado_no_relatorio": F.lit(True),
        }
    )


def news_log_rows(context: DataFrame, run_id: Column, executed_at: Column) -> DataFrame:
    """Prepared articles in the schema of the news log; columns a source lacks are empty."""
    def given(name: str) -> Column:
        return F.col(name) if name in context.columns else F.lit("").alias(name)

    return context.select(
        "news_id", run_id.alias("run_id"), given("termo_busca"), "titulo", given("fonte"),
        given("data_publicacao"), "url", given("resumo"), "confiabilidade_fonte",
        "usado_no_relatorio", executed_at.alias("dh_consulta"),
    )


def audit_rows(
    interactions: DataFrame, run_id: Column, executed_at: Column, identity: Sequence[str],
) -> DataFrame:
    """Audit log rows in one schema, texts and lists whole.

    Expects ``usuario``, ``pergunta``, ``resposta``, ``bloqueado`` and the list
    columns ``tools``, ``queries``, ``fontes``, ``guardrails``; lists are
    written as JSON text. The id is a hash of run and identity columns, so a
    repeated write is recognisable.
    """
    return interactions.select(
        F.sha2(F.concat_ws("||", run_id, *[F.col(c).cast("string") for c in identity]), 256)
        .alias("audit_id"),
        run_id.alias("run_id"),
        "usuario",
        "pergunta",
        F.to_json("tools").alias("tools_acionadas"),
        F.to_json("queries").alias("queries_executadas"),
        F.to_json("fontes").alias("fontes_noticias_consultadas"),
        F.col("resposta").alias("resposta_resumida"),
        F.to_json("guardrails").alias("guardrails_acionados"),
        F.when(F.col("bloqueado"), STATUS_BLOCKED).otherwise(STATUS_OK).alias("status_execucao"),
        executed_at.alias("dh_execucao"),
    )
