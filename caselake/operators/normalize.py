"""Typing and derivation of case rows: one projection per step."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from caselake.catalogs import (
    CASE_FLAGS, DATE_COLUMNS, DATE_FORMATS, DOSE_COLUMNS, INT_COLUMNS, WATERMARK_COLUMNS, Flag,
)
from caselake.functions import codes, dates, text


def _present(df: DataFrame, names: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [n for n in names if n in have]


def cast_ints(df: DataFrame, columns: Iterable[str] = INT_COLUMNS) -> DataFrame:
    """Integer typing of the listed columns that exist; text that is no integer becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast("int") for c in _present(df, columns)})


def parse_dates(
    df: DataFrame, columns: Iterable[str] = DATE_COLUMNS, formats: Sequence[str] = DATE_FORMATS
) -> DataFrame:
    """Date typing of the listed text columns that exist; columns that are dates already stay."""
    text_columns = {f.name for f in df.schema if isinstance(f.dataType, StringType)}
    return df.withColumns(
        {c: dates.parse_date_multi(c, formats) for c in columns if c in text_columns}
    )


def normalize_text(df: DataFrame, upper: Iterable[str] = (), title: Iterable[str] = ()) -> DataFrame:
    changes = {c: text.clean_upper(c) for c in _present(df, upper)}
    changes |= {c: text.clean_title(c) for c in _present(df, title)}
    return df.withColumns(changes)


def derive_flags(df: DataFrame, rules: Iterable[Flag] = CASE_FLAGS) -> DataFrame:
    return df.withColumns({rule.name: codes.flag(rule) for rule in rules})


def derive_case_columns(df: DataFrame, dose_columns: Iterable[str] = DOSE_COLUMNS) -> DataFrame:
    """Days in intensive care and recorded doses; age in years and its band when an age is given."""
    derived = {
        "dias_uti": dates.duration_days("dt_entuti", "dt_saiduti"),
        "qtd_doses_covid_registradas": codes.count_present(_present(df, dose_columns)),
    }
    if "nu_idade_n" in df.columns:
        age = codes.normalize_age("nu_idade_n", "tp_idade")
        derived |= {"idade_anos_calculada": age, "faixa_etaria": codes.bucketize(age)}
    return df.withColumns(derived)


def type_cases(df: DataFrame) -> DataFrame:
    """Raw all-string case rows to typed rows with derived columns, flags and watermark."""
    typed = normalize_text(parse_dates(cast_ints(df)), upper=("sg_uf_not", "sg_uf", "cs_sexo"))
    typed = typed.withColumnRenamed("sg_uf", "sg_uf_residencia")
    typed = derive_flags(derive_case_columns(typed))
    watermark = dates.first_timestamp(*_present(typed, WATERMARK_COLUMNS))
    return typed.withColumn("dh_ultima_atualizacao", watermark)
