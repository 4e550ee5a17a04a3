import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from caselake import catalogs as cat
from caselake.functions import codes, dates, keys, names, text


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


DATES = [
    "2025-01-15", "2025-01-15T00:00:00.000Z", "2025-01-15T00:00:00.0Z", "2025-01-15T23:59:59Z",
    "20250115", "2025-02-30", "20251301", "2025-1-15", " 2025-01-15", "2025-01-15 ",
    "2025-01-15T24:00:00Z", "2025-01-15T00:60:00Z", "2025-01-15T00:00:00", "2025-01-15\n",
    "2024-02-29", "2023-02-29", "garbage", "", None,
]


def test_parse_date_multi_equals_formatter(spark):
    plain = F.coalesce(*[F.try_to_date("v", f) for f in cat.DATE_FORMATS])
    assert column(spark, DATES, dates.parse_date_multi("v")) == column(spark, DATES, plain)


def test_parse_date_multi_values(spark):
    day = dt.date(2025, 1, 15)
    assert column(spark, DATES, dates.parse_date_multi("v"))[:7] == [day] * 5 + [None, None]


def test_parse_date_with_unusual_pattern(spark):
    assert column(spark, ["15 Jan 2025", "x"], dates.parse_date_multi("v", ["dd MMM yyyy"])) == [
        dt.date(2025, 1, 15), None]


def test_parse_date_prefix(spark):
    got = column(spark, ["2025-01-15T10:00:00.000Z", "2025-01-15", "20250115", None],
                 dates.parse_date_prefix("v"))
    assert got == [dt.date(2025, 1, 15)] * 2 + [None, None]


def test_period_parts(spark):
    parts = dates.period_parts("v")
    got = column(spark, [202501, None], F.struct(*[e.alias(n) for n, e in parts.items()]), "int")
    assert tuple(got[0]) == (2025, 1, "2025-01") and tuple(got[1]) == (None, None, None)


@pytest.mark.parametrize("value,unit,age,band", [
    (4, 3, 4.0, "00-04"), (5, 3, 5.0, "05-11"), (11, 3, 11.0, "05-11"), (12, 3, 12.0, "12-17"),
    (17, 3, 17.0, "12-17"), (18, 3, 18.0, "18-29"), (29, 3, 29.0, "18-29"), (30, 3, 30.0, "30-39"),
    (79, 3, 79.0, "70-79"), (80, 3, 80.0, "80+"), (7, 2, 0.6, "00-04"), (60, 2, 5.0, "05-11"),
    (400, 1, 1.1, "00-04"), (30, 9, None, "Ignorado"), (None, 3, None, "Ignorado"),
    (-1, 3, -1.0, "00-04"), (30, None, None, "Ignorado"),
])
def test_age(spark, value, unit, age, band):
    df = spark.createDataFrame([(value, unit)], "v int, u int")
    years = codes.normalize_age("v", "u")
    assert tuple(df.select(years, codes.bucketize(years)).first()) == (age, band)


def test_decode(spark):
    assert column(spark, [1, 5, 7, None], codes.decode("v", cat.RACE_LABELS), "int") == [
        "Branca", "Indígena", "Não informado", "Não informado"]
    assert column(spark, [1, 5, 7, None], codes.decode_map("v", cat.RACE_LABELS), "int") == [
        "Branca", "Indígena", None, None]


def test_flags(spark):
    rows = [(2, 1, None), (9, 2, dt.date(2025, 1, 1)), (None, None, None)]
    df = spark.createDataFrame(rows, "evolucao int, hospital int, dt_interna date")
    wanted = [f for f in cat.CASE_FLAGS if f.name in (
        "flag_caso_srag", "flag_obito_srag", "flag_evolucao_informada", "flag_hospitalizado")]
    got = df.select(*[codes.flag(f).alias(f.name) for f in wanted]).collect()
    assert [tuple(r) for r in got] == [(1, 1, 1, 1), (1, 0, 0, 1), (1, 0, 0, 0)]


def test_severity_limits(spark):
    got = column(spark, [0.7999, 0.8, 0.9, 0.95, 0.99, 1.0], codes.severity("v"), "double")
    assert got == ["CRÍTICO", "ALTO", "MÉDIO", "BAIXO", "ACEITÁVEL", "ACEITÁVEL"]


def test_safe_rate(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (0, 5)], "n int, d int")
    assert [r[0] for r in df.select(codes.safe_rate("n", "d")).collect()] == [0.3333, None, 0.0]


def test_pseudonymize_is_salted_sha256(spark):
    got = column(spark, ["ana", None], keys.pseudonymize("v", "s"))
    assert got == [hashlib.sha256(b"s||ana").hexdigest(), hashlib.sha256(b"s||").hexdigest()]


def test_natural_key_falls_back_for_blank_and_null(spark):
    df = spark.createDataFrame([("7", "a"), (" ", "a"), (None, "a"), (None, "b")], "id string, x string")
    got = [r[0] for r in df.select(keys.natural_key("id", ["x"])).collect()]
    assert got[0] == "7" and got[1] == got[2] == hashlib.sha256(b"a").hexdigest() and got[3] != got[2]


def test_surrogate_key_of_missing_parts(spark):
    df = spark.createDataFrame([(None, None)], "a string, b string")
    got = df.select(keys.surrogate_key("a", "b", missing={1: "Ignorado"})).first()[0]
    assert got == hashlib.sha256(b"n/a||Ignorado").hexdigest()


def test_fingerprint_ignores_column_order_and_excluded(spark):
    a = spark.createDataFrame([("1", "2", "x")], "a string, b string, run string")
    one = a.select(keys.row_fingerprint(["a", "b", "run"], ["run"])).first()[0]
    two = a.select(keys.row_fingerprint(["b", "a"])).first()[0]
    assert one == two


def test_names():
    assert names.sanitize_names(["NU_NOTIFIC", "RAZÃO SOCIAL", "a.b(c)", "A B C", "a-b-c", "__x"]) == [
        "nu_notific", "razao_social", "a_b_c", "a_b_c_dup", "a_b_c_dup2", "x"]


def test_ensure_and_drop(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    out = names.drop_present(names.ensure_column(df, "c", "string"), ["b", "zz"])
    assert out.dtypes == [("a", "int"), ("c", "string")]


def test_blocked_terms(spark):
    values = ["Qual é o NOME do paciente?", "Emergência lotada", "casos por UF", None]
    assert column(spark, values, text.blocked_term("v", cat.BLOCKED_TERMS_APP)) == [
        "nome do paciente", "rg", None, None]
    assert column(spark, values, text.blocked_term("v", cat.BLOCKED_TERMS_APP, whole_words=True)) == [
        "nome do paciente", None, None, None]


def test_pii_patterns(spark):
    values = ["cpf 123.456.789-00", "12345678900", "a12345678900b", "123456789012345", "12345678901234"]
    assert column(spark, values, text.matches_any("v", [cat.CPF_BOUNDED])) == [
        True, True, False, False, False]
    assert column(spark, values, text.matches_any("v", [cat.CPF_ANYWHERE]))[2] is True
    assert column(spark, values, text.matches_any("v", [cat.CNS_BOUNDED])) == [
        False, False, False, True, False]


def test_correct_terms_ignores_case_and_accents(spark):
    got = column(spark, ["A OCUPAÇÃO DE LEITOS subiu", "Cobertura de Vacinação", "nada"],
                 text.correct_terms("v", cat.MISLEADING_TERMS))
    assert got == ["A uso de UTI registrado entre casos SRAG hospitalizados subiu",
                   "vacinação registrada entre casos SRAG", "nada"]


def test_length_gate(spark):
    values = ["abcd", " abcd ", "abcde", "x" * 1000, "x" * 1001, None]
    assert column(spark, values, text.length_problem("v")) == [
        "curta", "curta", None, None, "longa", "curta"]


def test_source_reliability(spark):
    got = column(spark, ["https://www.gov.br/x", "https://g1.globo.com/y", "https://z.example"],
                 text.source_reliability("v", cat.SOURCE_RELIABILITY, cat.RELIABILITY_DEFAULT))
    assert got == ["Alta", "Média-Alta", "Média"]
