"""Independent SQL for the registered queries, runnable by DuckDB over the same tables.

Shared views are spelled out once as common table expressions; ``_sql`` puts
those a query names (and the ones they need) in front of it.
"""

from __future__ import annotations

from caselake import catalogs as cat
from caselake.plans import casebook as cb
from caselake.plans import queries as q

CTES: dict[str, tuple[tuple[str, ...], str]] = {}
ORACLES: dict[str, str] = {}


def _cte(name: str, body: str, *needs: str) -> None:
    CTES[name] = (needs, body)


def _sql(body: str, *needs: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        for n in CTES[name][0]:
            visit(n)
        if name not in order:
            order.append(name)

    for n in needs:
        visit(n)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order) + "\n" + body


def _oracle(name: str, body: str, *needs: str) -> None:
    ORACLES[name] = _sql(body, *needs)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "(" + ", ".join(_text(v) if isinstance(v, str) else str(v) for v in values) + ")"


def _day(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"


def _time(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def _case(column: str, mapping: dict, default: str = f"'{cat.NOT_INFORMED}'") -> str:
    arms = " ".join(
        f"WHEN {column} = {_text(k) if isinstance(k, str) else k} THEN {_text(v) if isinstance(v, str) else v}"
        for k, v in mapping.items()
    )
    return f"CASE {arms} ELSE {default} END"


def _salted(value: str) -> str:
    return f"sha256('{cb.SALT}' || '||' || coalesce(CAST({value} AS VARCHAR), ''))"


def _joined(parts) -> str:
    return " || '||' || ".join(parts)


def _rate(n: str, d: str) -> str:
    return f"CASE WHEN {d} > 0 THEN round({n} / {d}::DOUBLE, 4) END"


# --- cases --------------------------------------------------------------------

_cte("lines", """
SELECT l_orderkey, count(*) AS n_lines,
  min(l_shipdate::DATE) AS first_ship, max(l_shipdate::DATE) AS last_ship,
  min(l_shipdate::DATE) FILTER (l_returnflag = 'R') AS first_r,
  max(l_shipdate::DATE) FILTER (l_returnflag = 'R') AS last_r,
  min(l_shipdate::DATE) FILTER (l_returnflag = 'N') AS first_n,
  max(l_shipdate::DATE) FILTER (l_linestatus = 'F') AS last_f,
  bool_or(l_returnflag = 'A') AS has_a,
  min(l_linestatus) AS low_status, max(l_linestatus) AS high_status, max(l_discount) AS top_discount
FROM lineitem GROUP BY l_orderkey""")

_cte("base", """
SELECT *, substr(o_orderpriority, 1, 1) AS pri, o_orderdate::DATE AS odate,
  CASE WHEN has_a THEN '1' WHEN first_n IS NOT NULL THEN '2' WHEN n_lines IS NOT NULL THEN '9' END AS hosp,
  CASE WHEN first_r IS NOT NULL THEN '1' WHEN n_lines IS NOT NULL THEN '2' END AS icu,
  CASE WHEN high_status = 'F' THEN '1' WHEN low_status = 'O' THEN '2' WHEN n_lines IS NOT NULL THEN '9' END AS flu,
  CASE WHEN top_discount >= 0.08::DOUBLE THEN '1' WHEN top_discount >= 0.05::DOUBLE THEN '2'
       WHEN n_lines IS NOT NULL THEN ' ' END AS cov
FROM orders
LEFT JOIN (customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
  ON o_custkey = c_custkey
LEFT JOIN lines ON l_orderkey = o_orderkey""", "lines")


def _written(c: str) -> str:
    return (
        f"CASE WHEN o_orderstatus = 'F' THEN strftime({c}, '%Y-%m-%d') "
        f"WHEN o_orderstatus = 'P' THEN strftime({c}, '%Y%m%d') "
        f"WHEN pri < '3' THEN strftime({c}, '%Y-%m-%dT00:00:00.000Z') "
        f"ELSE strftime({c}, '%Y-%m-%dT00:00:00Z') END"
    )


RAW_COLUMNS = {
    "nu_notific": "CAST(o_orderkey AS VARCHAR)",
    "dt_notific": _written("first_ship"),
    "dt_sin_pri": _written("odate"),
    "dt_interna": _written("first_n"),
    "dt_entuti": _written("first_r"),
    "dt_saiduti": _written("last_f"),
    "dt_evoluca": _written("last_ship"),
    "dt_encerra": _written("last_r"),
    "dt_digita": f"CASE WHEN pri <> '5' THEN {_written('last_ship')} END",
    "dt_nasc": _written("(odate - CAST(floor(c_acctbal) AS INTEGER))"),
    "sg_uf": "lower(r_name) || ' '",
    "sg_uf_not": "r_name",
    "co_mun_not": "CAST(n_nationkey AS VARCHAR)",
    "co_mun_res": "CAST(n_nationkey AS VARCHAR)",
    "id_mn_resi": "n_name",
    "sg_uf_inte": "CASE WHEN has_a THEN r_name END",
    "co_mu_inte": "CASE WHEN has_a THEN CAST((n_nationkey + n_lines) % 25 AS VARCHAR) END",
    "id_mn_inte": "CASE WHEN has_a THEN n_name || '-' || CAST(n_lines AS VARCHAR) END",
    "cs_sexo": "CASE c_mktsegment WHEN 'MACHINERY' THEN 'M' WHEN 'FURNITURE' THEN 'f ' "
               "WHEN 'HOUSEHOLD' THEN 'I' WHEN 'BUILDING' THEN 'X' END",
    "nu_idade_n": "CAST(CAST(floor(c_acctbal / 100) AS INTEGER) AS VARCHAR)",
    "tp_idade": "CASE WHEN pri < '3' THEN pri WHEN pri < '5' THEN '3' ELSE '9' END",
    "cs_raca": "CAST(r_regionkey + 1 AS VARCHAR)",
    "cs_gestant": "CAST(n_lines AS VARCHAR)",
    "cs_escol_n": "CASE o_orderstatus WHEN 'F' THEN '0' WHEN 'O' THEN '3' ELSE 'x' END",
    "febre": "CASE WHEN o_totalprice > 300000 THEN '1' WHEN o_totalprice > 100000 THEN '2' ELSE '9' END",
    "tosse": "icu", "dispneia": "hosp", "saturacao": "flu",
    "fator_risc": "CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE '1' END",
    "vacina": "flu", "vacina_cov": "cov", "hospital": "hosp", "uti": "icu",
    "suport_ven": "CAST(n_lines AS VARCHAR)",
    "pcr_resul": "CAST(n_lines AS VARCHAR)",
    "classi_fin": "pri",
    "criterio": "CAST(r_regionkey + 1 AS VARCHAR)",
    "evolucao": "CASE WHEN o_orderstatus = 'F' THEN '1' WHEN o_orderstatus = 'O' THEN '2' "
                "WHEN pri = '5' THEN '9' ELSE '3' END",
    "dose_1_cov": _written("first_ship"),
    "dose_2_cov": _written("first_r"),
    "dose_ref": _written("first_n"),
    "dose_adic": _written("last_f"),
    "nu_cpf": "lpad(CAST(o_custkey AS VARCHAR), 11, '0')",
    "nm_pacient": "c_name",
    "dh_ingestao_bronze": "CAST(odate + 30 AS TIMESTAMP)",
    "nome_arquivo_origem": "'cases_' || o_orderstatus || '.csv'",
    "run_id": "'run-' || CAST(year(odate) AS VARCHAR)",
}
_cte("raw_cases", "SELECT " + ", ".join(f"{e} AS {n}" for n, e in RAW_COLUMNS.items()) + " FROM base", "base")


def _parse(c: str) -> str:
    return (
        f"coalesce(try_strptime({c}, '%Y-%m-%d')::DATE, try_strptime({c}, '%Y-%m-%dT%H:%M:%S.%gZ')::DATE, "
        f"try_strptime({c}, '%Y-%m-%dT%H:%M:%SZ')::DATE, try_strptime({c}, '%Y%m%d')::DATE)"
    )


_DATES = [c for c in RAW_COLUMNS if c in cat.DATE_COLUMNS and c != "dt_nasc"]
_INTS = [c for c in RAW_COLUMNS if c in cat.INT_COLUMNS]
_typed = {}
for _c in RAW_COLUMNS:
    if _c in ("nu_cpf", "nm_pacient", "dt_nasc"):
        continue
    _typed[_c] = (
        f"TRY_CAST({_c} AS INTEGER)" if _c in _INTS else _parse(_c) if _c in _DATES
        else f"upper(trim({_c}))" if _c in ("sg_uf", "sg_uf_not", "cs_sexo") else _c
    )
_typed["sg_uf_residencia"] = _typed.pop("sg_uf")
_cte(
    "typed0",
    "SELECT " + ", ".join(f"{e.replace('sg_uf_residencia', 'sg_uf')} AS {n}" for n, e in _typed.items())
    + f", {_salted('nu_notific')} AS hash_caso, {_salted('dt_nasc')} AS dt_nasc_hash FROM raw_cases",
    "raw_cases",
)
_AGE = (
    "CASE tp_idade WHEN 3 THEN nu_idade_n::DOUBLE WHEN 2 THEN round(nu_idade_n / 12.0::DOUBLE, 1) "
    "WHEN 1 THEN round(nu_idade_n / 365.0::DOUBLE, 1) END"
)


def _sum_flags() -> str:
    out = []
    for f in cat.CASE_FLAGS:
        if f.column is None:
            out.append(f"1 AS {f.name}")
        else:
            test = f"coalesce({f.column} IN {_list(f.codes)}, false)"
            if f.or_present:
                test += f" OR {f.or_present} IS NOT NULL"
            out.append(f"CAST({test} AS INTEGER) AS {f.name}")
    return ", ".join(out)


_cte("typed1", f"SELECT *, {_AGE} AS idade_anos_calculada FROM typed0", "typed0")
_cte("cases", f"""
SELECT *,
  CASE WHEN idade_anos_calculada IS NULL THEN 'Ignorado'
       WHEN idade_anos_calculada >= 80 THEN '80+' WHEN idade_anos_calculada >= 70 THEN '70-79'
       WHEN idade_anos_calculada >= 60 THEN '60-69' WHEN idade_anos_calculada >= 50 THEN '50-59'
       WHEN idade_anos_calculada >= 40 THEN '40-49' WHEN idade_anos_calculada >= 30 THEN '30-39'
       WHEN idade_anos_calculada >= 18 THEN '18-29' WHEN idade_anos_calculada >= 12 THEN '12-17'
       WHEN idade_anos_calculada >= 5 THEN '05-11' ELSE '00-04' END AS faixa_etaria,
  dt_saiduti - dt_entuti AS dias_uti,
  (dose_1_cov IS NOT NULL)::INT + (dose_2_cov IS NOT NULL)::INT + (dose_ref IS NOT NULL)::INT
    + (dose_adic IS NOT NULL)::INT AS qtd_doses_covid_registradas,
  {_sum_flags()},
  coalesce(dt_digita::TIMESTAMP, dt_encerra::TIMESTAMP, dt_notific::TIMESTAMP, dh_ingestao_bronze)
    AS dh_ultima_atualizacao,
  sha256({_joined(["coalesce(sg_uf_residencia, 'n/a')", "coalesce(co_mun_res, 'n/a')"])}) AS sk_localidade,
  sha256({_joined(["coalesce(cs_sexo, 'n/a')", "faixa_etaria"]
                  + [f"coalesce({c}::VARCHAR, 'n/a')" for c in ("cs_raca", "cs_gestant", "cs_escol_n")])}) AS sk_perfil,
  sha256({_joined([f"coalesce({c}::VARCHAR, 'n/a')" for c in ("classi_fin", "criterio", "evolucao")])})
    AS sk_classificacao,
  sha256(dt_sin_pri::VARCHAR) AS sk_tempo
FROM typed1""", "typed1")
_cte("refd", "SELECT max(dt_sin_pri) AS ref FROM cases", "cases")

_daily_sums = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {n}" for n, c in cat.DAILY_SUMS.items())
_monthly_sums = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {n}" for n, c in cat.MONTHLY_SUMS.items())
_rates = ", ".join(f"{_rate(n, d)} AS {r}" for r, (n, d) in cat.RATES.items())

_cte("daily0", f"SELECT dt_sin_pri AS d, {_daily_sums} FROM cases WHERE dt_sin_pri IS NOT NULL GROUP BY 1", "cases")
_cte("daily", f"""
SELECT d, * EXCLUDE (d), {_rates},
  round(avg(total_casos) OVER (ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 2) AS media_movel_7d_casos
FROM daily0""", "daily0")
_cte("monthly", f"""
SELECT *, {_rates} FROM (
  SELECT CAST(year(dt_sin_pri) AS INTEGER) AS ano, CAST(month(dt_sin_pri) AS INTEGER) AS mes,
    strftime(dt_sin_pri, '%Y-%m') AS ano_mes, {_monthly_sums}, round(avg(dias_uti), 1) AS media_dias_uti
  FROM cases WHERE dt_sin_pri IS NOT NULL GROUP BY 1, 2, 3)""", "cases")
_cte("first_month", "SELECT strftime(ref - INTERVAL 11 MONTH, '%Y-%m') AS fm FROM refd", "refd")

_oracle("daily_metrics", f"SELECT {_day('d')} AS data_referencia, * EXCLUDE (d) FROM daily", "daily")
_oracle("daily_ma7_rows",
        f"SELECT {_day('d')} AS data_referencia, total_casos, media_movel_7d_casos FROM daily", "daily")
_oracle("daily_ma7_calendar", f"""
SELECT {_day('d')} AS data_referencia, total_casos,
  round(avg(total_casos) OVER (ORDER BY d RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW), 2)
    AS media_movel_7d_casos
FROM daily0""", "daily0")
_oracle("daily_metrics_by_place", f"""
SELECT {_day('d')} AS data_referencia, * EXCLUDE (d), {_rates},
  round(avg(total_casos) OVER (PARTITION BY sg_uf_residencia ORDER BY d
        ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 2) AS media_movel_7d_casos
FROM (SELECT sg_uf_residencia, dt_sin_pri AS d, {_daily_sums} FROM cases
      WHERE dt_sin_pri IS NOT NULL GROUP BY 1, 2)""", "cases")
_oracle("monthly_metrics", "SELECT * FROM monthly", "monthly")

_win = "dt_sin_pri BETWEEN ref - {a} AND ref - {b}"


def _wsum(flag: str, a: int, b: int = 0) -> str:
    return f"CAST(coalesce(sum({flag}) FILTER ({_win.format(a=a, b=b)}), 0) AS BIGINT)"


_cte("kpi", f"""
SELECT ref::DATE AS data_referencia, c7 AS casos_ultimos_7_dias, p7 AS casos_7_dias_anteriores,
  {_rate('(c7 - p7)', 'p7')} AS taxa_aumento_casos_7d,
  c30 AS casos_ultimos_30_dias, d30 AS obitos_ultimos_30_dias,
  {_rate('d30', 'o30')} AS taxa_mortalidade_30d, {_rate('u30', 'h30')} AS taxa_uso_uti_30d,
  {_rate('g30', 'gi30')} AS taxa_vacinacao_gripe_30d, {_rate('v30', 'vi30')} AS taxa_vacinacao_covid_30d,
  ref::DATE AS data_maxima_dataset, CAST(DATE '{cb.AS_OF}' - ref AS INTEGER) AS defasagem_dias,
  DATE '{cb.AS_OF}' AS data_execucao,
  CASE WHEN p7 = 0 THEN {_text(cat.GROWTH_NOTE)} END AS obs_aumento,
  CASE WHEN DATE '{cb.AS_OF}' - ref <= 7 THEN {_text(cat.RELIABILITY_FRESH)}
       WHEN DATE '{cb.AS_OF}' - ref <= 30
         THEN 'Dataset com ' || (DATE '{cb.AS_OF}' - ref) || {_text(cat.RELIABILITY_DELAYED)}
       ELSE 'Dataset com ' || (DATE '{cb.AS_OF}' - ref) || {_text(cat.RELIABILITY_STALE)} END
    AS observacao_confiabilidade
FROM (SELECT any_value(ref) AS ref, {_wsum('flag_caso_srag', 6)} AS c7, {_wsum('flag_caso_srag', 13, 7)} AS p7,
  {_wsum('flag_caso_srag', 29)} AS c30, {_wsum('flag_obito_srag', 29)} AS d30,
  {_wsum('flag_evolucao_informada', 29)} AS o30, {_wsum('flag_hospitalizado', 29)} AS h30,
  {_wsum('flag_uti', 29)} AS u30, {_wsum('flag_vacinado_gripe', 29)} AS g30,
  {_wsum('flag_info_vacina_gripe', 29)} AS gi30, {_wsum('flag_vacinado_covid', 29)} AS v30,
  {_wsum('flag_info_vacina_covid', 29)} AS vi30 FROM cases, refd)""", "cases", "refd")
_KPI_DATES = ("data_referencia", "data_maxima_dataset", "data_execucao")
_oracle("kpi_snapshot", "SELECT * REPLACE (" + ", ".join(f"{_day(c)} AS {c}" for c in _KPI_DATES)
        + ") FROM kpi", "kpi")
_entries = [("data_maxima_dataset", _day("data_maxima_dataset"))]
_entries += [(c, f"CAST({c} AS VARCHAR)") for c in (
    "casos_ultimos_7_dias", "casos_7_dias_anteriores", "casos_ultimos_30_dias",
    "obitos_ultimos_30_dias", "defasagem_dias")]
_entries += [(c, f"CAST(CAST(round({c} * 100, 2) AS DECIMAL(18,2)) AS VARCHAR) || '%'") for c in (
    "taxa_aumento_casos_7d", "taxa_mortalidade_30d", "taxa_uso_uti_30d",
    "taxa_vacinacao_gripe_30d", "taxa_vacinacao_covid_30d")]
_oracle("kpi_report_long", "\nUNION ALL ".join(
    f"SELECT {i} AS ordem, '{n}' AS indicador, coalesce({e}, 'N/D') AS valor FROM kpi"
    for i, (n, e) in enumerate(_entries, start=1)), "kpi")
_oracle("measured_rows", "\nUNION ALL ".join(
    f"SELECT l_returnflag, {i} AS ordem, '{n}' AS medida, CAST({e} AS BIGINT) AS valor FROM lineitem GROUP BY 1"
    for i, (n, e) in enumerate((
        ("linhas", "count(*)"), ("fornecedores", "count(DISTINCT l_suppkey)"), ("maior_pedido", "max(l_orderkey)"),
        ("linhas_grandes", "count(*) FILTER (l_quantity > 25)")), start=1)))
_oracle("category_mix", """
SELECT *, CASE WHEN evolucao <> 0 THEN round(obitos / evolucao::DOUBLE * 100, 2) END AS taxa_mortalidade_pct,
  CASE WHEN hosp <> 0 THEN round(uti / hosp::DOUBLE * 100, 2) END AS taxa_uso_uti_pct
FROM (SELECT CAST(sum(total_covid) AS BIGINT) AS covid, CAST(sum(total_influenza) AS BIGINT) AS influenza,
  CAST(sum(total_outro_virus) AS BIGINT) AS outro_virus,
  CAST(sum(total_srag_nao_especificado) AS BIGINT) AS srag_nao_esp,
  CAST(sum(total_obitos) AS BIGINT) AS obitos, CAST(sum(total_casos_com_evolucao) AS BIGINT) AS evolucao,
  CAST(sum(total_casos) AS BIGINT) AS total_casos, CAST(sum(total_uti) AS BIGINT) AS uti,
  CAST(sum(total_hospitalizados) AS BIGINT) AS hosp
  FROM monthly, first_month WHERE ano_mes >= fm)""", "monthly", "first_month")
_oracle("place_month_matrix", "SELECT id_mn_resi, " + ", ".join(
    f"count(*) FILTER (strftime(dt_sin_pri, '%Y-%m') = strftime(ref - INTERVAL {k} MONTH, '%Y-%m')) AS m{k:02d}"
    for k in range(12)) + """, count(*) AS total
FROM cases, refd, first_month WHERE strftime(dt_sin_pri, '%Y-%m') >= fm
GROUP BY 1""", "cases", "refd", "first_month")
_oracle("peak_day", f"""
SELECT {_day('d')} AS data_referencia, total_casos FROM daily0 ORDER BY total_casos DESC, d LIMIT 1""", "daily0")
_oracle("trailing_30d", f"""
SELECT {_day('d')} AS data_referencia, * EXCLUDE (d, ref) FROM daily, refd WHERE d BETWEEN ref - 29 AND ref""",
        "daily", "refd")
_oracle("trailing_12m", "SELECT * EXCLUDE (fm) FROM monthly, first_month WHERE ano_mes >= fm",
        "monthly", "first_month")
_oracle("fact_summary", f"""
SELECT count(*) AS total_casos, CAST(sum(flag_obito_srag) AS BIGINT) AS total_obitos,
  CAST(sum(flag_uti) AS BIGINT) AS total_uti, CAST(sum(flag_hospitalizado) AS BIGINT) AS total_hospitalizados,
  CAST(sum(flag_vacinado_covid) AS BIGINT) AS total_vacinados_covid,
  {_day('min(dt_sin_pri)')} AS data_minima, {_day('max(dt_sin_pri)')} AS data_maxima FROM cases""", "cases")
_oracle("remainder_share", f"""
SELECT ano_mes, total_casos, total_hospitalizados, total_casos - total_hospitalizados AS nao_hospitalizados,
  {_rate('total_hospitalizados', 'total_casos')} AS proporcao_hospitalizados,
  total_casos - lag(total_casos) OVER (ORDER BY ano_mes) AS variacao_casos FROM monthly""", "monthly")
_oracle("frequency_file_format", """
SELECT 'cases_' || o_orderstatus || '.csv' AS nome_arquivo_origem,
  'run-' || CAST(year(o_orderdate) AS VARCHAR) AS run_id, count(*) AS total FROM orders GROUP BY 1, 2""")
_oracle("frequency_file_format_version", """
SELECT 'cases_' || o_orderstatus || '.csv' AS nome_arquivo_origem,
  CASE o_orderstatus WHEN 'O' THEN 'ISO_DATETIME_UTC' ELSE 'ISO_DATE' END AS formato_data_origem,
  CASE o_orderstatus WHEN 'F' THEN 'F-1995' WHEN 'O' THEN 'O-1996' ELSE 'desconhecida' END AS versao_arquivo_origem,
  count(*) AS total FROM orders GROUP BY ALL""")
_oracle("frequency_by_year",
        "SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, count(*) AS total FROM orders GROUP BY 1")

# --- typing -----------------------------------------------------------------------

_oracle("parse_date_multi", "SELECT nu_notific, " + ", ".join(
    f"{_day(_parse(c))} AS {c}" for c in ("dt_notific", "dt_sin_pri", "dt_interna", "dt_encerra", "dt_nasc"))
    + " FROM raw_cases", "raw_cases")
_prefix = "try_strptime(substr({c}, 1, 10), '%Y-%m-%d')"
_oracle("parse_date_prefix", f"""
SELECT nu_notific, {_day(_prefix.format(c='dt_sin_pri'))} AS dt_sin_pri_d,
  {_day(_prefix.format(c='dt_notific'))} AS dt_notific_d FROM raw_cases""", "raw_cases")
_oracle("detect_date_format", f"""
SELECT nome_arquivo_origem, CASE WHEN count(*) FILTER (dt_notific <> '') = 0 THEN '{cat.FORMAT_UNKNOWN}'
  WHEN count(*) FILTER (dt_notific LIKE '%T%') > 0 THEN '{cat.FORMAT_DATETIME}'
  ELSE '{cat.FORMAT_DATE}' END AS formato_data_origem FROM raw_cases GROUP BY 1""", "raw_cases")
_oracle("cast_ints", "SELECT nu_notific, " + ", ".join(
    f"TRY_CAST({c} AS INTEGER) AS {c}" for c in
    ("nu_idade_n", "tp_idade", "cs_escol_n", "fator_risc", "vacina_cov", "classi_fin", "evolucao"))
    + " FROM raw_cases", "raw_cases")
_oracle("normalize_text", """
SELECT nu_notific, upper(trim(sg_uf)) AS sg_uf, upper(trim(cs_sexo)) AS cs_sexo,
  upper(id_mn_resi[1]) || lower(id_mn_resi[2:]) AS id_mn_resi FROM raw_cases""", "raw_cases")
_oracle("decode_codes", f"""
SELECT nu_notific, {_case('cs_sexo', cat.SEX_LABELS)} AS sexo, {_case('cs_raca', cat.RACE_LABELS)} AS raca,
  {_case('cs_gestant', cat.PREGNANCY_LABELS)} AS gestante, {_case('cs_escol_n', cat.SCHOOLING_LABELS)} AS escolaridade,
  {_case('criterio', cat.CRITERION_LABELS, 'NULL')} AS criterio_mapa FROM cases""", "cases")
_oracle("age_and_band", "SELECT nu_notific, idade_anos_calculada, faixa_etaria FROM cases", "cases")
_oracle("duration_days", f"""
SELECT nu_notific, {_day('dt_entuti')} AS dt_entuti, {_day('dt_saiduti')} AS dt_saiduti,
  CAST(dias_uti AS INTEGER) AS dias_uti FROM cases""", "cases")
_oracle("count_present", "SELECT nu_notific, qtd_doses_covid_registradas FROM cases", "cases")
_oracle("derive_flags", f"SELECT nu_notific, {', '.join(cat.FLAG_NAMES)} FROM cases", "cases")
_oracle("first_non_null_watermark", f"""
SELECT nu_notific, {_time('dh_ultima_atualizacao')} AS dh_ultima_atualizacao FROM cases""", "cases")
_oracle("calendar", f"""
SELECT {_day('d')} AS data, sha256({_day('d')}) AS sk_tempo, CAST(year(d) AS INTEGER) AS ano,
  CAST(month(d) AS INTEGER) AS mes, strftime(d, '%Y-%m') AS ano_mes, CAST(day(d) AS INTEGER) AS dia,
  year(d) || '-' || lpad(CAST(week(d) AS VARCHAR), 2, '0') AS semana_epidemiologica,
  CAST(quarter(d) AS INTEGER) AS trimestre, {_case('month(d)', cat.MONTH_NAMES, 'NULL')} AS nome_mes,
  d >= DATE '{cb.AS_OF}' - 30 AS eh_ultimos_30_dias,
  d >= DATE '{cb.AS_OF}' - INTERVAL 12 MONTH AS eh_ultimos_12_meses
FROM (SELECT unnest(generate_series(min(dt_sin_pri)::TIMESTAMP,
        greatest(max(dt_sin_pri), DATE '{cb.AS_OF}')::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d FROM cases)""", "cases")

# --- privacy -------------------------------------------------------------------------

_oracle("pseudonymize", f"""
SELECT c_custkey, {_salted('c_name')} AS nome_hash, {_salted('NULL')} AS vazio_hash FROM customer""")
_pii = ("nu_cpf", "nm_pacient", "dt_nasc")
_oracle("pii_vault", f"""
SELECT DISTINCT {_salted('nu_notific')} AS hash_caso, nu_notific,
  {', '.join(f'{_salted(c)} AS {c}_hash, {c}' for c in _pii)}, nome_arquivo_origem,
  '{cat.SOURCE_SYSTEM}' AS origem_sistema, 'vault-run' AS run_id FROM raw_cases""", "raw_cases")
_oracle("masked_view", f"""
SELECT * EXCLUDE (nu_cpf, nm_pacient, dt_nasc) REPLACE ({_time('dh_ingestao_bronze')} AS dh_ingestao_bronze),
  {_salted('nu_notific')} AS hash_caso, {_salted('dt_nasc')} AS dt_nasc_hash FROM raw_cases""", "raw_cases")
_oracle("row_fingerprint", """
SELECT c_custkey, sha256(concat_ws('||', CAST(c_custkey AS VARCHAR), c_mktsegment, c_name)) AS hash_registros
FROM customer""")
_fallback = _joined([f"coalesce(trim({c}), 'n/a')" for c in cat.FALLBACK_KEY_COLUMNS])
_oracle("natural_key", f"""
SELECT nu_notific, CASE WHEN sg_uf_not IN ('ASIA', 'EUROPE') THEN sha256({_fallback}) ELSE nu_notific END
  AS chave_natural FROM raw_cases""", "raw_cases")
_oracle("surrogate_keys", f"""
SELECT nu_notific, sha256({_day('dt_interna')}) AS sk_interna, sk_localidade, sk_perfil, sk_classificacao
FROM cases""", "cases")

# --- star schema -------------------------------------------------------------------------

_oracle("dim_date", f"""
SELECT DISTINCT {_day('dt_sin_pri')} AS data, sk_tempo, CAST(year(dt_sin_pri) AS INTEGER) AS ano,
  CAST(month(dt_sin_pri) AS INTEGER) AS mes, strftime(dt_sin_pri, '%Y-%m') AS ano_mes,
  CAST(day(dt_sin_pri) AS INTEGER) AS dia, CAST(week(dt_sin_pri) AS INTEGER) AS semana_epidemiologica,
  CAST(quarter(dt_sin_pri) AS INTEGER) AS trimestre,
  {_case('month(dt_sin_pri)', cat.MONTH_NAMES, 'NULL')} AS nome_mes,
  dt_sin_pri >= ref - 29 AS eh_ultimos_30_dias, dt_sin_pri >= ref - INTERVAL 11 MONTH AS eh_ultimos_12_meses
FROM cases, refd WHERE dt_sin_pri IS NOT NULL""", "cases", "refd")
_oracle("dim_place", """
SELECT sk_localidade, coalesce(sg_uf_residencia, 'n/a') AS sg_uf, coalesce(co_mun_res, 'n/a') AS co_mun_residencia,
  id_mn_resi, sg_uf_inte, co_mu_inte, id_mn_inte FROM cases
QUALIFY row_number() OVER (PARTITION BY sk_localidade ORDER BY coalesce(id_mn_resi, ''), coalesce(sg_uf_inte, ''),
  coalesce(co_mu_inte, ''), coalesce(id_mn_inte, '')) = 1""", "cases")
_oracle("dim_profile", f"""
SELECT DISTINCT sk_perfil, coalesce(cs_sexo, 'n/a') AS cs_sexo, faixa_etaria, cs_raca, cs_gestant, cs_escol_n,
  {_case('cs_sexo', cat.SEX_LABELS)} AS descricao_sexo, {_case('cs_raca', cat.RACE_LABELS)} AS descricao_raca,
  {_case('cs_gestant', cat.PREGNANCY_LABELS)} AS descricao_gestant,
  {_case('cs_escol_n', cat.SCHOOLING_LABELS)} AS descricao_escol FROM cases""", "cases")
_oracle("dim_class", f"""
SELECT DISTINCT sk_classificacao, classi_fin, criterio, evolucao,
  {_case('classi_fin', cat.CLASSIFICATION_LABELS)} AS descricao_classificacao_final,
  {_case('criterio', cat.CRITERION_LABELS)} AS descricao_criterio,
  {_case('evolucao', cat.OUTCOME_LABELS)} AS descricao_evolucao FROM cases""", "cases")
_fact_dates = ("dt_sin_pri", "dt_notific", "dt_interna", "dt_entuti", "dt_saiduti", "dt_evoluca")
_oracle("fact", f"""
SELECT sha256(hash_caso) AS sk_caso, hash_caso, sk_tempo, sk_localidade, sk_perfil, sk_classificacao,
  {', '.join(f'{_day(c)} AS {c}' for c in _fact_dates)}, CAST(dias_uti AS INTEGER) AS dias_uti,
  qtd_doses_covid_registradas, {', '.join(cat.FLAG_NAMES)},
  {_time('dh_ultima_atualizacao')} AS dh_ultima_atualizacao FROM cases""", "cases")
_oracle("orphan_counts", "\nUNION ALL ".join(
    f"SELECT '{k}' AS chave, count(*) AS orfaos FROM cases WHERE {k} IS NOT NULL AND {k} NOT IN "
    f"(SELECT {k} FROM cases WHERE dt_sin_pri < DATE '1995-01-10' AND {k} IS NOT NULL)"
    for k in ("sk_tempo", "sk_localidade", "sk_perfil", "sk_classificacao")), "cases")
_oracle("rollup_by_dimension", """
SELECT sg_uf_residencia AS sg_uf, strftime(dt_sin_pri, '%Y-%m') AS ano_mes, count(*) AS casos,
  CAST(sum(flag_obito_srag) AS BIGINT) AS obitos FROM cases GROUP BY 1, 2""", "cases")
_oracle("null_safe_join", """
SELECT nu_notific, cs_sexo, cs_gestant, count(*) OVER (PARTITION BY cs_sexo, cs_gestant) AS tamanho
FROM cases""", "cases")

# --- beds -----------------------------------------------------------------------------------

_cte("beds", f"""
SELECT CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) AS comp, upper(trim(any_value(r_name))) AS regiao,
  upper(trim(any_value(r_name))) AS uf, any_value(upper(n_name[1]) || lower(n_name[2:])) AS municipio,
  CAST(s_suppkey AS VARCHAR) AS cnes, any_value(upper(s_name[1]) || lower(s_name[2:])) AS nome_estabelecimento,
  any_value(CASE WHEN s_acctbal > 5000 THEN 'M' WHEN s_acctbal > 2000 THEN 'E' WHEN s_acctbal > 0 THEN 'D' END)
    AS tp_gestao,
  CAST(count(*) AS INTEGER) AS leitos_existentes,
  CAST(nullif(count(*) FILTER (l_returnflag = 'N'), 0) AS INTEGER) AS leitos_sus,
  CAST(count(*) FILTER (l_returnflag = 'R') AS INTEGER) AS uti_total_exist,
  CAST(count(*) FILTER (l_returnflag = 'R' AND l_linestatus = 'F') AS INTEGER) AS uti_total_sus,
  CAST(count(*) FILTER (l_returnflag = 'R' AND l_quantity > 25) AS INTEGER) AS uti_adulto_exist,
  CAST(count(*) FILTER (l_returnflag = 'R' AND l_quantity <= 25) AS INTEGER) AS uti_neonatal_exist,
  CAST(count(*) FILTER (l_returnflag = 'R' AND l_quantity > 25 AND l_linestatus = 'F') AS INTEGER) AS uti_adulto_sus,
  CAST(count(*) FILTER (l_returnflag = 'R' AND l_quantity <= 25 AND l_linestatus = 'F') AS INTEGER) AS uti_neonatal_sus,
  CAST(count(*) FILTER (l_returnflag = 'R' AND l_linenumber = 1) AS INTEGER) AS uti_pediatrico_exist,
  CAST(count(*) FILTER (l_returnflag = 'R' AND l_linenumber = 1 AND l_linestatus = 'F') AS INTEGER) AS uti_pediatrico_sus,
  CAST(count(*) FILTER (l_returnflag = 'R' AND l_linenumber = 2) AS INTEGER) AS uti_queimado_exist,
  CAST(count(*) FILTER (l_returnflag = 'R' AND l_linenumber = 2 AND l_linestatus = 'F') AS INTEGER) AS uti_queimado_sus,
  CAST(count(*) FILTER (l_returnflag = 'R' AND l_linenumber = 3) AS INTEGER) AS uti_coronariana_exist,
  CAST(count(*) FILTER (l_returnflag = 'R' AND l_linenumber = 3 AND l_linestatus = 'F') AS INTEGER) AS uti_coronariana_sus,
  CAST(year(min(l_shipdate)) AS INTEGER) AS ano, CAST(month(min(l_shipdate)) AS INTEGER) AS mes,
  strftime(min(l_shipdate), '%Y-%m') AS ano_mes
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
GROUP BY s_suppkey, strftime(l_shipdate, '%Y%m')""")
_bed_sums = [c for c in ("leitos_existentes", "leitos_sus", "uti_total_exist", "uti_total_sus",
                         "uti_adulto_exist", "uti_neonatal_exist", "uti_adulto_sus", "uti_neonatal_sus",
                         "uti_pediatrico_exist", "uti_pediatrico_sus", "uti_queimado_exist", "uti_queimado_sus",
                         "uti_coronariana_exist", "uti_coronariana_sus")]
_cte("rollup", "SELECT uf, regiao, ano, mes, ano_mes, " + ", ".join(
    f"CAST(sum({c}) AS BIGINT) AS {c + '_total' if c.startswith('leitos') else c}" for c in _bed_sums)
    + ", count(DISTINCT cnes) AS qtd_estabelecimentos FROM beds GROUP BY ALL", "beds")
_oracle("beds_typed", f"""
SELECT *, CAST(NULL AS VARCHAR) AS co_ibge, {_case('tp_gestao', cat.MANAGEMENT_LABELS)} AS desc_tp_gestao
FROM beds""", "beds")
_oracle("period_parts", "SELECT cnes, comp, ano, mes, ano_mes FROM beds", "beds")
_oracle("sanitize_columns", """
SELECT comp, cnes, uf || '  ' AS uf, 'Supplier#' || substr(nome_estabelecimento, 10) AS nome_estabelecimento,
  'Supplier#' || substr(nome_estabelecimento, 10) AS razao_social,
  coalesce(CAST(leitos_sus AS VARCHAR), '-') AS leitos_sus FROM beds""", "beds")
_oracle("capacity_rollup", "SELECT * FROM rollup", "rollup")
_oracle("capacity_use", f"""
SELECT uf, ano_mes, total_casos, casos_uti, leitos_uti, {_rate('casos_uti', 'leitos_uti')} AS taxa_ocupacao_uti
FROM (SELECT sg_uf_residencia AS uf, strftime(dt_sin_pri, '%Y-%m') AS ano_mes, count(*) AS total_casos,
        CAST(sum(flag_uti) AS BIGINT) AS casos_uti FROM cases GROUP BY 1, 2)
JOIN (SELECT uf, ano_mes, CAST(sum(uti_total_exist) AS BIGINT) AS leitos_uti FROM beds GROUP BY 1, 2)
USING (uf, ano_mes)""", "cases", "beds")
_oracle("coverage_by_year", """
SELECT ano, count(DISTINCT mes) AS meses_cobertos, min(ano_mes) AS primeiro_mes, max(ano_mes) AS ultimo_mes,
  CAST(sum(uti_total_exist) AS BIGINT) AS total_uti_exist FROM rollup GROUP BY 1""", "rollup")

# --- deduplication and versions -------------------------------------------------------------------

_oracle("dedup_first", """
SELECT event_id, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""")
_oracle("dedup_latest", """
SELECT event_id, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1""")
_oracle("dedup_case_versions", f"""
SELECT nu_notific, 'redelivery.csv' AS nome_arquivo_origem,
  {_time("(dh_ingestao_bronze + INTERVAL 1 DAY)")} AS dh_ingestao_bronze FROM raw_cases""", "raw_cases")
_oracle("drop_duplicates_by", """
SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_partkey
  ORDER BY l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice) = 1""")
_oracle("distinct_projection", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
_oracle("latest_run", """
SELECT nu_notific, run_id FROM raw_cases
WHERE run_id = (SELECT run_id FROM raw_cases ORDER BY dh_ingestao_bronze DESC, run_id DESC LIMIT 1)""", "raw_cases")
_oracle("unmerged_runs", """
SELECT run_id, count(*) AS total FROM raw_cases WHERE dh_ingestao_bronze > TIMESTAMP '1999-06-30' GROUP BY 1""",
        "raw_cases")

_finger = _joined(["CAST(caso AS VARCHAR)", "classi_fin", "evolucao"])
_cte("reported", """
SELECT sha256(CAST(o_orderkey AS VARCHAR)) AS hash_caso, o_orderkey AS caso, o_orderstatus AS evolucao,
  substr(o_orderpriority, 1, 1) AS classi_fin, o_orderdate::DATE::TIMESTAMP AS dh_ultima_atualizacao FROM orders""")
_cte("second0", """
SELECT hash_caso, caso, evolucao, classi_fin, max(dh_ultima_atualizacao) AS dh_ultima_atualizacao FROM (
  SELECT * FROM reported UNION ALL
  SELECT hash_caso, caso, CASE WHEN low_status = high_status THEN low_status ELSE 'P' END, classi_fin,
    greatest(last_ship::TIMESTAMP, dh_ultima_atualizacao) FROM reported JOIN lines ON l_orderkey = caso)
GROUP BY ALL""", "reported", "lines")
_cte("second", f"SELECT *, sha256({_finger}) AS hash_registros FROM second0", "second0")
_cte("first_load", f"""
SELECT *, sha256({_finger}) AS hash_registros FROM reported
WHERE dh_ultima_atualizacao < TIMESTAMP '{cb.FIRST_DELIVERY_BEFORE}'""", "reported")
_V = ("hash_caso, caso, evolucao, classi_fin, "
      f"{_time('dh_ultima_atualizacao')} AS dh_ultima_atualizacao, hash_registros")
_T0, _T1 = f"'{cb.FIRST_DELIVERY_BEFORE} 00:00:00'", f"'{q.DELIVERY} 00:00:00'"
_oracle("scd2_first_load", f"""
SELECT {_V}, true AS registro_mais_atual, {_T0} AS dh_inicio_vigencia, CAST(NULL AS VARCHAR) AS dh_fim_vigencia
FROM first_load""", "first_load")
# every key as one sequence: the stored row, then the delivered ones by watermark; a row opens a
# version when its content differs from the row before, the last opened version is current
_cte("seq", """
SELECT *, lag(hash_registros) OVER w AS before FROM (
  SELECT *, 0 AS step FROM first_load UNION ALL SELECT *, 1 AS step FROM second)
WINDOW w AS (PARTITION BY hash_caso ORDER BY step, dh_ultima_atualizacao, hash_registros)""", "first_load", "second")
_cte("merged", f"""
SELECT *, lead(hash_caso) OVER (PARTITION BY hash_caso ORDER BY step, dh_ultima_atualizacao, hash_registros)
  IS NULL AS registro_mais_atual FROM seq WHERE before IS NULL OR before <> hash_registros""", "seq")
_oracle("scd2_merge", f"""
SELECT {_V}, registro_mais_atual, CASE WHEN step = 0 THEN {_T0} ELSE {_T1} END AS dh_inicio_vigencia,
  CASE WHEN NOT registro_mais_atual THEN {_T1} END AS dh_fim_vigencia FROM merged""", "merged")
ORACLES["scd2_table_roundtrip"] = ORACLES["scd2_merge"]
_oracle("current_view", "SELECT caso, evolucao, classi_fin FROM merged WHERE registro_mais_atual", "merged")
_oracle("scd2_close_only", f"""
SELECT {_V}, registro_mais_atual, dh_inicio_vigencia, dh_fim_vigencia FROM (
  SELECT t.*, NOT changed AS registro_mais_atual, {_T0} AS dh_inicio_vigencia,
    CASE WHEN changed THEN {_T1} END AS dh_fim_vigencia
  FROM (SELECT f.*, EXISTS (SELECT 1 FROM second s WHERE s.hash_caso = f.hash_caso
          AND s.hash_registros <> f.hash_registros) AS changed FROM first_load f) t
  UNION ALL BY NAME
  SELECT s.*, false AS changed, true AS registro_mais_atual, {_T1} AS dh_inicio_vigencia,
    CAST(NULL AS VARCHAR) AS dh_fim_vigencia
  FROM second s WHERE s.hash_caso NOT IN (SELECT hash_caso FROM first_load))""", "first_load", "second")

_cte("runs", """
SELECT *, CASE WHEN year(dh_ultima_atualizacao) < 1997 THEN 1 WHEN year(dh_ultima_atualizacao) < 1999 THEN 2 ELSE 3 END AS corrida
FROM second""", "second")
_oracle("scd2_delivery_manifest", """
SELECT 1 AS number, 'd9' AS delivery, count(*) AS rows, '2002-01-01 00:00:00' AS newest FROM runs WHERE corrida = 1
UNION ALL SELECT 2, 'd10', count(*) + count(DISTINCT CASE WHEN hash_caso IN (SELECT hash_caso FROM runs WHERE corrida = 1) THEN hash_caso END),
  '2002-02-01 00:00:00' FROM (SELECT *, lag(hash_registros) OVER (PARTITION BY hash_caso
    ORDER BY corrida, dh_ultima_atualizacao, hash_registros) AS before FROM runs WHERE corrida < 3)
  WHERE corrida = 2 AND (before IS NULL OR before <> hash_registros)
UNION ALL SELECT 3, 'd11', 0, '2002-02-01 00:00:00'""", "runs")
_oracle("pending_cases", """
SELECT caso, evolucao, classi_fin, '2002-03-01 00:00:00' AS dh_ingestao_bronze FROM runs WHERE corrida = 3""", "runs")

# --- data quality ------------------------------------------------------------------------------------

_SEV = ("CASE WHEN {p} < 0.8 THEN 'CRÍTICO' WHEN {p} < 0.9 THEN 'ALTO' WHEN {p} < 0.95 THEN 'MÉDIO' "
        "WHEN {p} < 0.99 THEN 'BAIXO' ELSE 'ACEITÁVEL' END")


def _log(parts: list[str], layer: str, table: str, run: str, at: str) -> str:
    """Log rows from SELECTs of (run, rule, dimension, col, total, valid)."""
    p = "CASE WHEN total > 0 THEN round(valid / total::DOUBLE, 6) ELSE 0.0::DOUBLE END"
    i = "CASE WHEN total > 0 THEN round((total - valid) / total::DOUBLE, 6) ELSE 0.0::DOUBLE END"
    return f"""SELECT {run} AS run_id, '{layer}' AS camada, '{table}' AS tabela_avaliada,
  rule AS regra_qualidade, dim AS dimensao_dmbok, col AS coluna_avaliada, CAST(total AS BIGINT) AS total_registros,
  CAST(valid AS BIGINT) AS registros_validos, CAST(total - valid AS BIGINT) AS registros_invalidos,
  {p} AS percentual_validade, {i} AS percentual_invalidade, {_SEV.format(p=p)} AS severidade,
  CAST(NULL AS VARCHAR) AS observacao, {at} AS dh_execucao
FROM ({' UNION ALL '.join(parts)})"""


def _row_rule(name: str, dim: str, col: str, test: str, source: str, by: str) -> str:
    return (f"SELECT {by} AS run, '{name}' AS rule, '{dim}' AS dim, '{col}' AS col, count(*) AS total, "
            f"count(*) FILTER ({test}) AS valid FROM {source} GROUP BY 1")


def _completeness(by: str) -> list[str]:
    return [_row_rule(f"Completude - {c}", "Completude", c, f"trim({c}) <> ''", "raw_cases", by)
            for c in cat.COMPLETENESS_COLUMNS]


def _domain(by: str) -> list[str]:
    return [_row_rule(f"Validade Domínio - {c}", "Validade", c, f"{c} IS NULL OR trim(upper({c})) IN {_list(v)}",
                      "raw_cases", by) for c, v in cat.DOMAINS.items()]


def _temporal(by: str) -> list[str]:
    out = []
    for a, b, name in cat.DATE_ORDERS:
        cols = name.replace(" <= ", " / ").replace(" >= ", " / ")
        pa, pb = _prefix.format(c=a), _prefix.format(c=b)
        out.append(_row_rule(f"Consistência Temporal - {name}", "Consistência", cols,
                             f"{pa} IS NULL OR {pb} IS NULL OR {pa} <= {pb}", "raw_cases", by))
    return out


def _unique(keys: tuple[str, ...], source: str, by: str) -> str:
    test = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (f"SELECT {by} AS run, 'Unicidade - {' + '.join(keys)}' AS rule, 'Unicidade' AS dim, "
            f"'{' / '.join(keys)}' AS col, count(*) AS total, count(DISTINCT ({', '.join(keys)})) AS valid "
            f"FROM {source} WHERE {test} GROUP BY 1")


def _fresh(by: str) -> list[str]:
    return [f"SELECT {by} AS run, 'Atualidade - {c}' AS rule, 'Atualidade' AS dim, '{c}' AS col, 1 AS total, "
            f"CAST(coalesce(DATE '{cb.AS_OF}' - max({_prefix.format(c=c)})::DATE <= 30, false) AS INTEGER) AS valid "
            f"FROM raw_cases GROUP BY 1" for c in cat.FRESH_COLUMNS]


def _all_rules(by: str) -> list[str]:
    return (_completeness(by) + _domain(by) + _temporal(by)
            + [_unique(k, "raw_cases", by) for k in cat.UNIQUE_KEYS] + _fresh(by))


_AT = f"'{q.RULES_AT} 00:00:00'"


def _case_oracle(name: str, parts: list[str]) -> None:
    _oracle(name, _log(parts, "Bronze", "casos", "'run-q'", _AT), "raw_cases")


_case_oracle("rules_completeness", _completeness("1"))
_case_oracle("rules_domain", _domain("1"))
_case_oracle("rules_temporal", _temporal("1"))
_case_oracle("rules_freshness", _fresh("1"))
_case_oracle("rules_all", _all_rules("1"))
_case_oracle("append_log", _completeness("1") + _temporal("1"))
_oracle("rules_uniqueness", " UNION ALL ".join([
    _log([_unique(k, "raw_cases", "1") for k in cat.UNIQUE_KEYS], "Bronze", "casos", "'run-q'", _AT),
    _log([_unique(k, "lineitem", "1") for k in (("l_orderkey",), ("l_orderkey", "l_linenumber"))],
         "Bronze", "itens", "'run-q'", _AT),
    _log([_unique(k, "events", "1") for k in (("event_id",), ("user_id",))],
         "Bronze", "eventos", "'run-q'", _AT),
]), "raw_cases")


def _ratio(name: str, num: str, den: str, high: str, by: str) -> str:
    return (f"SELECT {by} AS run, 'Validade - {name}' AS rule, 'Acurácia' AS dim, '{num} / {den}' AS col, 1 AS total, "
            f"CAST(coalesce(sum({den}) > 0 AND round(sum({num}) / sum({den})::DOUBLE, 4) <= {high}, false) AS INTEGER) "
            f"AS valid FROM cases GROUP BY 1")


def _gold(by: str) -> list[str]:
    return [
        _row_rule("Completude - sk_tempo", "Completude", "sk_tempo", "sk_tempo IS NOT NULL", "cases", by),
        _row_rule("Completude - sk_classificacao", "Completude", "sk_classificacao",
                  "sk_classificacao IS NOT NULL", "cases", by),
        _ratio("taxa_mortalidade", "flag_obito_srag", "flag_evolucao_informada", "0.60", by),
        _ratio("taxa_uso_uti", "flag_uti", "flag_hospitalizado", "1.0", by),
        _ratio("taxa_vacinacao_gripe", "flag_vacinado_gripe", "flag_info_vacina_gripe", "1.0", by),
        _ratio("taxa_vacinacao_covid", "flag_vacinado_covid", "flag_info_vacina_covid", "1.0", by),
        f"SELECT {by} AS run, 'Atualidade - dt_sin_pri' AS rule, 'Atualidade' AS dim, 'dt_sin_pri' AS col, 1 AS total, "
        f"CAST(coalesce(DATE '{cb.AS_OF}' - max(dt_sin_pri) <= 30, false) AS INTEGER) AS valid FROM cases GROUP BY 1",
    ]


_oracle("gold_checks", _log(_gold("1"), "Gold", "fato", "'run-g'", _AT), "cases")
_year_end = "substr(run, 5, 4) || '-12-31 00:00:00'"
_cte("run_events", "SELECT *, strftime(ts, '%Y-%m-%d') AS run_day, nullif(event_type, 'error') AS kind FROM events")
_cte("case_log", _log(_all_rules("run_id"), "Bronze", "casos", "run", _year_end), "raw_cases")
_cte("qlog", "SELECT * FROM case_log UNION ALL " + _log([
    _row_rule("Completude - event_type", "Completude", "event_type", "trim(kind) <> ''", "run_events", "run_day"),
    _row_rule("Validade - value", "Validade", "value", "value < 20", "run_events", "run_day"),
], "Bronze", "eventos", "run", "run || ' 00:00:00'"), "case_log", "run_events")
_cte("glog", _log(_gold("run_id"), "Gold", "fato", "run", _year_end), "cases")
_cte("complete", """
SELECT * FROM qlog WHERE run_id = (SELECT run_id FROM qlog GROUP BY run_id
  HAVING count(DISTINCT dimensao_dmbok) >= 5 ORDER BY max(dh_execucao) DESC, run_id DESC LIMIT 1)""", "qlog")
_oracle("quality_log_by_run", "SELECT * FROM qlog", "qlog")
_oracle("latest_complete_run", "SELECT run_id, regra_qualidade, registros_validos, severidade FROM complete", "complete")
_oracle("latest_covering_gold_run", """
SELECT * FROM glog WHERE run_id = (SELECT run_id FROM glog GROUP BY run_id
  ORDER BY count(DISTINCT dimensao_dmbok) DESC, max(dh_execucao) DESC, run_id DESC LIMIT 1)""", "glog")
_oracle("inherit_alerts", f"""
SELECT * EXCLUDE (observacao) REPLACE ('run-g' AS run_id,
    '{cat.INHERITED_PREFIX}' || regra_qualidade AS regra_qualidade, {_AT} AS dh_execucao),
  {_case('coluna_avaliada', cat.IMPACTS, f"'{cat.IMPACT_FALLBACK}'")} AS impacto_analitico,
  {_case('coluna_avaliada', cat.RECOMMENDATIONS, f"'{cat.RECOMMENDATION_FALLBACK}'")} AS recomendacao_tratamento
FROM case_log WHERE run_id = (SELECT max(run_id) FROM case_log) AND severidade IN ('CRÍTICO', 'ALTO')""", "case_log")
_SEV_NAMES = dict(zip(("criticos", "altos", "medios", "baixos", "aceitaveis"), cat.SEVERITY_ORDER))
_sev_counts = ", ".join(f"count(*) FILTER (severidade = '{s}') AS {n}" for n, s in _SEV_NAMES.items())
_oracle("severity_summary", f"""
SELECT *, CASE WHEN criticos > 0 THEN 'CRÍTICO' WHEN altos > 0 THEN 'ALTO' WHEN medios > 0 THEN 'MÉDIO'
  ELSE 'ACEITÁVEL' END AS nivel_geral FROM (SELECT {_sev_counts} FROM complete)""", "complete")
_cte("alert_sum", """
SELECT *, CASE WHEN criticos > 0 THEN 'CRÍTICO' WHEN altos > 0 THEN 'ALTO' ELSE 'ACEITÁVEL' END AS nivel_geral
FROM (SELECT count(*) FILTER (severidade = 'CRÍTICO') AS criticos, count(*) FILTER (severidade = 'ALTO') AS altos,
  coalesce(string_agg(severidade || ' | ' || coluna_avaliada || ' | ' || printf('%.1f', round(percentual_validade * 100, 1)),
    '; ' ORDER BY CASE severidade WHEN 'CRÍTICO' THEN 0 ELSE 1 END, regra_qualidade), '') AS alertas
  FROM complete WHERE severidade IN ('CRÍTICO', 'ALTO'))""", "complete")
_oracle("alert_summary", "SELECT * FROM alert_sum", "alert_sum")
_cte("both_logs", "SELECT * FROM qlog UNION ALL SELECT * FROM glog", "qlog", "glog")
_oracle("dimension_scores", """
SELECT dimensao_dmbok, round(avg(percentual_validade) FILTER (camada = 'Bronze'), 6) AS score_bronze,
  round(avg(percentual_validade) FILTER (camada = 'Gold'), 6) AS score_gold FROM both_logs GROUP BY 1""", "both_logs")
_oracle("run_history", f"""
SELECT camada, run_id, max(dh_execucao) AS dh_execucao, {_sev_counts},
  round(avg(percentual_validade), 6) AS score_medio, count(*) AS total_regras
FROM both_logs GROUP BY 1, 2 HAVING count(*) >= 3""", "both_logs")
_oracle("completeness_extract", "SELECT * FROM complete WHERE dimensao_dmbok = 'Completude'", "complete")
_oracle("validity_extract", """
SELECT * FROM complete WHERE dimensao_dmbok = 'Validade'
QUALIFY row_number() OVER (PARTITION BY coluna_avaliada ORDER BY regra_qualidade) = 1""", "complete")
_oracle("consistency_extract", """
SELECT * REPLACE (replace(regra_qualidade, 'Consistência Temporal - ', '') AS regra_qualidade)
FROM complete WHERE dimensao_dmbok = 'Consistência'""", "complete")
_oracle("accuracy_extract", "SELECT * FROM glog WHERE dimensao_dmbok IN ('Acurácia', 'Atualidade')", "glog")
_oracle("severity_ordered", "SELECT severidade, percentual_validade, regra_qualidade FROM complete", "complete")

# --- texts ---------------------------------------------------------------------------------------------


def _first_term(column: str, terms) -> str:
    return "CASE " + " ".join(
        f"WHEN contains(lower({column}), {_text(t)}) THEN {_text(t)}" for t in terms) + " END"


def _corrected(column: str, pairs: dict) -> str:
    out = column
    for wrong, right in pairs.items():
        out = f"regexp_replace({out}, {_text(wrong)}, {_text(right)}, 'gi')"
    return out


_PII_PATTERNS = {"cpf": r"\b\d{3}[.\-]?\d{3}[.\-]?\d{3}[.\-]?\d{2}\b",
                 "cpf_solto": r"\d{3}[.\-]?\d{3}[.\-]?\d{3}[.\-]?\d{2}", "cns": r"\b\d{15}\b"}
_hits = {n: f"len(regexp_extract_all(text, {_text(p)}))" for n, p in _PII_PATTERNS.items()}

_oracle("blocked_terms", f"""
SELECT doc_id, {_first_term('text', cat.BLOCKED_TERMS_APP)} AS termo_bloqueado,
  {_first_term('text', cat.BLOCKED_TERMS_APP)} IS NULL AS aprovado FROM documents""")
_oracle("blocked_questions", f"""
SELECT conv_id, turn, role, {_first_term('text', cat.BLOCKED_TERMS_AGENT)} AS termo_bloqueado,
  {_first_term('text', cat.BLOCKED_TERMS_AGENT)} IS NULL AS aprovado FROM conversations""")
_oracle("pii_detect", "SELECT doc_id, " + ", ".join(
    f"CAST({e} AS INTEGER) AS n_{n}" for n, e in _hits.items())
    + ", " + " + ".join(_hits.values()) + " > 0 AS contem_pii FROM documents")
_oracle("correct_terms", f"""
SELECT doc_id, {_corrected('text', q.TEXT_CORRECTIONS)} AS texto_corrigido FROM documents""")
_oracle("length_gate", r"""
SELECT conv_id, turn, role, motivo_tamanho, motivo_tamanho IS NULL AS tamanho_ok FROM (
  SELECT *, CASE WHEN text IS NULL OR length(regexp_replace(text, '^\s+|\s+$', '', 'g')) < 5 THEN 'curta'
    WHEN length(text) > 1000 THEN 'longa' END AS motivo_tamanho FROM conversations)""")
_oracle("guard_answers", f"""
SELECT doc_id, {_hits['cpf']} + {_hits['cns']} = 0 AS aprovado,
  CASE WHEN {_hits['cpf']} + {_hits['cns']} = 0 THEN md5({_corrected('text', cat.MISLEADING_TERMS)}) END AS m
FROM documents""")

_cte("articles", r"""
SELECT page_id, coalesce(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') AS titulo,
  regexp_extract(url, '^https?://([^/:?#]+)', 1) AS fonte, url, html AS resumo
FROM pages""")
_cte("unique_articles", """
SELECT * FROM articles QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1""", "articles")
_reliability = "CASE " + " ".join(
    f"WHEN contains(url, '{d}') THEN '{v}'" for d, v in cat.SOURCE_RELIABILITY.items()) + " ELSE 'Média' END"
_oracle("prepare_context", f"""
SELECT page_id, titulo, fonte, url, resumo, md5(url) AS news_id, {_reliability} AS confiabilidade_fonte,
  true AS usado_no_relatorio FROM unique_articles""", "unique_articles")
_words = (*cat.TITLE_KEYWORDS, "reti", "eau")
_oracle("context_by_keyword", f"""
SELECT page_id, md5(url) AS news_id, titulo FROM articles
WHERE {_first_term('titulo', _words)} IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1""", "articles")
_oracle("context_top", f"""
SELECT page_id, md5(url) AS news_id, fonte, {_reliability} AS confiabilidade_fonte FROM unique_articles
ORDER BY page_id LIMIT {cat.ARTICLE_CAP}""", "unique_articles")
_oracle("news_log", f"""
SELECT md5(url) AS news_id, 'run-n' AS run_id, '' AS termo_busca, titulo, fonte, '' AS data_publicacao, url, resumo,
  {_reliability} AS confiabilidade_fonte, true AS usado_no_relatorio, '{q.RULES_AT} 00:00:00' AS dh_consulta
FROM unique_articles""", "unique_articles")
_blocked = _first_term("p.text", cat.BLOCKED_TERMS_APP) + " IS NOT NULL"
_oracle("audit_log", f"""
SELECT sha256('run-a||' || p.conv_id || '||' || p.turn) AS audit_id, 'run-a' AS run_id,
  'user-' || p.conv_id AS usuario, p.text AS pergunta,
  CASE WHEN {_blocked} THEN '[]' ELSE '["indicadores","series"]' END AS tools_acionadas,
  CASE WHEN {_blocked} THEN '[]' ELSE '["kpi"]' END AS queries_executadas, '[]' AS fontes_noticias_consultadas,
  coalesce(r.text, '') AS resposta_resumida,
  CASE WHEN {_blocked} THEN '["G1_input_bloqueado"]' ELSE '[]' END AS guardrails_acionados,
  CASE WHEN {_blocked} THEN 'BLOQUEADO' ELSE 'SUCESSO' END AS status_execucao, {_AT} AS dh_execucao
FROM conversations p LEFT JOIN conversations r
  ON r.conv_id = p.conv_id AND r.turn = p.turn + 1 AND r.role = 'assistant'
WHERE p.role = 'user'""")

# --- consumers ---------------------------------------------------------------------------------------------

_kpi_rates = ("taxa_aumento_casos_7d", "taxa_mortalidade_30d", "taxa_uso_uti_30d",
              "taxa_vacinacao_gripe_30d", "taxa_vacinacao_covid_30d")
_oracle("kpi_with_alerts", f"""
SELECT {_day('data_referencia')} AS data_referencia, {_day('data_maxima_dataset')} AS data_maxima_dataset,
  defasagem_dias, casos_ultimos_7_dias, casos_7_dias_anteriores, casos_ultimos_30_dias, obitos_ultimos_30_dias,
  {', '.join(f'round({c} * 100, 2) AS {c}_pct' for c in _kpi_rates)},
  observacao_confiabilidade AS confiabilidade, nivel_geral, alertas AS alertas_qualidade,
  concat_ws('; ', {', '.join(_text(c) for c in cat.KPI_CAVEATS)}, 'taxa_aumento: ' || obs_aumento) AS limitacoes
FROM kpi, alert_sum""", "kpi", "alert_sum")
_oracle("daily_series_view", f"""
SELECT {_day('d')} AS data_referencia, total_casos, total_obitos, total_uti,
  round(taxa_mortalidade * 100, 2) AS taxa_mortalidade_pct, round(taxa_uso_uti * 100, 2) AS taxa_uso_uti_pct,
  round(media_movel_7d_casos, 1) AS media_movel_7d FROM daily, refd WHERE d BETWEEN ref - 29 AND ref""", "daily", "refd")
_oracle("monthly_series_view", """
SELECT ano_mes, total_casos, total_obitos, total_uti, total_hospitalizados,
  round(taxa_mortalidade * 100, 2) AS taxa_mortalidade_pct, round(taxa_uso_uti * 100, 2) AS taxa_uso_uti_pct
FROM monthly, first_month WHERE ano_mes >= fm""", "monthly", "first_month")

# --- ingestion and layout -------------------------------------------------------------------------------------

_version = ("CASE nome_arquivo_origem WHEN 'cases_F.csv' THEN 'F-1995' WHEN 'cases_O.csv' THEN 'O-1996' "
            "ELSE 'desconhecida' END")
_format = "CASE WHEN dt_sin_pri LIKE '%T%' THEN 'ISO_DATETIME_UTC' ELSE 'ISO_DATE' END"
_delivered = {c: f"nullif(trim({c}), '')" for c in RAW_COLUMNS
              if c not in ("dh_ingestao_bronze", "nome_arquivo_origem", "run_id")}
_delivered["dose_adic"] = "CASE WHEN nome_arquivo_origem <> 'cases_F.csv' THEN dose_adic END"
_cte("delivered", "SELECT " + ", ".join(f"{e} AS {c}" for c, e in _delivered.items()) + f""",
  {_AT} AS dh_ingestao_bronze, 'run-i' AS run_id, '{cat.SOURCE_SYSTEM}' AS nome_sistema_origem,
  {_version} AS versao_arquivo_origem, {_format} AS formato_data_origem FROM raw_cases""", "raw_cases")
_oracle("ingest_stream", "SELECT * FROM delivered", "delivered")
_oracle("schema_evolution", """
SELECT versao_arquivo_origem, count(*) AS total, count(dose_adic) AS com_dose_adic FROM delivered GROUP BY 1""",
        "delivered")
_oracle("file_lineage", """
SELECT versao_arquivo_origem, formato_data_origem, nome_sistema_origem, run_id, count(*) AS total
FROM delivered GROUP BY ALL""", "delivered")
_oracle("compact_and_cluster", f"SELECT * REPLACE ({_day('o_orderdate')} AS o_orderdate) FROM orders")
_oracle("overwrite_table", f"""
SELECT DISTINCT sk_classificacao, {_case('evolucao', cat.OUTCOME_LABELS)} AS desfecho
FROM cases""", "cases")
_oracle("vault_checked_write", f"""
SELECT DISTINCT {_salted('nu_notific')} AS hash_caso, {_salted('nu_cpf')} AS nu_cpf_hash, nm_pacient
FROM raw_cases""", "raw_cases")
_cte("gold_log", _log(_gold("1"), "Gold", "fato", "'run-g'", _AT), "cases")
_oracle("stages_gold", """
SELECT 'dim_tempo' AS tabela, count(DISTINCT dt_sin_pri) AS linhas, CAST(NULL AS BIGINT) AS casos FROM cases
UNION ALL SELECT 'dim_localidade', count(DISTINCT sk_localidade), NULL FROM cases
UNION ALL SELECT 'dim_perfil', count(DISTINCT sk_perfil), NULL FROM cases
UNION ALL SELECT 'dim_classificacao', count(DISTINCT sk_classificacao), NULL FROM cases
UNION ALL SELECT 'fact', count(*), count(*) FROM cases
UNION ALL SELECT 'agg_diarias', count(*), CAST(sum(total_casos) AS BIGINT) FROM daily0
UNION ALL SELECT 'agg_mensais', count(*), CAST(sum(total_casos) AS BIGINT) FROM monthly
UNION ALL SELECT 'agg_indicadores', count(*), NULL FROM kpi
UNION ALL SELECT 'orfaos', 4, 0
UNION ALL SELECT 'quality', count(*), CAST(sum(registros_invalidos) AS BIGINT) FROM gold_log""",
        "cases", "daily0", "monthly", "kpi", "gold_log")
_oracle("stages_beds", f"""
SELECT uf, ano_mes, uti_total_exist, 'run-b' AS run_id, {_AT} AS dh_ingestao_silver FROM rollup""", "rollup")
_oracle("interleaved_clustering", f"""
SELECT l_suppkey, count(*) AS linhas, {_day('min(l_shipdate)')} AS primeira, max(l_partkey) AS maior_peca FROM lineitem GROUP BY 1""")
_cte("current_days", """
SELECT dh_ultima_atualizacao::DATE AS d, count(*) AS total_casos, CAST(sum(CASE WHEN evolucao = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS total_obitos,
  CAST(sum(CASE WHEN classi_fin <= '2' THEN 1 ELSE 0 END) AS BIGINT) AS total_graves
FROM merged WHERE registro_mais_atual GROUP BY 1""", "merged")
_oracle("incremental_daily_series", f"""
SELECT {_day('d')} AS data_referencia, total_casos, total_obitos, total_graves, {_rate('total_obitos', 'total_casos')} AS taxa_mortalidade,
  round(avg(total_casos) OVER (ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 2) AS media_movel_7d_casos FROM current_days""", "current_days")
_oracle("incremental_monthly_series", """
SELECT strftime(d, '%Y-%m') AS ano_mes, CAST(sum(total_casos) AS BIGINT) AS total_casos, CAST(sum(total_obitos) AS BIGINT) AS total_obitos,
  CAST(sum(total_graves) AS BIGINT) AS total_graves FROM current_days GROUP BY 1""", "current_days")
ORACLES["stored_quality_run"] = ORACLES["latest_complete_run"]
ORACLES["scd2_table_close_only"] = ORACLES["scd2_close_only"]
