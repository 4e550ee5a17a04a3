"""Domain catalogues: the configuration data the operators consume.

Everything below is a fixed value: column names, code lists, labels, terms and
patterns have to equal those of the case-notification domain for the results to
be right. The operators themselves take any of these as parameters.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: dates -----------------------------------------------------
DATE_FORMATS = (
    "yyyy-MM-dd",
    "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'",
    "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "yyyyMMdd",
)
DATE_COLUMNS = (
    "dt_notific", "dt_sin_pri", "dt_nasc", "dt_ut_dose", "dt_vac_mae",
    "dt_doseuni", "dt_1_dose", "dt_2_dose", "dt_antivir", "dt_interna",
    "dt_entuti", "dt_saiduti", "dt_raiox", "dt_coleta", "dt_pcr",
    "dt_evoluca", "dt_encerra", "dt_digita", "dt_vgm", "dt_rt_vgm",
    "dt_tomo", "dt_res_an", "dt_co_sor", "dt_res", "dt_trt_cov",
)
WATERMARK_COLUMNS = ("dt_digita", "dt_encerra", "dt_notific", "dh_ingestao_bronze")
MONTH_NAMES = {
    1: "Janeiro", 2: "Fevereiro", 3: "Março", 4: "Abril", 5: "Maio", 6: "Junho",
    7: "Julho", 8: "Agosto", 9: "Setembro", 10: "Outubro", 11: "Novembro", 12: "Dezembro",
}

# --- fixed values: typing ----------------------------------------------------
INT_COLUMNS = (
    "nu_idade_n", "tp_idade", "cs_gestant", "cs_raca", "cs_escol_n", "cs_zona",
    "febre", "tosse", "garganta", "dispneia", "desc_resp", "saturacao",
    "diarreia", "vomito", "dor_abd", "fadiga", "perd_olft", "perd_pala",
    "fator_risc", "cardiopati", "asma", "diabetes", "neurologic", "pneumopati",
    "imunodepre", "renal", "obesidade", "tabag", "vacina", "vacina_cov",
    "hospital", "uti", "suport_ven", "amostra", "pcr_resul", "pos_pcrflu",
    "tp_flu_pcr", "classi_fin", "criterio", "evolucao", "res_an",
)
DOSE_COLUMNS = ("dose_1_cov", "dose_2_cov", "dose_ref", "dose_2ref", "dose_adic", "dos_re_bi")
AGE_EDGES = (5, 12, 18, 30, 40, 50, 60, 70, 80)
AGE_LABELS = (
    "00-04", "05-11", "12-17", "18-29", "30-39", "40-49", "50-59", "60-69", "70-79", "80+",
)

# --- fixed values: privacy ---------------------------------------------------
DIRECT_PII = (
    "nu_cpf", "nu_cns", "nm_pacient", "nm_mae_pac", "nu_cep", "nm_bairro",
    "nm_logrado", "nu_numero", "nm_complem", "nu_ddd_tel", "nu_telefon",
    "observa", "nome_prof", "reg_prof", "vg_prof",
)
QUASI_PII_HIGH = ("dt_nasc",)
QUASI_PII_LOW_KEPT = (
    "id_mn_resi", "id_regiona", "id_rg_resi", "nm_un_inte", "morb_desc", "outro_des", "tem_cpf",
)
UNANALYTIC_COLUMNS = (
    "lote_1_cov", "lote_2_cov", "lote_ref", "lote_ref2", "lote_adic", "lot_re_bi",
    "fab_cov1", "fab_cov2", "fab_covrf", "fab_covrf2", "fab_adic", "fab_re_bi",
    "fab_cov_1", "fab_cov_2", "formato_data_origem",
)
FACILITY_PRIVATE_COLUMNS = (
    "no_logradouro", "nu_endereco", "no_complemento", "no_bairro", "co_cep",
    "nu_telefone", "no_email", "razao_social", "motivo_desabilitacao",
)
FALLBACK_KEY_COLUMNS = (
    "dt_notific", "dt_sin_pri", "sg_uf_not", "co_mun_not", "cs_sexo", "nu_idade_n",
)
TECHNICAL_COLUMNS = (
    "dh_ingestao_bronze", "nome_arquivo_origem", "run_id", "nome_sistema_origem",
    "versao_arquivo_origem", "dh_ultima_atualizacao", "hash_registros",
    "dh_ingestao_silver", "registro_mais_atual", "dh_inicio_vigencia",
    "dh_fim_vigencia", "hash_caso",
)
LINEAGE_COLUMNS = (
    "dh_ingestao_bronze", "nome_arquivo_origem", "run_id", "nome_sistema_origem",
    "versao_arquivo_origem", "formato_data_origem",
)


# --- fixed values: 0/1 flags -------------------------------------------------
@dataclass(frozen=True)
class Flag:
    """1 when ``column`` holds one of ``codes`` (or ``or_present`` is not NULL), else 0."""

    name: str
    column: str | None = None
    codes: tuple[int, ...] = ()
    or_present: str | None = None


CASE_FLAGS = (
    Flag("flag_caso_srag"),
    Flag("flag_obito_srag", "evolucao", (2,)),
    Flag("flag_obito_outras_causas", "evolucao", (3,)),
    Flag("flag_cura", "evolucao", (1,)),
    Flag("flag_evolucao_informada", "evolucao", (1, 2, 3)),
    Flag("flag_hospitalizado", "hospital", (1,), or_present="dt_interna"),
    Flag("flag_uti", "uti", (1,)),
    Flag("flag_uso_suporte_ventilatorio", "suport_ven", (1, 2)),
    Flag("flag_vacinado_gripe", "vacina", (1,)),
    Flag("flag_info_vacina_gripe", "vacina", (1, 2)),
    Flag("flag_vacinado_covid", "vacina_cov", (1,)),
    Flag("flag_info_vacina_covid", "vacina_cov", (1, 2)),
    Flag("flag_covid_classificacao_final", "classi_fin", (5,)),
    Flag("flag_influenza_classificacao_final", "classi_fin", (1,)),
    Flag("flag_outro_virus_classificacao_final", "classi_fin", (2,)),
    Flag("flag_srag_nao_especificado", "classi_fin", (4,)),
)
FLAG_NAMES = tuple(flag.name for flag in CASE_FLAGS)

# --- fixed values: decode tables ---------------------------------------------
NOT_INFORMED = "Não informado"
SEX_LABELS = {"M": "Masculino", "F": "Feminino", "I": "Ignorado"}
RACE_LABELS = {
    1: "Branca", 2: "Preta", 3: "Amarela", 4: "Parda", 5: "Indígena", 9: "Ignorado",
}
PREGNANCY_LABELS = {
    1: "1º Trimestre", 2: "2º Trimestre", 3: "3º Trimestre",
    4: "Idade Gestacional Ignorada", 5: "Não", 6: "Não se aplica", 9: "Ignorado",
}
SCHOOLING_LABELS = {
    0: "Sem escolaridade/Analfabeto", 1: "Fundamental 1º ciclo", 2: "Fundamental 2º ciclo",
    3: "Médio", 4: "Superior", 5: "Não se aplica", 9: "Ignorado",
}
CLASSIFICATION_LABELS = {
    1: "SRAG por Influenza", 2: "SRAG por outro vírus respiratório",
    3: "SRAG por outro agente etiológico", 4: "SRAG não especificado", 5: "SRAG por COVID-19",
}
CRITERION_LABELS = {
    1: "Laboratorial", 2: "Clínico Epidemiológico", 3: "Clínico", 4: "Clínico Imagem",
}
OUTCOME_LABELS = {1: "Cura", 2: "Óbito", 3: "Óbito por outras causas", 9: "Ignorado"}
MANAGEMENT_LABELS = {"M": "Municipal", "E": "Estadual", "D": "Dupla", "S": "Sem Gestão"}

# --- fixed values: metrics (output column -> summed flag) ----------------------
DAILY_SUMS = {
    "total_casos": "flag_caso_srag",
    "total_obitos": "flag_obito_srag",
    "total_casos_com_evolucao": "flag_evolucao_informada",
    "total_hospitalizados": "flag_hospitalizado",
    "total_uti": "flag_uti",
    "total_vacinados_gripe": "flag_vacinado_gripe",
    "total_info_vacina_gripe": "flag_info_vacina_gripe",
    "total_vacinados_covid": "flag_vacinado_covid",
    "total_info_vacina_covid": "flag_info_vacina_covid",
    "total_covid": "flag_covid_classificacao_final",
    "total_influenza": "flag_influenza_classificacao_final",
}
MONTHLY_SUMS = {
    **DAILY_SUMS,
    "total_outro_virus": "flag_outro_virus_classificacao_final",
    "total_srag_nao_especificado": "flag_srag_nao_especificado",
}
# rate column -> (numerator, denominator) among the summed columns
RATES = {
    "taxa_mortalidade": ("total_obitos", "total_casos_com_evolucao"),
    "taxa_uso_uti": ("total_uti", "total_hospitalizados"),
    "taxa_vacinacao_gripe_registrada": ("total_vacinados_gripe", "total_info_vacina_gripe"),
    "taxa_vacinacao_covid_registrada": ("total_vacinados_covid", "total_info_vacina_covid"),
}
GROWTH_NOTE = "Período anterior sem registros — taxa de aumento não calculável."
RELIABILITY_FRESH = "Dataset atualizado. Métricas confiáveis."
RELIABILITY_DELAYED = " dias de defasagem. Tendência recente pode estar subnotificada."
RELIABILITY_STALE = " dias de defasagem. Interpretar métricas recentes com cautela."
KPI_CAVEATS = (
    "Dataset batch — não streaming real.",
    "taxa_uso_uti NÃO representa ocupação real de leitos.",
    "taxa_vacinacao NÃO representa cobertura vacinal populacional.",
    "Atraso de digitação de 7 a 30 dias esperado no SIVEP-Gripe.",
)

# --- fixed values: bed capacity ------------------------------------------------
BED_SUMS = {
    "leitos_existentes_total": "leitos_existentes",
    "leitos_sus_total": "leitos_sus",
    "uti_total_exist": "uti_total_exist",
    "uti_total_sus": "uti_total_sus",
    "uti_adulto_exist": "uti_adulto_exist",
    "uti_adulto_sus": "uti_adulto_sus",
    "uti_pediatrico_exist": "uti_pediatrico_exist",
    "uti_pediatrico_sus": "uti_pediatrico_sus",
    "uti_neonatal_exist": "uti_neonatal_exist",
    "uti_neonatal_sus": "uti_neonatal_sus",
    "uti_queimado_exist": "uti_queimado_exist",
    "uti_queimado_sus": "uti_queimado_sus",
    "uti_coronariana_exist": "uti_coronariana_exist",
    "uti_coronariana_sus": "uti_coronariana_sus",
}

MIX_SUMS = {
    "covid": "total_covid", "influenza": "total_influenza", "outro_virus": "total_outro_virus",
    "srag_nao_esp": "total_srag_nao_especificado", "obitos": "total_obitos", "evolucao": "total_casos_com_evolucao",
    "total_casos": "total_casos", "uti": "total_uti", "hosp": "total_hospitalizados",
}
MIX_SHARES = {"taxa_mortalidade_pct": ("obitos", "evolucao"), "taxa_uso_uti_pct": ("uti", "hosp")}
COVERAGE_NAMES = ("meses_cobertos", "primeiro_mes", "ultimo_mes")
COVERAGE_SUMS = {"total_uti_exist": "uti_total_exist"}

# --- fixed values: data quality --------------------------------------------------
SEVERITY_LIMITS = ((0.80, "CRÍTICO"), (0.90, "ALTO"), (0.95, "MÉDIO"), (0.99, "BAIXO"))
SEVERITY_OK = "ACEITÁVEL"
SEVERITY_ORDER = ("CRÍTICO", "ALTO", "MÉDIO", "BAIXO", "ACEITÁVEL")
ALERT_SEVERITIES = ("CRÍTICO", "ALTO")
COMPLETENESS_COLUMNS = (
    "nu_notific", "dt_notific", "dt_sin_pri", "sg_uf", "co_mun_res", "classi_fin",
    "evolucao", "uti", "vacina", "vacina_cov", "hospital",
)
YES_NO_UNKNOWN = ("1", "2", "9")
DOMAINS = {
    "cs_sexo": ("M", "F", "I", "1", "2", "9"),
    "tp_idade": ("1", "2", "3"),
    "cs_gestant": ("1", "2", "3", "4", "5", "6", "9"),
    "cs_raca": ("1", "2", "3", "4", "5", "9"),
    "febre": YES_NO_UNKNOWN,
    "tosse": YES_NO_UNKNOWN,
    "dispneia": YES_NO_UNKNOWN,
    "saturacao": YES_NO_UNKNOWN,
    "fator_risc": YES_NO_UNKNOWN,
    "vacina": YES_NO_UNKNOWN,
    "vacina_cov": YES_NO_UNKNOWN,
    "uti": YES_NO_UNKNOWN,
    "hospital": YES_NO_UNKNOWN,
    "evolucao": ("1", "2", "3", "9"),
    "classi_fin": ("1", "2", "3", "4", "5"),
    "suport_ven": ("1", "2", "3", "9"),
    "pcr_resul": ("1", "2", "3", "4", "5", "9"),
    "criterio": ("1", "2", "3", "4"),
}
# (earlier date, later date, name of the rule)
DATE_ORDERS = (
    ("dt_sin_pri", "dt_notific", "dt_sin_pri <= dt_notific"),
    ("dt_sin_pri", "dt_interna", "dt_interna >= dt_sin_pri"),
    ("dt_sin_pri", "dt_entuti", "dt_entuti >= dt_sin_pri"),
    ("dt_entuti", "dt_saiduti", "dt_saiduti >= dt_entuti"),
    ("dt_sin_pri", "dt_evoluca", "dt_evoluca >= dt_sin_pri"),
    ("dt_notific", "dt_encerra", "dt_encerra >= dt_notific"),
)
UNIQUE_KEYS = (("nu_notific",), ("nu_notific", "dt_sin_pri", "dt_notific"))
FRESH_COLUMNS = ("dt_sin_pri", "dt_notific", "dt_digita")
FRESHNESS_LIMIT_DAYS = 30
INHERITED_PREFIX = "[Herdado Bronze] "
IMPACTS = {
    "classi_fin": "Afeta TODAS as taxas de classificação (COVID, Influenza, SRAG não especificado).",
    "evolucao": "Afeta diretamente a taxa de mortalidade. Casos sem evolução são excluídos do denominador.",
    "uti": "Afeta taxa de uso de UTI entre hospitalizados.",
    "vacina": "Afeta taxa de vacinação contra gripe registrada.",
    "vacina_cov": "Afeta taxa de vacinação COVID registrada.",
    "nu_notific": "Nulos impedem deduplicação — duplicatas podem inflar contagem total de casos.",
    "dt_sin_pri": "Nulos excluem registros das séries temporais e das agregadas diária e mensal.",
}
RECOMMENDATIONS = {
    "classi_fin": "Investigar registros sem classificação. Avaliar se são casos ainda em investigação.",
    "evolucao": "Considerar janela de 30 dias para casos recentes (atraso de digitação esperado).",
    "uti": "Verificar se campos UTI=NULL representam ausência de internação ou não preenchimento.",
    "vacina": "Campos NULL tratados como 'informação ausente' — excluídos do denominador da taxa.",
    "vacina_cov": "Idem vacina. Verificar integração com Base Nacional de Vacinação.",
    "nu_notific": "Registros sem nu_notific usam chave técnica alternativa na Silver.",
    "dt_sin_pri": "Registros sem dt_sin_pri são excluídos de todas as séries temporais Gold.",
}
IMPACT_FALLBACK = "Ver Bronze Quality."
RECOMMENDATION_FALLBACK = "Investigar registros inválidos na Bronze."
CONSISTENCY_PREFIX = r"Consistência [Tt]emporal\s*[-–]\s*"

# --- fixed values: text guards ----------------------------------------------------
BLOCKED_TERMS_AGENT = (
    "quem é o paciente", "qual é o nome", "cpf do paciente", "cns do paciente",
    "nome completo", "mostre os nomes", "identifique o paciente", "dados do paciente",
    "auditoria_pii", "mapa_identificacao", "mapa pii",
)
BLOCKED_TERMS_APP = (
    "nome do paciente", "cpf", "rg", "endereço", "telefone", "identific", "quem é",
    "dados pessoais", "prontuário",
)
MISLEADING_TERMS = {
    "ocupação de leitos": "uso de UTI registrado entre casos SRAG hospitalizados",
    "ocupação de UTI": "uso de UTI registrado entre casos SRAG hospitalizados",
    "cobertura vacinal": "vacinação registrada entre casos SRAG",
    "cobertura de vacinação": "vacinação registrada entre casos SRAG",
}
CPF_BOUNDED = r"\b\d{3}[.\-]?\d{3}[.\-]?\d{3}[.\-]?\d{2}\b"
CPF_ANYWHERE = r"\d{3}[.\-]?\d{3}[.\-]?\d{3}[.\-]?\d{2}"
CNS_BOUNDED = r"\b\d{15}\b"
QUESTION_MIN_CHARS = 5
QUESTION_MAX_CHARS = 1000
SOURCE_RELIABILITY = {
    "gov.br": "Alta", "paho.org": "Alta", "who.int": "Alta", "fiocruz.br": "Alta",
    "g1.globo.com": "Média-Alta",
}
RELIABILITY_DEFAULT = "Média"
TITLE_KEYWORDS = ("srag", "gripe", "influenza", "surto", "epidemia", "síndrome respiratória")
ARTICLE_CAP = 20
STATUS_OK = "SUCESSO"
STATUS_BLOCKED = "BLOQUEADO"
SOURCE_SYSTEM = "Open DATASUS - SIVEP-Gripe"
UNKNOWN_VERSION = "desconhecida"
FORMAT_UNKNOWN = "DESCONHECIDO"
FORMAT_DATETIME = "ISO_DATETIME_UTC"
FORMAT_DATE = "ISO_DATE"
