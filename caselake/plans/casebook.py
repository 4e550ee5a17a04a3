"""Case-shaped inputs derived from the test tables.

One order is one case notification. Its line items, reduced to one row per
order before any join, give hospital, intensive-care and vaccination codes; its
customer gives place and person. Three delivery styles (by order status) write
dates in different formats.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.functions import keys
from caselake.operators import normalize, privacy, versioning
from caselake.sources import tables

SALT = "case-salt"
AS_OF = "2001-08-11"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_of() -> Column:
    return F.lit(AS_OF).cast("date")


def stamp(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def case_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: what its line items say.

    Every aggregate is a number or a date, so Spark reduces by hash on the map side.
    """
    shipped = {
        "first_ship": "min(cast(l_shipdate AS date))",
        "last_ship": "max(cast(l_shipdate AS date))",
        "first_r": "min(CASE WHEN l_returnflag = 'R' THEN cast(l_shipdate AS date) END)",
        "last_r": "max(CASE WHEN l_returnflag = 'R' THEN cast(l_shipdate AS date) END)",
        "first_n": "min(CASE WHEN l_returnflag = 'N' THEN cast(l_shipdate AS date) END)",
        "last_f": "max(CASE WHEN l_linestatus = 'F' THEN cast(l_shipdate AS date) END)",
    }
    marks = {
        "has_a": "max(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END)",
        "has_open": "max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END)",
        "has_filled": "max(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END)",
        "top_discount": "max(l_discount)",
        "n_lines": "count(1)",
    }
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(*[F.expr(e).alias(n) for n, e in {**shipped, **marks}.items()])
    )


def case_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their place; nation and region are small lookups."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_acctbal", "c_mktsegment",
                "n_nationkey", "n_name", "r_regionkey", "r_name")
    )


# case column -> expression over orders and their line items
_PRIORITY = "substring(o_orderpriority, 1, 1)"
_HOSPITAL = "CASE WHEN has_a = 1 THEN '1' WHEN first_n IS NOT NULL THEN '2' WHEN n_lines IS NOT NULL THEN '9' END"
_ICU = "CASE WHEN first_r IS NOT NULL THEN '1' WHEN n_lines IS NOT NULL THEN '2' END"
_FLU = "CASE WHEN has_open = 0 THEN '1' WHEN has_filled = 0 THEN '2' WHEN n_lines IS NOT NULL THEN '9' END"
_COVID = ("CASE WHEN top_discount >= 0.08D THEN '1' WHEN top_discount >= 0.05D THEN '2' "
          "WHEN n_lines IS NOT NULL THEN ' ' END")
CASE_DATES = {
    "dt_notific": "first_ship",
    "dt_sin_pri": "cast(o_orderdate AS date)",
    "dt_interna": "first_n",
    "dt_entuti": "first_r",
    "dt_saiduti": "last_f",
    "dt_evoluca": "last_ship",
    "dt_encerra": "last_r",
    "dt_digita": f"CASE WHEN {_PRIORITY} <> '5' THEN last_ship END",
    "dose_1_cov": "first_ship",
    "dose_2_cov": "first_r",
    "dose_ref": "first_n",
    "dose_adic": "last_f",
}
CASE_CODES = {
    "nu_notific": "cast(o_orderkey AS string)",
    "tp_idade": f"CASE WHEN {_PRIORITY} < '3' THEN {_PRIORITY} WHEN {_PRIORITY} < '5' THEN '3' ELSE '9' END",
    "cs_gestant": "cast(n_lines AS string)",
    "cs_escol_n": "CASE o_orderstatus WHEN 'F' THEN '0' WHEN 'O' THEN '3' ELSE 'x' END",
    "febre": "CASE WHEN o_totalprice > 300000 THEN '1' WHEN o_totalprice > 100000 THEN '2' ELSE '9' END",
    "tosse": _ICU,
    "dispneia": _HOSPITAL,
    "saturacao": _FLU,
    "fator_risc": "CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE '1' END",
    "vacina": _FLU,
    "vacina_cov": _COVID,
    "hospital": _HOSPITAL,
    "uti": _ICU,
    "suport_ven": "cast(n_lines AS string)",
    "pcr_resul": "cast(n_lines AS string)",
    "classi_fin": _PRIORITY,
    "evolucao": f"CASE WHEN o_orderstatus = 'F' THEN '1' WHEN o_orderstatus = 'O' THEN '2' "
                f"WHEN {_PRIORITY} = '5' THEN '9' ELSE '3' END",
    "nu_cpf": "lpad(cast(o_custkey AS string), 11, '0')",
    "dh_ingestao_bronze": "cast(date_add(cast(o_orderdate AS date), 30) AS timestamp)",
    "nome_arquivo_origem": "concat('cases_', o_orderstatus, '.csv')",
    "run_id": "concat('run-', cast(year(o_orderdate) AS string))",
}
# case column -> expression over the customer
PERSON_DATES = {"dt_nasc": "date_sub(cast(o_orderdate AS date), cast(floor(c_acctbal) AS int))"}
PERSON_CODES = {
    "sg_uf": "concat(lower(r_name), ' ')",
    "sg_uf_not": "r_name",
    "co_mun_not": "cast(n_nationkey AS string)",
    "co_mun_res": "cast(n_nationkey AS string)",
    "id_mn_resi": "n_name",
    "sg_uf_inte": "CASE WHEN has_a = 1 THEN r_name END",
    "co_mu_inte": "CASE WHEN has_a = 1 THEN cast((n_nationkey + n_lines) % 25 AS string) END",
    "id_mn_inte": "CASE WHEN has_a = 1 THEN concat(n_name, '-', cast(n_lines AS string)) END",
    "cs_sexo": "CASE c_mktsegment WHEN 'MACHINERY' THEN 'M' WHEN 'FURNITURE' THEN 'f ' "
               "WHEN 'HOUSEHOLD' THEN 'I' WHEN 'BUILDING' THEN 'X' END",
    "nu_idade_n": "cast(cast(floor(c_acctbal / 100) AS int) AS string)",
    "cs_raca": "cast(r_regionkey + 1 AS string)",
    "criterio": "cast(r_regionkey + 1 AS string)",
    "nm_pacient": "c_name",
}


def _written(day: str) -> str:
    """A date the way the delivery of this order status writes it."""
    text = f"cast({day} AS string)"
    return (
        f"CASE WHEN o_orderstatus = 'F' THEN {text} "
        f"WHEN o_orderstatus = 'P' THEN replace({text}, '-', '') "
        f"WHEN {_PRIORITY} < '3' THEN concat({text}, 'T00:00:00.000Z') "
        f"ELSE concat({text}, 'T00:00:00Z') END"
    )


def _case_source(spark: SparkSession, sf_dir: str, people: bool) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    orders = orders.join(case_lines(spark, sf_dir), "o_orderkey", "left")
    return orders.join(case_people(spark, sf_dir), "o_custkey", "left") if people else orders


def bronze_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw cases: every data column text, plus lineage."""
    days = {n: _written(e) for n, e in {**CASE_DATES, **PERSON_DATES}.items()}
    columns = {**days, **CASE_CODES, **PERSON_CODES}
    return _case_source(spark, sf_dir, True).selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


def typed_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw cases pseudonymised and typed."""
    keyed = privacy.add_case_key(bronze_cases(spark, sf_dir), SALT)
    return normalize.type_cases(privacy.mask_for_analytics(keyed, SALT))


def cases(spark: SparkSession, sf_dir: str, people: bool = True) -> DataFrame:
    """The same typed cases with dates taken as dates, the way a typed table stores them.

    One row per case by source. Without ``people`` the customer columns and
    their join are left out, for indicators that need neither place nor person.
    """
    columns = {**CASE_DATES, **CASE_CODES}
    if people:
        columns |= {**PERSON_DATES, **PERSON_CODES}
    values = _case_source(spark, sf_dir, people).selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])
    keyed = privacy.add_case_key(values, SALT)
    return normalize.type_cases(privacy.mask_for_analytics(keyed, SALT))


def indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases with dates, stay and flags only."""
    return cases(spark, sf_dir, people=False)


FIRST_DELIVERY_BEFORE = "2000-01-01"


def deliveries(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two deliveries of case versions.

    The first holds the orders of before 2000. The second holds all orders as
    first reported and, for orders with line items, a later version whose
    outcome follows the line statuses; so it has unchanged, changed and new
    keys, and new keys with two versions at once. Versions of equal content are
    reduced to the latest by their text, beside the line items of their order;
    digests are computed of what is left.
    """
    day = F.col("o_orderdate").cast("date")
    case_hash = F.sha2(F.col("caso").cast("string"), 256).alias("hash_caso")
    reported = table(spark, sf_dir, "orders").select(
        F.sha2(F.col("o_orderkey").cast("string"), 256).alias("hash_caso"),
        F.col("o_orderkey").alias("caso"),
        F.col("o_orderstatus").alias("evolucao"),
        F.substring("o_orderpriority", 1, 1).alias("classi_fin"),
        day.cast("timestamp").alias("dh_ultima_atualizacao"),
    )
    lines = case_lines(spark, sf_dir).select(
        F.col("o_orderkey").alias("caso"), "has_open", "has_filled", "last_ship"
    )
    outcome = F.when(F.col("has_open") == 0, "F").when(F.col("has_filled") == 0, "O").otherwise("P")
    reported_as = F.struct("evolucao", "dh_ultima_atualizacao")
    followed_as = F.struct(
        outcome.alias("evolucao"),
        F.greatest(F.col("last_ship").cast("timestamp"), "dh_ultima_atualizacao").alias("dh_ultima_atualizacao"),
    )
    both = reported.join(lines, "caso", "left").select("caso", "classi_fin", F.inline(
        F.when(F.col("has_open").isNull(), F.array(reported_as)).otherwise(F.array(reported_as, followed_as))
    ))
    first = versioning.fingerprint_cases(
        reported.filter(F.col("dh_ultima_atualizacao") < stamp(FIRST_DELIVERY_BEFORE)), VERSION_FREE
    )
    content = keys.trimmed_text(sorted({"caso", "evolucao", "classi_fin"}))
    distinct = both.groupBy("caso", content.alias("_content")).agg(
        F.max("dh_ultima_atualizacao").alias("dh_ultima_atualizacao"),
        F.first("evolucao").alias("evolucao"), F.first("classi_fin").alias("classi_fin"),
    )
    latest = versioning.fingerprint_cases(
        distinct.select(case_hash, "caso", "evolucao", "classi_fin", "dh_ultima_atualizacao"), VERSION_FREE
    ).select(*first.columns)
    return first, latest


VERSION_FREE = ("dh_ultima_atualizacao", "hash_caso")


# line number -> intensive-care ward whose beds such line items stand for
BED_WARDS = {1: "PEDIATRICO", 2: "QUEIMADO", 3: "CORONARIANA"}


def bronze_beds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw facility-month rows: one per supplier and month of its line items, headers as delivered."""
    place = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    items = table(spark, sf_dir, "lineitem")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")

    def beds(condition: Column) -> Column:
        return F.count_if(condition).cast("string")

    stock = items.groupBy(
        "l_suppkey", F.date_format("l_shipdate", "yyyyMM").cast("int").alias("COMP")
    ).agg(
        F.count(F.lit(1)).cast("string").alias("LEITOS_EXISTENTES"),
        # a facility without public beds leaves text instead of a number
        F.when(F.count_if(flag == "N") > 0, beds(flag == "N")).otherwise("-").alias("LEITOS_SUS"),
        beds(flag == "R").alias("UTI_TOTAL_EXIST"),
        beds((flag == "R") & (status == "F")).alias("UTI_TOTAL_SUS"),
        beds((flag == "R") & (F.col("l_quantity") > 25)).alias("UTI_ADULTO_EXIST"),
        beds((flag == "R") & (F.col("l_quantity") <= 25)).alias("UTI_NEONATAL_EXIST"),
        beds((flag == "R") & (F.col("l_quantity") > 25) & (status == "F")).alias("UTI_ADULTO_SUS"),
        beds((flag == "R") & (F.col("l_quantity") <= 25) & (status == "F")).alias("UTI_NEONATAL_SUS"),
        *[beds((flag == "R") & (F.col("l_linenumber") == line) & own).alias(f"UTI_{ward}_{kind}")
          for line, ward in BED_WARDS.items() for kind, own in (("EXIST", F.lit(True)), ("SUS", status == "F"))],
    )
    supplier = table(spark, sf_dir, "supplier").join(
        place, F.col("s_nationkey") == F.col("n_nationkey")
    )
    return stock.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        "COMP",
        F.lower("r_name").alias("REGIAO"),
        F.concat(F.col("r_name"), F.lit("  ")).alias("UF"),
        F.col("n_name").alias("MUNICIPIO"),
        F.col("s_suppkey").cast("string").alias("CNES"),
        F.col("s_name").alias("NOME ESTABELECIMENTO"),
        F.col("s_name").alias("RAZÃO SOCIAL"),
        F.when(F.col("s_acctbal") > 5000, "M").when(F.col("s_acctbal") > 2000, "E")
        .when(F.col("s_acctbal") > 0, "D").alias("TP_GESTAO"),
        "LEITOS_EXISTENTES", "LEITOS_SUS", "UTI_TOTAL_EXIST", "UTI_TOTAL_SUS",
        "UTI_ADULTO_EXIST", "UTI_NEONATAL_EXIST", "UTI_ADULTO_SUS", "UTI_NEONATAL_SUS",
        *[f"UTI_{ward}_{kind}" for ward in BED_WARDS.values() for kind in ("EXIST", "SUS")],
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as articles."""
    html, url = F.col("html"), F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_extract(html, "(?is)<title[^>]*>(.*?)</title>", 1).alias("titulo"),
        F.regexp_extract(url, "^https?://([^/:?#]+)", 1).alias("fonte"),
        "url",
        html.alias("resumo"),
    )


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the answer of the next turn.

    The join key (conversation, turn) is unique, so long conversations do not skew it.
    """
    talk = table(spark, sf_dir, "conversations")
    asked = talk.filter(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("pergunta")
    )
    answers = talk.filter(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("resposta")
    )
    return asked.join(answers, ["conv_id", "turn"], "left")
