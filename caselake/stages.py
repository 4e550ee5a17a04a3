"""The table stages end to end: raw cases to history, history to star schema and indicators.

Each stage reads tables that an earlier one wrote, so nothing is computed
twice. Writes cluster by the columns later reads filter on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.operators import capacity, metrics, normalize, privacy, quality, star, versioning
from caselake.sources import history, tables

# table -> columns its files are clustered by, several of them interleaved
CLUSTERING = {
    "dim_tempo": ("data",),
    "dim_localidade": ("sg_uf",),
    "fact": ("dt_sin_pri", "sk_classificacao", "sk_localidade"),
    "agg_diarias": ("data_referencia",),
    "agg_mensais": ("ano_mes",),
    "leitos": ("uf", "ano_mes"),
    "leitos_por_uf": ("uf", "ano_mes"),
}


def stamp(df: DataFrame, run_id: str, now: Column, column: str) -> DataFrame:
    """Load time and run of a published table."""
    return df.withColumns({column: now, "run_id": F.lit(run_id)})


def silver_cases(bronze: DataFrame, salt: str) -> DataFrame:
    """Typed, pseudonymised, fingerprinted case versions, one per case and content."""
    keyed = privacy.add_case_key(bronze, salt)
    typed = normalize.type_cases(privacy.mask_for_analytics(keyed, salt))
    return versioning.dedup_case_versions(versioning.fingerprint_cases(typed))


def pending_cases(
    spark: SparkSession, bronze: DataFrame, name: str, stamp_column: str = "dh_ingestao_bronze"
) -> DataFrame:
    """Raw rows ingested after everything that was delivered, however many runs wait.

    The newest delivered stamp comes from the manifest; no stored case is read.
    Without any stamp all rows are pending.
    """
    if not tables.table_exists(spark, name):
        return bronze
    never = F.lit("0001-01-01").cast("timestamp")
    return versioning.unmerged_runs(bronze, F.coalesce(history.newest_stamp(spark, name), never), stamp_column)


def load_cases(
    spark: SparkSession, bronze: DataFrame, name: str, root: str, vault_path: str, salt: str,
    delivery: str, now: Column,
) -> None:
    """One delivery of raw cases into the vault and the versioned history."""
    tables.write_checked(
        privacy.build_pii_vault(bronze, salt, delivery), f"{vault_path}/delivery={delivery}",
        {"hash_caso": F.col("hash_caso").isNotNull()},
    )
    source = stamp(silver_cases(bronze, salt), delivery, now, "dh_ingestao_silver")
    history.merge_delivery(spark, name, root, delivery, source, now)


def publish(df: DataFrame, name: str, table: str, root: str, files: int | None) -> DataFrame:
    """Write a table clustered for its readers and return it as stored."""
    columns = CLUSTERING.get(name, ())
    laid_out = tables.cluster(df, columns, files, interleave=True) if columns else df
    tables.overwrite(laid_out, table, root)
    return tables.read_table(df.sparkSession, table)


def build_gold(
    current: DataFrame, prefix: str, root: str, run_id: str, as_of: Column, now: Column,
    files: int | None = None,
) -> dict[str, DataFrame]:
    """Dimensions, fact, series, snapshot and their checks, all written and read back.

    ``current`` is read once per table built from it: pass settled rows. The fact
    is deduplicated and written once; the indicators read the stored fact.
    """
    def write(name: str, df: DataFrame, n: int | None = None) -> DataFrame:
        stamped = stamp(df, run_id, now, "dh_ingestao_gold")
        return publish(stamped, name, f"{prefix}_{name}", root, n)

    gold = {
        "dim_tempo": write("dim_tempo", star.date_dimension(current)),
        "dim_localidade": write("dim_localidade", star.place_dimension(current)),
        "dim_perfil": write("dim_perfil", star.profile_dimension(current)),
        "dim_classificacao": write("dim_classificacao", star.class_dimension(current)),
        "fact": write("fact", star.fact_table(current), files),
    }
    fact = gold["fact"]
    gold["agg_diarias"] = write("agg_diarias", metrics.daily_metrics(fact))
    gold["agg_mensais"] = write("agg_mensais", metrics.monthly_metrics(fact))
    gold["agg_indicadores"] = write("agg_indicadores", metrics.kpi_snapshot(fact, as_of))
    gold["orfaos"] = star.orphan_counts(fact, {
        "sk_tempo": gold["dim_tempo"], "sk_localidade": gold["dim_localidade"],
        "sk_perfil": gold["dim_perfil"], "sk_classificacao": gold["dim_classificacao"],
    })
    gold["quality"] = quality.run_rules(
        fact, quality.fact_rules(), "Gold", f"{prefix}_fact", as_of, now, run_id
    )
    return gold


def build_beds(
    raw: DataFrame, prefix: str, root: str, run_id: str, now: Column, files: int | None = None
) -> dict[str, DataFrame]:
    """Facility-month rows and their roll-up; no roll-up row may lack its place."""
    def write(name: str, df: DataFrame, n: int | None = None) -> DataFrame:
        stamped = stamp(df, run_id, now, "dh_ingestao_silver")
        return publish(stamped, name, f"{prefix}_{name}", root, n)

    beds = write("leitos", capacity.type_beds(raw), files)
    rollup = write("leitos_por_uf", capacity.capacity_rollup(beds))
    quality.assert_rules(rollup, quality.completeness(["uf"]))
    return {"leitos": beds, "leitos_por_uf": rollup}
