"""Registered queries against their SQL over the whole test tables.

By default one or more queries of every operator family; ``CASELAKE_ALL=1`` runs them all
(as does ``python -m tests.compare``).
"""

import os

import pytest

import __spark_entry__ as contract
from caselake.plans.oracles import ORACLES as REGISTERED_SQL
from caselake.plans.queries import REGISTRY
from tests.compare import database, difference

QUERIES, ORACLES = REGISTRY, REGISTERED_SQL
FAMILIES = (
    "daily_metrics daily_ma7_calendar daily_metrics_by_place monthly_metrics kpi_snapshot kpi_report_long "
    "category_mix place_month_matrix remainder_share parse_date_multi detect_date_format decode_codes "
    "derive_flags calendar pii_vault masked_view natural_key surrogate_keys dim_date dim_place dim_profile "
    "fact orphan_counts rollup_by_dimension capacity_use dedup_latest dedup_case_versions scd2_merge "
    "scd2_close_only scd2_table_roundtrip rules_all rules_uniqueness latest_complete_run inherit_alerts "
    "dimension_scores blocked_terms pii_detect correct_terms prepare_context audit_log kpi_with_alerts "
    "ingest_stream compact_and_cluster overwrite_table stages_gold"
).split()
CHECKED = sorted(ORACLES) if os.environ.get("CASELAKE_ALL") else FAMILIES


@pytest.fixture(scope="module")
def con(data_dir):
    return database(data_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, data_dir, name):
    assert difference(spark, con, data_dir, QUERIES[name], ORACLES[name]) is None


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() > 0
