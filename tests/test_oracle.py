"""Registered queries against their DuckDB statements.

A spread of queries by default; ``TALLYHOUSE_ALL=1`` runs every one.
"""

import os

import pytest
from compare import differences, duck

import __spark_entry__ as entry

SQL = entry.oracle_sql()
QUERIES = entry.queries()
USUAL = (
    "s1_csv_scan s3_load_metadata s6_seed_scan p1_stg_orders p5_stg_inventory_movements d1_dim_date "
    "d2_dim_menu_item f1_fact_orders f3_fact_employee_shifts i2_ingredient_consumption i5_service_performance "
    "k1_daily_performance k2_channel_profitability k3_menu_engineering "
    "k4_labour_productivity k5_service_quality k6_inventory_risk k7_review_analysis w1_rank_in_category "
    "w2_running_balance w7_trailing_window q1_apply_filters q4_item_demand_by_temperature q9_busiest_slot "
    "q12_plowhorses q20_demand_pivot q22_labour_cost_quartiles q25_quadrant_lines v3_orders v7_inventory "
    "v9_key_summary v13_seed_references v14_bounds_orders x1_features_by_channel x9_forecast_by_channel x10_staffing "
    "r2_snapshot_as_of r5_session_summary r10_rejected_events r1_stream_rolling r6_stream_minutes a1_ingredient_consumption "
    "a4_kitchen_load a6_order_economics a8_calendar"
).split()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL) if os.environ.get("TALLYHOUSE_ALL") else USUAL)
def test_query_equals_its_statement(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0
