"""What the plans must look like to hold at scale."""

import re

import pytest

from claimlens.operators import enrich, marts
from claimlens.plans import star_tables as star
from claimlens.plans.star_queries import QUERIES


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_products(spark, small_dir, name):
    plan = physical(QUERIES[name](spark, small_dir))
    assert not re.search(r"Python|Pandas|ArrowEval|CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert "Expand" not in plan or name in ("geo_rollup", "profile_nulls", "profile_columns", "reconcile_geo")


def test_year_bounds_reach_the_scan(spark, small_dir):
    plan = physical(QUERIES["scan_year_filter"](spark, small_dir))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate,1997-01-01", plan)
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(o_orderdate,1998-01-01", plan)


def test_scans_read_only_used_columns(spark, small_dir):
    plan = physical(QUERIES["geo_state"](spark, small_dir))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert not any("l_discount" in s or "c_name" in s or "p_size" in s for s in schemas)


def test_marts_do_not_pay_for_unread_registry_columns(spark, small_dir):
    fact = enrich.enrich(star.flagged_fact(spark, small_dir), star.registry(spark, small_dir))
    assert "s_suppkey" in optimized(fact)
    assert "s_suppkey" not in optimized(marts.provider_summary(fact))


def test_one_plan_for_every_n_and_no_window_over_a_specialty(spark, small_dir):
    few, many = (physical(QUERIES[name](spark, small_dir)) for name in ("q_topn_by_specialty", "q_topn_large"))
    assert re.sub(r"\d+", "", few) == re.sub(r"\d+", "", many)
    windows = re.findall(r"Window \[[^\n]*", many)
    assert windows and all("__block" in w or "provider_total_claims" in w for w in windows)


@pytest.mark.parametrize("name", ["q_top100_providers", "q_top25_drugs", "q_top10_states", "top_states_opioid"])
def test_top_k_needs_no_full_sort(spark, small_dir, name):
    assert "TakeOrderedAndProject" in physical(QUERIES[name](spark, small_dir))


@pytest.mark.parametrize("name", ["q_rank_in_state", "q_lod_state_avg"])
def test_no_window_over_all_providers_of_a_state(spark, small_dir, name):
    windows = re.findall(r"Window \[[^\n]*", physical(QUERIES[name](spark, small_dir)))
    assert all("__block" in w for w in windows)


def test_each_word_list_is_searched_once_per_row(spark, small_dir):
    plan = optimized(QUERIES["risk_category"](spark, small_dir))
    assert plan.count("Contains(drug_name") == 6 and plan.count("Contains(generic_name") == 6
