"""Registered queries against their SQL, with the usual and with the hot-group plans."""

import pytest
from conftest import SMALL
from oracle import compare

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()
# queries whose plan changes when groups or keys are hot
HOT = [
    "forward_fill_category",
    "six_stats_rows",
    "rank_apps_in_user",
    "top2_by_duration",
    "global_dense_rank",
    "class_weight_index",
    "class_dominant_app_counts",
    "one_hot_selected",
    "tfidf_usage",
    "tfidf_installed",
    "app_list_union",
    "encode_sequence",
]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    problem, _ = compare(spark, con, name, SMALL, QUERIES, SQL)
    assert problem == ""


@pytest.mark.parametrize("name", HOT)
def test_hot_plan_matches_sql(hot, con, name):
    problem, rows = compare(hot, con, name, SMALL, QUERIES, SQL)
    assert problem == "" and rows > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
