"""Registered queries against their SQL twins: a selection of every family, or with PANELFORGE_ALL=1 all of them."""

import os

import pytest

import __spark_entry__ as contract
from panelforge.storage import materialize, shared_dir
from panelforge.workload.catalog import REGISTRY
from tests.oracle import compare, connect

SMALL = "/root/testdata/sf0.001"
ALWAYS = (
    "build_monthly_panel build_daily_panel link_entities accounting_panel size_concentration macro_predictors "
    "beta_daily beta_trailing_days median_sort annual_compound assign_portfolio clean_trades trade_scope "
    "agg_cov_matrix ols_single ols_by_group ols_cross_section ols_fe_twoway_parts se_cluster_oneway se_newey_west "
    "spec_grid_unnest agg_quantile_narrowed win_ntile_narrowed join_validity_hot join_asof_stale join_asof_blocks "
    "win_shift_blocks win_fill_down_blocks win_rows_frame_spoilt win_slide_regression scan_factor_csv_annual refresh_daily_panel nest_pieces"
).split()
NAMES = list(REGISTRY) if os.environ.get("PANELFORGE_ALL") else ALWAYS


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_against_sql(spark, duck, name):
    found = contract.queries()[name](spark, SMALL).toPandas()
    assert compare(found, duck.sql(contract.oracle_sql()[name]).df()) == "ok"


def test_every_query_outside_the_corpus_has_a_twin():
    assert all(query.oracle() for query in REGISTRY.values())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_is_named_once():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == folder
    stored = materialize(spark.range(3))
    assert stored.inputFiles()[0].removeprefix("file://").startswith(folder) and stored.count() == 3
