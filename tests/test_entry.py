import os

import pytest

import sys
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E
from hourwise.checks.queries import QUERIES
from oracle_harness import compare, duck

from conftest import SF_SMALL


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "1DayLag" in df.columns


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    rows_only = set(QUERIES) - set(E.oracle_sql())
    assert rows_only == {"ml_gbt_random_split", "ml_gbt_early_stop", "topk_importance", "pipe_forecast_asof"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("key", sorted(set(E.oracle_sql()) & set(QUERIES)))
def test_query_matches_oracle_small(spark, con, key):
    r = compare(spark, con, key, E.queries()[key], E.oracle_sql()[key], SF_SMALL)
    assert r["status"] == "ok", r
