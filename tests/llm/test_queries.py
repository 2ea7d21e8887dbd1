import pytest

from hourwise.llm.registry import ORACLES, QUERIES
from oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, key, QUERIES[key], ORACLES[key], SF)
    assert r["status"] == "ok", r


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
