"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck
from roadwatch.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, SF, con)
    if res.get("oracle") == "none":
        assert res["spark_rows"] > 0
        return
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["columns_match"], res
    assert res["values_match"], res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
