"""Every registered query equals its DuckDB oracle (order-insensitive) at sf0.001."""

import pytest

import __spark_entry__ as E
from bomspark.plans import registry
from conftest import SF_SMALL
from oracle_compare import compare, duck

# the training-data queries have tests of their own, as not all can have SQL
QUERIES = {name: E.queries()[name] for name in registry.QUERIES}
ORACLES = registry.ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    ok, msg = compare(df, con, ORACLES[name])
    assert ok, f"{name}: {msg}"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["Engine_serial_count", "option_assembly_num",
                          "esn_config_design_config_Shop_order_num", "build_year",
                          "Child_Part_Number"]
    assert df.count() == 340
