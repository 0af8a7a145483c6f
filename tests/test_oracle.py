"""Every registered query against its SQL, on the smallest tables."""

import pytest
from oracle_check import compare, oracle_connection

from tilth.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


@pytest.mark.oracle
@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(spark, con, name):
    problem = compare(spark, con, name, catalog.QUERIES[name], catalog.ORACLES[name], SF)
    assert problem == "", problem


#: a bootstrapped forest can't be grown in SQL; test_forest.py holds nodes and walk against the model and against SQL over stored nodes
WITHOUT_SQL = {"forest_nodes", "forest_predictions"}


def test_every_query_has_its_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES) | WITHOUT_SQL


def test_entry(spark):
    import __spark_entry__ as entry

    out = entry.entry(spark)
    assert out.columns == ["doy", "year", "lc", "mean_cum_gdd", "mean_bbch", "n"]
    assert not out.isEmpty()
    assert set(entry.oracle_sql()) <= set(entry.queries())
