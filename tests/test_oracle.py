"""Every query with a SQL counterpart gives the same rows, values compared exactly."""

import pytest
from compare import difference

import __spark_entry__ as entry
from candlewright.plans import queries

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), ORACLES[name], sf_dir) is None


def test_every_query_but_models_has_sql():
    assert set(queries.QUERIES) - set(ORACLES) == {"ml_forest", "ml_kmeans"}


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
