"""Every query with a SQL twin gives the same rows as DuckDB on the test tables."""

import pytest

from panelmint.checks import ORACLES, QUERIES
from panelmint.checks.compare import difference, duck

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    want = con.sql(ORACLES[name]).df()
    assert len(want) > 0
    assert difference(QUERIES[name](spark, FOLDER).toPandas(), want) is None


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_fitted_span_asks_for_every_month(con):
    from panelmint.checks.registry import SPAN

    want = con.sql(ORACLES["walk_forward_ml_span"]).df()
    assert set(want["month"]) == set(range(1, SPAN.months + 1)) and len(want) == 3 * SPAN.months
    assert "walk_forward_ml_span" in QUERIES
