"""Every registered query: against its SQL twin where it has one, for rows otherwise."""

import pytest
from compare import compare, duck

from tallyrill.plans import QUERIES, TWINS

FOLDER = "/root/testdata/sf0.001"
# slow without a twin, and covered by tests of their operators
HEAVY = {"ml14_grid_cross_validation", "ml16_cross_validated_score", "ml17_stepwise_tuning", "imp06_chained_forest", "ml14_grid_ledger", "ts10_multiplicative_orders"}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_twin(spark, con, name):
    assert compare(spark, con, FOLDER, name, QUERIES[name], TWINS[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(TWINS) - HEAVY))
def test_rows(spark, name):
    df = QUERIES[name](spark, FOLDER)
    assert len(df.columns) == len(set(df.columns))
    assert df.limit(1).count() == 1


def test_entry_has_rows(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
