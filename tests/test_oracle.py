"""Every query with SQL equals DuckDB at a small scale."""

import pytest

import __spark_entry__ as e
from tests.compare import duck, same
from weftline.plans import catalog, oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert same(catalog.queries()[name](spark, SF), con, oracle.oracle_sql()[name]) == ""


def test_entry(spark):
    assert e.entry(spark).columns[0] == "entity_id"


def test_ml_scores_are_probabilities(spark):
    r = catalog.queries()["pair_scores_ml"](spark, SF).agg({"model_score": "min"}).first()[0]
    assert 0.0 <= r <= 1.0
