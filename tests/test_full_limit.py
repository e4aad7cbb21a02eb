"""The chain at its default block limit against SQL where blocks are large, and that the small limit is only for the names that say so."""

import pytest

from tests.compare import duck, same
from weftline.plans import catalog, oracle

SF = "/root/testdata/sf0.01"
NAMES = ("blocks_stage1", "pairs_with_kind", "pairs_capped", "pair_features", "entities", "resolved", "q_match_stats", "q_blocking_stats_overall", "q_stage_counts", "resolved_6", "blocks_heavy_6", "stage3_tokens_6")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql_on_large_blocks(spark, con, name):
    assert same(catalog.queries()[name](spark, SF), con, oracle.oracle_sql()[name]) == ""


def test_plain_names_have_the_default_limit(spark):
    assert catalog.PARAMS.max_block_size == 200 == catalog.Chain(spark, SF).p.max_block_size
    assert catalog.queries()["blocks_heavy_6"](spark, SF).count() > 0


def test_model_scores_all_pairs(spark):
    assert catalog.queries()["pair_scores_ml"](spark, SF).count() == catalog.queries()["pairs_capped"](spark, SF).count()
