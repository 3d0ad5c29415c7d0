"""Registered queries against their SQL on the smallest tables."""

import pytest
from compare import difference

import __spark_entry__ as contract
from rankloom.catalog import evaluation, files, preferences, search

FOLDER = "/root/testdata/sf0.001"
# One query per family; ``python tests/compare.py`` runs them all.
CHOSEN = (
    "tok_words analyze postings field_stats query_terms score_bm25 search_bm25 phrase_match_analyzed "
    "rank_run ranked_rel m_map m_bpref m_ndcg m_g eval_judged_only summary_complete report_lines "
    "m_p_avgjg pref_closure m_prefs_simp m_prefs_rnonrel m_prefs_rnonrel_of_qrels "
    "src_docs_lat src_topics src_run append_index"
).split()


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, name):
    df = contract.queries()[name](spark, FOLDER)
    assert difference(df, FOLDER, contract.oracle_sql()[name]) is None


def test_every_query_has_sql():
    own = {name for catalog in (search, evaluation, preferences, files) for name in catalog.QUERIES}
    assert own <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())
