import duckdb
import pytest

from lodestone.plans import catalog

from .conftest import SF

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUICK = ["hash16_identity", "exact_dedup_first_wins", "shingle_counts", "first_sentence", "truncate_code", "bm25_topk", "eval_metrics", "classify_content_type", "classify_difficulty", "topic_argmax", "topic_normalize", "extract_calls", "prereq_edges", "consensus_vote", "migrate_v1", "render_topic_page", "json_walk", "stream_dedup", "imported_samples", "vector_index_search", "model_answers", "voted_answers", "enriched_documents", "retried_jobs", "text_forms"]


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", QUICK)
def test_agrees_with_sql(spark, oracle, name):
    got = catalog.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    rows = sorted(map(repr, (tuple(r) for r in got.select(*columns).collect())))
    want = oracle.execute(catalog.SQL[name]).df()[columns]
    want = sorted(map(repr, want.astype(object).where(want.notna(), None).itertuples(index=False, name=None)))
    assert rows == want


def test_every_sql_has_a_query():
    assert set(catalog.SQL) <= set(catalog.QUERIES)
