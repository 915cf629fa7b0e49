import pytest

from __spark_entry__ import entry, oracle_sql, queries
from sparkwarden.plans.oracle import SQL
from sparkwarden.plans.queries import REGISTRY
from tests.compare import connect, difference, rows_of_spark, rows_of_sql

SF_DIR = "/root/testdata/sf0.001"
# A cross-section; ``python -m tests.compare`` runs all of them.
NAMES = [
    "parse_log_lines", "enrich_events", "sessionize_gap", "sessionize_hot_source", "session_events_hot_source", "score_labels",
    "riskiest_sessions", "timeline_5min", "value_histogram", "detection_eval_labeled", "vector_topk_filtered", "points_upsert",
    "session_technique_mapping", "mapping_eval_labeled", "technique_mitigations",
    "invalid_labels", "knowledge_sample", "vector_covariance",
]


@pytest.fixture(scope="module")
def sql_side():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sql_side, name):
    found = rows_of_spark(queries()[name](spark, SF_DIR))
    assert difference(found, rows_of_sql(sql_side, oracle_sql()[name])) is None
    assert sum(found[1].values()) > 0


def test_entry(spark):
    assert entry(spark).count() == 10


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


# Scores of fitted models and of hashed words. ``forest_properties`` and ``pca_properties`` have SQL for what holds for
# any fit; tests/test_vectors.py compares the rest with brute force.
WITHOUT_SQL = {"index_search", "session_search", "isolation_forest_scores", "pca_3d", "detect_forest", "detect_lof", "map_sessions_text"}


def test_every_query_has_sql():
    assert set(REGISTRY) - set(SQL) == WITHOUT_SQL
