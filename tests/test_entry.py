"""Driver contract and oracle parity of every tier-S query at sf 0.001."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from aisleflow.plans.oracle import ORACLE_SQL
from aisleflow.plans.queries import QUERIES
from aisleflow.sources.tables import TABLES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns[0] == "cid"


def test_every_fit_has_a_checked_fact():
    """Queries without SQL of their own are numbers of a fit, and beside each fit stand
    facts over all rows that SQL checks."""
    missing = {n for n in set(QUERIES) - set(ORACLE_SQL)}
    assert missing <= {"random_split", "kmeans_fit", "kmeans_quality", "kmeans_assignment", "kmeans_sweep", "gmm_fit", "gmm_summary",
                       "lda_topics", "lda_doc_topics", "lda_quality", "lda_hashed_topics", "nb_fit", "logreg_fit", "logreg_metrics",
                       "logreg_label_metrics", "logreg_history", "logreg_test_predictions", "logreg_test_scores", "logreg_binary_fit",
                       "tree_fit", "tree_nodes", "tree_text", "tree_importances", "svc_fit", "svc_predictions", "mlp_predictions",
                       "run_log", "model_roundtrip", "tree_node_counts"}


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return round(v, 9) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
          "boolean": "BOOLEAN", "float": "FLOAT"}


def _duck_type(spark_type) -> str:
    s = spark_type.simpleString()
    if s.startswith("array<"):
        return _TYPES.get(s[6:-1], s[6:-1]) + "[]"
    return _TYPES.get(s, s)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle_parity(spark, sf, duck, name):
    df = E.queries()[name](spark, sf)
    rows = df.collect()
    cur = duck.execute(E.oracle_sql()[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, rows) == _rows(dcols, drows)
    dtypes = {r[0]: r[1] for r in duck.execute(f"DESCRIBE ({E.oracle_sql()[name]})").fetchall()}
    assert {f.name: _duck_type(f.dataType) for f in df.schema.fields} == dtypes


@pytest.mark.parametrize("name", ["customer_class_pivot", "category_clicks", "review_label_encodings", "label_index", "doc_tfidf",
                                  "nb_likelihoods", "nb_predictions", "term_vocabulary", "basket_recommendations", "gini_splits"])
def test_parity_without_broadcast_joins(spark, sf, duck, name):
    """The plans of large inputs: no side is broadcast for being small."""
    from aisleflow.plans import cache
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    cache.clear()
    try:
        df = E.queries()[name](spark, sf)
        cur = duck.execute(E.oracle_sql()[name])
        assert _rows(df.columns, df.collect()) == _rows([d[0] for d in cur.description], cur.fetchall())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        cache.clear()
