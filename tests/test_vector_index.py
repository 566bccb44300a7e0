"""The clustered index: recall against brute force, and its exact mode against the exhaustive search."""

import numpy as np
import pytest

from recoda.operators import vector_index as V
from recoda.operators.retrieve import dot_product_scorer, similar_topk
from recoda.plans import jobs

SF = "/root/testdata/sf0.1"


def frame(spark, matrix, ids="doc_id", vec="doc_vec", extra=()):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(matrix)] + list(extra)
    return spark.createDataFrame(rows, f"{ids} long, {vec} array<double>").repartition(4)


def pairs(df):
    return sorted((r["query_id"], r["rank"], r["doc_id"], round(r["cosine"], 9)) for r in df.collect())


@pytest.fixture(scope="module")
def clustered():
    """Clusters, one of them a third of all rows and partly equal, and two zero vectors."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16)) * 3
    size = [200] + [20] * 19
    points = np.vstack([c + rng.normal(size=(n, 16)) for c, n in zip(centres, size, strict=True)])
    points[:60] = points[0]  # ties
    return np.vstack([points, np.zeros((2, 16))])


def test_exact_mode_equals_the_exhaustive_search(spark, clustered, tmp_path, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_ROWS", 30)  # the hot list is cut, on both sides
    docs = frame(spark, clustered, extra=[(None, [1.0] * 16), (9000, None)])
    queries = frame(spark, clustered[::3], "query_id", "query_vec", [(8000, None), (8001, [0.0] * 16)])
    index = V.build_index(docs, str(tmp_path / "index"))
    assert index.rows.sum() == len(clustered)
    want = pairs(similar_topk(queries.na.drop(), docs.na.drop(), 5))
    for probes in (1, None):
        assert pairs(V.search_index(queries, index, 5, probes=probes, exact=True)) == want
    reopened = V.open_index(spark, str(tmp_path / "index"))
    assert pairs(V.search_index(queries, reopened, 5)) == pairs(V.search_index(queries, index, 5))
    rescored = V.search_index(queries, index, 3, exact=True, fetch_k=10, scorer=dot_product_scorer)
    wanted = similar_topk(queries.na.drop(), docs.na.drop(), 3, fetch_k=10, scorer=dot_product_scorer)
    assert rescored.columns == wanted.columns
    assert [(r["query_id"], r["doc_id"], r["rank"]) for r in rescored.orderBy("query_id", "rank").collect()] == [
        (r["query_id"], r["doc_id"], r["rank"]) for r in wanted.orderBy("query_id", "rank").collect()]


def test_recall_and_work_on_clustered_vectors(spark, clustered, tmp_path):
    docs, queries = frame(spark, clustered), frame(spark, clustered[::4], "query_id", "query_vec")
    index = V.build_index(docs, str(tmp_path / "index"))
    truth = {(q, d) for q, _, d, _ in pairs(similar_topk(queries, docs, 5))}
    found = {(q, d) for q, _, d, _ in pairs(V.search_index(queries, index, 5))}
    assert len(truth & found) / len(truth) >= 0.9 and index.recall >= 0.95
    assert index.probes <= len(index.centroids) // 3  # few lists are searched


def test_recall_on_the_given_vectors(spark):
    """Every vector whose id is divisible by 20, against all: these vectors have no clusters, so many lists are needed."""
    e = jobs.embeddings(spark, SF)
    truth = similar_topk(e.filter("vec_id % 20 = 0").selectExpr("vec_id AS query_id", "embedding AS query_vec"),
                         e.selectExpr("vec_id AS doc_id", "embedding AS doc_vec"), 5)
    want = {(r["query_id"], r["doc_id"]) for r in truth.collect()}
    got = {(r["query_id"], r["doc_id"]) for r in jobs.q_index_search(spark, SF).collect()}
    assert len(want & got) / len(want) >= 0.9
    exact = {(r["query_id"], r["doc_id"]) for r in jobs.q_index_search_exact(spark, SF).collect()}
    assert exact == want


def test_tiny_and_empty_sides(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id long, doc_vec array<double>")
    queries = frame(spark, [[1.0, 0.0]], "query_id", "query_vec")
    assert V.search_index(queries, V.build_index(empty, str(tmp_path / "a")), 5).count() == 0
    for k, rows in enumerate(([[0.0, 0.0]], [[1.0, 0.0]], [[1.0, 0.0], [0.0, 1.0], [1.0, 1.0]])):
        docs = frame(spark, rows)
        index = V.build_index(docs, str(tmp_path / f"i{k}"))
        assert pairs(V.search_index(queries, index, 5, exact=True)) == pairs(similar_topk(queries, docs, 5))
    assert V.search_index(queries.limit(0), index, 5).count() == 0
