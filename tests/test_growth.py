"""Work that grows with the input and not with its square: plans and results of the parts that were mended."""

import re

import numpy as np
import pytest

from recoda.functions import constants as K
from recoda.operators import retrieve as R
from recoda.operators import vector_index as V
from recoda.operators.assemble import assemble
from recoda.operators.dedup import duplicate_keys


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def assembled(spark, prefer_human):
    # three activities, one of them with null attributes; i7 has no recode and a model and a human label reach it
    rows = [(f"i{i}" if i else None, "0101A", "seed", *[str(i % 3) if i % 3 else None] * 8) for i in range(30)]
    ex = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in K.EXTRACTION_COLUMNS))
    univ = spark.createDataFrame([("i1", "U"), ("i1", "V"), (None, "U"), (None, "U")], "liasse_numero string, nace2025 string")
    model = spark.createDataFrame([(f"i{i}", f"M{i}") for i in range(8, 20)] + [(None, "M")], "liasse_numero string, nace2025 string")
    human = spark.createDataFrame([("i7", "H"), ("i8", "H"), ("i10", "G")], "liasse_numero string, nace2025 string")
    return assemble(ex, univ, model, human, prefer_human=prefer_human)


@pytest.mark.parametrize("prefer_human", [False, True])
def test_violations_are_counted_without_the_final_table(spark, prefer_human):
    parts = assembled(spark, prefer_human)
    want = sorted(map(tuple, duplicate_keys(parts["final"], ["liasse_numero"]).collect()), key=str)
    got = parts["violations"]
    assert sorted(map(tuple, got.select("liasse_numero", "n_rows").collect()), key=str) == want
    assert bool(want) != prefer_human
    assert dict(got.dtypes)["n_rows"] == "bigint" and "sum(n_rows" in plan_of(got)


def test_assemble_makes_its_shared_parts_once(spark):
    parts = assembled(spark, True)
    for name in ("targets", "human"):
        assert "Window" not in plan_of(parts[name]) and "Join" not in plan_of(parts[name])


def frames(spark, n_queries, n_docs):
    vectors = np.random.default_rng(2).normal(size=(n_docs, 8))
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "doc_id long, doc_vec array<double>")
    queries = docs.limit(n_queries).selectExpr("doc_id AS query_id", "doc_vec AS query_vec")
    return queries, docs


def ranks(df):
    return sorted((r["query_id"], r["rank"], r["doc_id"]) for r in df.collect())


@pytest.mark.parametrize("scorer", [None, R.dot_product_scorer])
def test_few_queries_go_to_the_documents(spark, scorer):
    queries, docs = frames(spark, 20, 300)
    fetch = {"fetch_k": 10, "scorer": scorer} if scorer else {}
    few = R.similar_topk(queries, docs, 3, block_rows=50, **fetch)
    assert "CoGroups" not in plan_of(few)
    assert ranks(few) == ranks(R.similar_topk(queries, docs, 3, **fetch))


def test_each_side_is_shuffled_once_per_block_of_the_other(spark, monkeypatch):
    monkeypatch.setattr(R, "FEW_QUERIES", 0)
    queries, docs = frames(spark, 90, 400)
    blocked = R.similar_topk(queries, docs, 3, block_rows=64)  # 7 blocks; 8 shuffle partitions: 2 chunks
    plan = blocked._jdf.queryExecution().analyzed().toString()
    assert "CoGroups" in plan and re.search(r"xxhash64\(qid#\d+L, 42\), (cast\()?2\b", plan)
    assert ranks(blocked) == ranks(R.similar_topk(queries, docs, 3))


def test_a_query_goes_once_to_a_group_of_lists(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_ROWS", 100)
    assert V._groups(np.array([40, 40, 40, 250, 0, 100, 1])).tolist() == [0, 2, 3, 4, 6]
    queries, docs = frames(spark, 90, 400)
    index = V.build_index(docs, str(tmp_path / "index"))
    groups, asked = len(V._groups(index.rows)), []
    found = V._candidates

    def counted(probing, *rest):
        asked.append(probing.groupBy("qid").count().agg({"count": "max"}).first()[0])
        return found(probing, *rest)

    monkeypatch.setattr(V, "_candidates", counted)
    assert ranks(V.search_index(queries, index, 3, exact=True)) == ranks(R.similar_topk(queries, docs, 3))
    assert max(a or 0 for a in asked) <= groups < len(index.rows)
