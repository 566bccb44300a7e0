"""Atomic publishing and incremental collections."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.functions import udf

from conftest import SF_SMALL
from recoda.operators.infer import first_candidate_predictor, letter_count_embedder
from recoda.operators.vector_index import build_index
from recoda.plans import entrypoints as EP
from recoda.plans import jobs
from recoda.session import scratch_path
from recoda.sources import fixtures as X
from recoda.sources import published as P
from recoda.sources.collection import build_collection
from recoda.sources.sinks import write_results, write_table
from recoda.sources.tables import attach_collection, read_runs
from recoda.sources.templates import load_template


def failing(df):
    @udf("string")
    def boom(x):
        raise RuntimeError("disk on fire")

    return df.withColumn("nace2025", boom("nace2025"))


def results(spark, code, n=6):
    rows = [(str(i), code, "True", 0.5, i % 2 == 0) for i in range(n)]
    return spark.createDataFrame(rows, "liasse_numero string, nace2025 string, nace08_valid string, confidence double, codable boolean")


def test_a_failing_writer_leaves_the_old_version_readable(spark, tmp_path):
    root = str(tmp_path / "runs")
    write_results(results(spark, "0111A"), root, "m/x", "r1", 1)
    for _ in range(2):
        with pytest.raises(Exception, match="disk on fire"):
            write_results(failing(results(spark, "0222B")), root, "m/x", "r1", 1)
        held = read_runs(spark, root, {"m/x": ["r1"]}).collect()
        assert [r["nace2025"] for r in held] == ["0111A"] * 6 and {r["model"] for r in held} == {"m/x"}
    opened = read_runs(spark, root, {"m/x": ["r1"]})  # a reader that opened the old version goes on reading it
    write_results(results(spark, "0333C", 4), root, "m/x", "r1", 1)
    assert opened.count() == 6
    assert [r["nace2025"] for r in read_runs(spark, root, {"m/x": ["r1"]}).collect()] == ["0333C"] * 4
    write_results(results(spark, "0444D"), root, "m/x", "r1", 1)
    assert len(P.children(spark, f"{root}/model=m--x/run_id=r1/shard=1")) == 2  # the one before, no older ones
    write_results(results(spark, "0555E"), root, "m/x", "r1", 2)  # another shard of the same run
    assert read_runs(spark, root, {"m/x": ["r1"]}).count() == 12
    assert read_runs(spark, root, {"other": ["r1"]}).count() == 0 == read_runs(spark, root, {}).count()


def test_a_failing_table_writer_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "table")
    write_table(results(spark, "0111A"), path)
    with pytest.raises(Exception, match="disk on fire"):
        write_table(failing(results(spark, "0222B")), path)
    assert spark.read.parquet(path).select("nace2025").distinct().collect() == [("0111A",)]
    write_table(spark.read.parquet(path).limit(2), path)  # even from itself
    assert spark.read.parquet(path).count() == 2
    assert os.listdir(tmp_path) == ["table"]


def counting_embedder(folder):
    def embed(texts):
        with open(f"{folder}/{os.getpid()}", "a") as f:
            f.writelines(f"{t}\n" for t in texts)
        return np.array([[len(t), 1.0] for t in texts]).reshape(-1, 2)

    return embed


def embedded(folder):
    return sorted(line.strip() for name in os.listdir(folder) for line in open(f"{folder}/{name}"))


def test_a_second_build_embeds_changed_documents_only(spark, tmp_path):
    folder, root = tmp_path / "calls", str(tmp_path / "collection")
    folder.mkdir()
    docs = spark.createDataFrame([(f"c{i}", f"text {i}") for i in range(9)], "code string, content string")
    first = build_collection(docs, counting_embedder(str(folder)), "m1", root)
    assert first[1:] == (9, 0, 0) and len(embedded(folder)) == 9
    again = build_collection(docs.repartition(3), counting_embedder(str(folder)), "m1", root)
    assert again == (first.path, 0, 9, 0) and len(embedded(folder)) == 9  # nothing embedded, nothing written
    changed = docs.filter("code <> 'c0'").withColumn("content", F.when(F.col("code") == "c1", "new").otherwise(F.col("content")))
    changed = changed.unionByName(spark.createDataFrame([("c9", None)], docs.schema))
    third = build_collection(changed, counting_embedder(str(folder)), "m1", root)
    assert third[1:] == (2, 7, 2) and embedded(folder)[:2] == ["", "new"]
    coll, model = attach_collection(spark, root)
    assert model == "m1" and {r["code"]: r["vector"][0] for r in coll.collect()} == {
        **{f"c{i}": 6.0 for i in range(2, 9)}, "c1": 3.0, "c9": 0.0}
    other = build_collection(changed, counting_embedder(str(folder)), "m2", root)  # another model's vectors are not mixed in
    assert other[1:] == (9, 0, 0) and attach_collection(spark, root)[1] == "m2"
    with pytest.raises(ValueError):
        build_collection(docs.unionByName(docs), counting_embedder(str(folder)), "m1", root)


def test_a_failing_build_leaves_the_collection(spark, tmp_path):
    root = str(tmp_path / "collection")
    docs = spark.createDataFrame([("a", "x"), ("b", "y")], "code string, content string")
    build_collection(docs, letter_count_embedder(), "m", root)

    def broken(texts):
        raise RuntimeError("no model")

    with pytest.raises(Exception, match="no model"):
        build_collection(docs.withColumn("content", F.lit("z")), broken, "m", root)
    assert attach_collection(spark, root)[0].select("content").collect() == [("x",), ("y",)]


def test_retrieval_job_over_a_stored_index(spark, tmp_path):
    mp, docs = jobs.mapping(spark, SF_SMALL), jobs.q_label_documents(spark, SF_SMALL)
    vectors, _ = attach_collection(spark, EP.build_label_collection(mp, letter_count_embedder, "m", str(tmp_path / "c"), True))
    index = build_index(vectors, str(tmp_path / "index"), "code", "vector", wanted_recall=1.0, tune_queries=10_000)

    def run(name, **extra):
        root = scratch_path(spark, name)
        EP.encode_ambiguous(
            X.extraction(spark, SF_SMALL), mp, X.ground_truth(spark, SF_SMALL), first_candidate_predictor,
            load_template(None, "retrieval-classifier"), "m", "r", root, strategy="retrieval", order=["row_seq"],
            retrieval={"documents": docs, "embedder": letter_count_embedder(),
                       "retriever_template": load_template(None, "retriever"), **extra})
        return dict(read_runs(spark, root, {"m": ["r"]}).select("liasse_numero", "nace2025").collect())

    by_index, by_all = run("t-i1", index=index), run("t-i2")
    assert set(by_index) == set(by_all)
    assert sum(by_index[i] == by_all[i] for i in by_all) / len(by_all) >= 0.9
