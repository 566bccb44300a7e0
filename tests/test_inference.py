"""Resumable inference and the life cycle of models, with doubles that leave a trace of every call."""

import os
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from recoda.functions import constants as K
from recoda.functions.response import parse_answers, python_tokenizer
from recoda.operators import infer
from recoda.operators.resume import answers_of, log_answers, run_resumably
from recoda.plans import entrypoints as EP
from recoda.plans import jobs
from recoda.session import scratch_path
from recoda.sources import fixtures as X
from recoda.sources.sinks import write_results
from recoda.sources.tables import read_runs
from recoda.sources.templates import load_template


def counting(folder, fail_at=None):
    """A predictor that writes down every chat it is asked; it fails before the ``fail_at``-th call of a process."""

    def predict(chats, **settings):
        if fail_at is not None and len(os.listdir(folder)) >= fail_at:
            raise RuntimeError("the model died")
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write("\n".join(user["content"] for _, user in chats))
        return [(f"answer to {user['content']}", [1, 2], [-0.1, -0.2]) for _, user in chats]

    return predict


def asked(folder):
    out = Counter()
    for name in os.listdir(folder):
        with open(f"{folder}/{name}") as f:
            out.update(f.read().split("\n"))
    return out


def prompts(spark, n=100, template="question"):
    rows = [(f"id{i}" if i else None, "be brief", f"{template} {i}", i) for i in range(n)]
    return spark.createDataFrame(rows, "id string, system_prompt string, user_prompt string, extra int").repartition(4)


def test_a_killed_run_asks_for_missing_answers_only(spark, tmp_path):
    folder, log = tmp_path / "calls", str(tmp_path / "log")
    folder.mkdir()
    df = prompts(spark)
    with pytest.raises(Exception, match="the model died"):
        run_resumably(df, counting(str(folder), fail_at=6), log, "id", batch_rows=5)
    before = asked(folder)
    assert 0 < len(before) < 100
    held = answers_of(df, log, "id").collect()  # what was answered is not lost
    assert {r["output_text"] for r in held} == {f"answer to {q}" for q in before}
    out = run_resumably(df, counting(str(folder)), log, "id", batch_rows=5, tasks=3)
    assert asked(folder) == Counter({f"question {i}": 1 for i in range(100)})  # no prompt went to the model twice
    want = [(f"id{i}" if i else None, i, f"answer to question {i}", [1, 2], [-0.1, -0.2]) for i in range(100)]
    assert out.columns == ["id", "extra", "output_text", "token_ids", "logprobs"]
    assert sorted(map(tuple, out.collect()), key=lambda r: r[1]) == want
    again = run_resumably(df, counting(str(folder), fail_at=0), log, "id")  # nothing is missing: the model is not called
    assert again.count() == 100


def test_another_prompt_or_setting_is_asked_again(spark, tmp_path):
    folder, log = tmp_path / "calls", str(tmp_path / "log")
    folder.mkdir()
    run_resumably(prompts(spark, 10), counting(str(folder)), log, "id", settings={"seed": 1})
    mixed = prompts(spark, 5).unionByName(prompts(spark, 10, "changed").filter("extra >= 5"))
    out = run_resumably(mixed, counting(str(folder)), log, "id", settings={"seed": 1})
    assert sorted(r["output_text"] for r in out.collect()) == sorted(
        [f"answer to question {i}" for i in range(5)] + [f"answer to changed {i}" for i in range(5, 10)])
    assert sum(asked(folder).values()) == 15
    run_resumably(mixed, counting(str(folder)), log, "id", settings={"seed": 2})
    assert sum(asked(folder).values()) == 25


def test_rows_logged_twice_come_back_once_and_half_written_files_are_ignored(spark, tmp_path):
    folder, log = tmp_path / "calls", str(tmp_path / "log")
    folder.mkdir()
    df = prompts(spark, 20)
    run_resumably(df, counting(str(folder)), log, "id", batch_rows=4)
    spark.read.option("recursiveFileLookup", "true").parquet(log).limit(7).write.parquet(f"{log}/twin/part-000000")
    (tmp_path / "log" / "twin" / "part-000000" / "_0-000000.parquet").write_bytes(b"half")
    assert run_resumably(df, counting(str(folder), fail_at=0), log, "id").count() == 20
    assert run_resumably(df.limit(0), counting(str(folder), fail_at=0), str(tmp_path / "none"), "id").count() == 0
    with pytest.raises(ValueError):
        run_resumably(df, counting(str(folder)), log, "id", carry=["extra"])


def test_a_task_run_again_skips_what_its_first_attempt_logged(tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()
    rows = pa.RecordBatch.from_pydict({
        "id": [f"i{i}" if i else None for i in range(10)], "prompt_hash": list(range(10)),
        "__system": ["s"] * 10, "__user": [f"q{i}" for i in range(10)]})

    def attempt(number, model):
        ask = lambda part: infer.answered(part, ["id", "prompt_hash"], model, {})
        return log_answers(iter([rows]), str(tmp_path / "log" / "part-000003"), number, "id", 2, ask)

    with pytest.raises(RuntimeError):
        attempt(0, counting(str(folder), fail_at=2))
    assert attempt(1, counting(str(folder))) == 6
    assert asked(folder) == Counter({f"q{i}": 1 for i in range(10)})


def tracing_factory(folder, kind):
    """A factory that leaves a file per call, named by its process."""

    def make():
        with open(f"{folder}/{kind}-{os.getpid()}-{uuid.uuid4().hex}", "w"):
            pass
        if kind == "predictor":
            return lambda chats, **settings: [("{}", [], []) for _ in chats]
        if kind == "embedder":
            return lambda texts: np.ones((len(texts), 2))
        return lambda texts: [[1] for _ in texts]

    return make


def test_a_factory_runs_once_per_process_over_many_tasks(spark, tmp_path):
    df = spark.range(400).selectExpr("cast(id as string) AS id", "'s' AS system_prompt", "'u' AS user_prompt").repartition(60)
    key = uuid.uuid4().hex
    for kind in ("predictor", "embedder", "tokenizer"):
        make = tracing_factory(str(tmp_path), kind)
        for _ in range(2):  # a second job with the same key finds the models loaded
            if kind == "predictor":
                out = infer.run_predictor(df, make, per_worker=True, model_key=key)
            elif kind == "embedder":
                out = infer.embed(df, "user_prompt", make, per_worker=True, model_key=key)
            else:
                out = df.select(python_tokenizer(make, per_worker=True, model_key=key)(F.col("user_prompt")).alias("ids"))
            assert len(out.collect()) == 400
        calls = [n.split("-")[1] for n in os.listdir(tmp_path) if n.startswith(kind)]
        assert 0 < len(calls) == len(set(calls)) < 60


def test_accelerator_profile_reaches_the_stage(spark, monkeypatch):
    profile = infer.accelerator_profile(4, gpu=0.5)
    requests = profile.taskResources
    assert requests["cpus"].amount == 4 and requests["gpu"].amount == 0.5
    seen = []
    df = prompts(spark, 3)
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, fn, schema, barrier=False, profile=None: seen.append(profile))
    infer.run_predictor(df, counting("/nowhere"), profile=profile)
    assert seen == [profile]


def strict_double():
    """A double that answers only when the schema and the log-probs are asked for, and follows the schema."""

    def predict(chats, *, answer_schema, logprobs, temperature, max_new_tokens, seed):
        assert answer_schema["required"] == ["codable"] and logprobs == 1
        fields = answer_schema["properties"]
        text = '{"codable": false}' if "nace08_valid" in fields else '{"codable": true, "nace2025": "01.11A"}'
        return [(text, [], []) for _ in chats]

    return predict


def test_entry_job_with_real_names_schema_and_log(spark, tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()
    root, name = scratch_path(spark, "t-names"), "Org/Model-2.5-7B"
    inputs = (X.extraction(spark, SF_SMALL), jobs.mapping(spark, SF_SMALL), X.ground_truth(spark, SF_SMALL))
    m = EP.encode_ambiguous(*inputs, strict_double(), jobs.mapping_template(spark), name, "r1", root, order=["row_seq"],
                            metrics_path=f"{tmp_path}/metrics", answers_log=str(tmp_path / "log"))
    assert m.filter("metric = 'num_coded'").first()["value"] == 0
    back = read_runs(spark, root, {name: ["r1"]})
    n = jobs.workset(spark, SF_SMALL, annotated=True).count()
    assert back.count() == n and {r[0] for r in back.select("model").distinct().collect()} == {name}
    first = sorted(back.collect())
    # the same run again, with a model that must not be called
    EP.encode_ambiguous(*inputs, counting(str(folder), fail_at=0), jobs.mapping_template(spark), name, "r1", root,
                        order=["row_seq"], answers_log=str(tmp_path / "log"))
    assert sorted(read_runs(spark, root, {name: ["r1"]}).collect()) == first
    with pytest.raises(ValueError):
        read_runs(spark, root, {"a/b": ["r1"], "a--b": ["r1"]})
    with pytest.raises(ValueError):
        write_results(back, root, "a:b", "r1")


def test_prompt_dataset_by_retrieval(spark):
    docs, out = jobs.q_label_documents(spark, SF_SMALL), scratch_path(spark, "t-rag-prompts")
    rows, share = EP.write_prompts(
        X.extraction(spark, SF_SMALL), jobs.mapping(spark, SF_SMALL), X.ground_truth(spark, SF_SMALL),
        load_template(None, "retrieval-classifier"), out, order=["row_seq"], gt_order=["g_seq", "apet_manual", "NAF2008_code"],
        strategy="retrieval", retrieval={"documents": docs, "embedder": infer.letter_count_embedder,
                                         "retriever_template": load_template(None, "retriever"), "per_worker": True})
    got = {r["liasse_numero"]: r["user_prompt"] for r in spark.read.parquet(out).collect()}
    every = {r["liasse_numero"]: r["user_prompt"] for r in jobs.q_prompts_retrieval(spark, SF_SMALL).collect()}
    annotated = {r[0] for r in jobs.workset(spark, SF_SMALL, annotated=True).select("liasse_numero").collect()}
    assert set(got) == annotated and rows.count() == len(got) == share.first()[0]
    shared = set(got) & set(every)
    assert shared and all(got[i] == every[i] for i in shared)


def test_of_a_repeated_key_the_last_value_counts(spark):
    texts = [
        ('{"codable": false, "codable": true, "nace2025": "00.00Z", "nace2025": "01.11A"}', True, "01.11A"),
        ('{"codable": true, "nace2025": "01.11A", "nace2025": null}', True, None),
        ('{"codable": true, "nace2025": "01.11A", "nace2025": 5}', True, None),
    ]
    df = spark.createDataFrame([(t,) for t, _, _ in texts], "output_text string")
    got = {r["output_text"]: r for r in parse_answers(df).collect()}
    assert [(got[t]["__codable"], got[t]["__code"]) for t, _, _ in texts] == [(c, n) for _, c, n in texts]
    assert [got[t]["__keep"] for t, _, _ in texts] == [True, False, False]


def test_answer_schemas_name_the_fields_that_are_parsed():
    assert set(K.ANSWER_SCHEMAS["mapping"]["properties"]) == {"codable", "nace2025", "nace08_valid", "confidence"}
    assert set(K.ANSWER_SCHEMAS["retrieval"]["properties"]) == {"codable", "nace2025", "confidence"}
