"""The end-to-end jobs on the smallest tables."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from recoda.operators.infer import first_candidate_predictor, hashed_char_embedder
from recoda.operators.workset import write_shards
from recoda.plans import entrypoints as EP
from recoda.plans import jobs
from recoda.session import scratch_path
from recoda.sources import fixtures as X
from recoda.sources.tables import attach_collection, read_runs
from recoda.sources.templates import load_template, prompt_templates


def test_encode_unambiguous_writes_all_rows(spark):
    out = scratch_path(spark, "t-univ")
    EP.encode_unambiguous(X.extraction(spark, SF_SMALL), jobs.mapping(spark, SF_SMALL), out)
    assert spark.read.parquet(out).count() == jobs.q_recode_unambiguous(spark, SF_SMALL).count()


def test_encode_ambiguous_by_shards_covers_the_work_set(spark):
    root = scratch_path(spark, "t-runs")
    metrics_path = scratch_path(spark, "t-metrics")
    tpl = jobs.mapping_template(spark)
    ex, mp, gt = X.extraction(spark, SF_SMALL), jobs.mapping(spark, SF_SMALL), X.ground_truth(spark, SF_SMALL)
    layout = write_shards(jobs.workset(spark, SF_SMALL, annotated=True), scratch_path(spark, "t-shards"))
    for third in (1, 2, 3, 3):  # three shard jobs of the same run share one directory tree; one is run again
        m = EP.encode_ambiguous(ex, mp, gt, first_candidate_predictor, tpl, "m1", "run-a", root,
                                metrics_path=metrics_path, shard=third, order=["row_seq"],
                                shards_path=layout if third > 1 else None)
        assert {r["metric"] for r in m.collect()} >= {"accuracy_overall_lvl_5", "eval_size", "num_coded"}
    runs = read_runs(spark, root, {"m1": ["run-a"]})
    ws = jobs.workset(spark, SF_SMALL, annotated=True)
    assert runs.count() == ws.count()
    assert runs.select("liasse_numero").distinct().count() == ws.count()
    assert sorted(r[0] for r in runs.select("shard").distinct().collect()) == ["1", "2", "3"]
    assert spark.read.parquet(metrics_path).filter("run_id = 'run-a'").select("metric").count() == 3 * 20
    params = spark.read.parquet(metrics_path + "_params").filter("run_id = 'run-a'").collect()
    assert {(r["model"], r["shard"]) for r in params} == {("m1", 1), ("m1", 2), ("m1", 3)}
    by_name = {}
    for r in params:
        by_name.setdefault(r["param"], set()).add(r["value"])
    assert {float(v) for v in by_name["temperature"]} == {0.01}


def test_choose_labels_and_build_final(spark):
    labels, matrix, best, agreement = EP.choose_labels(X.predictions(spark, SF_SMALL), X.ground_truth(spark, SF_SMALL),
                                            jobs.mapping(spark, SF_SMALL), X.MODELS, X.MODEL_WEIGHTS)
    assert best in ("a", "b", "c", "cascade", "vote", "weighted")
    assert matrix.count() == 75
    evaluated = jobs.evaluation_frame(spark, SF_SMALL).count()
    assert agreement.first()["total_samples"] == evaluated < X.predictions(spark, SF_SMALL).count() // 3
    expected = jobs.q_best_strategy(spark, SF_SMALL)
    assert sorted(labels.collect()) == sorted(expected.select("liasse_numero", "nace2025").collect())
    ex, mp = X.extraction(spark, SF_SMALL), jobs.mapping(spark, SF_SMALL)
    ws_ids = jobs.workset(spark, SF_SMALL).select("liasse_numero")
    model_labels = labels.join(ws_ids, "liasse_numero", "left_semi")
    human = X.ground_truth(spark, SF_SMALL).select("liasse_numero", F.col("apet_manual").alias("nace2025"), "g_seq")
    from recoda.operators.recode import recode_unambiguous

    parts = EP.build_final(ex, recode_unambiguous(ex, mp), model_labels, human, order=["row_seq"],
                           human_order=["g_seq"], fail_on_duplicates=False)
    assert parts["final"].count() > 0
    strict = EP.build_final(ex, recode_unambiguous(ex, mp), model_labels, human, order=["row_seq"],
                            human_order=["g_seq"], prefer_human=True)
    # human labels come first and an activity has one model label: no id is left twice
    assert strict["violations"].count() == 0 < parts["violations"].count()
    assert strict["conflicts"].filter("n < 2").count() == 0
    human_ids = {r[0] for r in strict["human_propagated"].select("liasse_numero").collect()}
    model_ids = {r[0] for r in strict["model_propagated"].select("liasse_numero").collect()}
    assert not (human_ids & model_ids)
    # every model label row either reached a declaration or is reported as unmatched
    n_model = parts["model"].count()
    reached = parts["model"].join(parts["model_unmatched"].select("liasse_numero"), "liasse_numero", "left_anti").count()
    assert reached + parts["model_unmatched"].count() == n_model


def test_build_label_collection(spark):
    out = scratch_path(spark, "t-coll")
    EP.build_label_collection(jobs.mapping(spark, SF_SMALL), hashed_char_embedder(16), "trigram-16", out)
    coll, model = attach_collection(spark, out)
    assert model == "trigram-16" and coll.count() == jobs.q_label_documents(spark, SF_SMALL).count()


def test_prompt_dataset_job(spark):
    out = scratch_path(spark, "t-prompts")
    rows, share = EP.write_prompts(
        X.extraction(spark, SF_SMALL), jobs.mapping(spark, SF_SMALL), X.ground_truth(spark, SF_SMALL),
        jobs.mapping_template(spark), out, order=["row_seq"], gt_order=["g_seq", "apet_manual", "NAF2008_code"])
    assert sorted(rows.collect()) == sorted(jobs.q_prompt_dataset_codes(spark, SF_SMALL).collect())
    assert share.collect() == jobs.q_coverage_pct(spark, SF_SMALL).collect()


def test_retrieval_from_a_stored_collection(spark):
    import pytest

    tpl = prompt_templates(spark)
    mp = jobs.mapping(spark, SF_SMALL)
    path = scratch_path(spark, "t-stored")
    EP.build_label_collection(mp, hashed_char_embedder(32), "trigram-32", path)

    def run(name, **extra):
        root = scratch_path(spark, name)
        EP.encode_ambiguous(
            X.extraction(spark, SF_SMALL), mp, X.ground_truth(spark, SF_SMALL), first_candidate_predictor,
            load_template(tpl, "retrieval-classifier"), "m2", "r1", root, strategy="retrieval", order=["row_seq"],
            retrieval={"documents": jobs.q_label_documents(spark, SF_SMALL), "embedder": hashed_char_embedder(32),
                       "retriever_template": load_template(tpl, "retriever"), **extra})
        return sorted(read_runs(spark, root, {"m2": ["r1"]}).select("liasse_numero", "nace2025").collect())

    assert run("t-c1", collection=path, model="trigram-32") == run("t-c2")
    with pytest.raises(ValueError):
        run("t-c3", collection=path, model="another")


def test_retrieval_strategy_runs(spark):
    tpl = prompt_templates(spark)
    docs = jobs.q_label_documents(spark, SF_SMALL)
    m = EP.encode_ambiguous(
        X.extraction(spark, SF_SMALL), jobs.mapping(spark, SF_SMALL), X.ground_truth(spark, SF_SMALL),
        first_candidate_predictor, load_template(tpl, "retrieval-classifier"), "m2", "r1",
        scratch_path(spark, "t-rag"), strategy="retrieval", order=["row_seq"],
        retrieval={"documents": docs, "retriever_template": load_template(tpl, "retriever"),
                   "embedder": hashed_char_embedder(32)},
    )
    assert m.filter(F.col("metric") == "eval_size").first()["value"] > 0


def test_jobs_do_not_depend_on_input_order_or_partitioning(spark):
    from pyspark.sql import functions as F2

    from recoda.operators.workset import ambiguous_workset
    from recoda.operators.assemble import assemble
    from recoda.operators.recode import recode_unambiguous

    ex = X.extraction(spark, SF_SMALL)
    shuffled = ex.repartition(7).orderBy(F2.rand(11))
    mp = jobs.mapping(spark, SF_SMALL)
    a = ambiguous_workset(ex, mp, order=["row_seq"]).collect()
    b = ambiguous_workset(shuffled, mp, order=["row_seq"]).collect()
    assert sorted(a) == sorted(b)
    labels = X.predictions(spark, SF_SMALL).filter("model = 'a'").select("liasse_numero", "nace2025")
    human = X.ground_truth(spark, SF_SMALL).select("liasse_numero", F2.col("apet_manual").alias("nace2025"), "g_seq")
    f1 = assemble(ex, recode_unambiguous(ex, mp), labels, human, order=["row_seq"], human_order=["g_seq"])["final"]
    f2 = assemble(shuffled, recode_unambiguous(shuffled, mp), labels.repartition(5), human.repartition(3),
                  order=["row_seq"], human_order=["g_seq"])["final"]
    assert sorted(f1.collect()) == sorted(f2.collect())
    # every declaration with a single-target code is in the final table
    univ_ids = {r[0] for r in recode_unambiguous(ex, mp).select("liasse_numero").distinct().collect()}
    final_ids = {r[0] for r in f1.select("liasse_numero").distinct().collect()}
    assert univ_ids <= final_ids
