"""The composite jobs (Q1–Q12) and one query per inventory item, over the fixtures.

Every function takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole input tables.  ``QUERIES`` is what ``__spark_entry__.queries()`` exposes.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recoda.functions import constants as K
from recoda.functions.ensemble import cascade, majority_vote, weighted_vote
from recoda.functions.response import (
    answer_status,
    parse_answers,
    post_process,
    text_tokens,
    with_sequence_confidence,
)
from recoda.functions.text import activity_description, lower_if_all_upper, nfkc
from recoda.operators import evaluate as E
from recoda.operators.assemble import anti_join_ids, assemble, enrich
from recoda.operators.dedup import first_per_key
from recoda.operators.infer import (
    embed,
    first_candidate_predictor,
    letter_count_embedder,
    run_predictor,
)
from recoda.operators.mapping import (
    nested_mapping,
    normalise_correspondence,
    normalise_notes,
    notes_by_code,
    unique_targets,
    with_mapping_ok,
)
from recoda.operators.models import common_ids, models_wide
from recoda.operators.prompts import label_documents, mapping_prompts, retrieval_prompts
from recoda.operators.recode import recode_unambiguous
from recoda.operators.resume import run_resumably
from recoda.operators.retrieve import dot_product_scorer, similar_topk
from recoda.operators.vector_index import build_index, search_index
from recoda.operators.workset import ambiguous_workset, split_shards
from recoda.session import scratch_path, ship_package, stored
from recoda.sources import fixtures as X
from recoda.sources.collection import build_collection
from recoda.sources.sinks import run_stamp, write_collection, write_metrics, write_results, write_unique
from recoda.sources.tables import attach_collection, read_runs, read_sheet, read_table, sql_over
from recoda.sources.templates import load_template

ID = K.ID
ENSEMBLES = ("cascade", "vote", "weighted")
STRATEGY_ORDER = tuple(X.MODELS) + ENSEMBLES
SCORE_DIGITS = 6
RUN_IDS = [run_stamp(datetime(2024, 11, 13, 0, 39)), run_stamp(datetime(2024, 11, 15, 1, 13))]  # X22
RESULTS_MODEL = "org/model-a.5"  # names of real models hold slashes


# ---------------------------------------------------------------- building blocks

def mapping(spark: SparkSession, sf: str) -> DataFrame:
    """The nested mapping, cached: a nomenclature-sized table every job reads several times."""
    return nested_mapping(X.correspondence(spark, sf), X.notes(spark, sf), strict=False).cache()


def workset(spark: SparkSession, sf: str, annotated: bool = False) -> DataFrame:
    gt = X.ground_truth(spark, sf) if annotated else None
    return ambiguous_workset(X.extraction(spark, sf), mapping(spark, sf), gt, order=["row_seq"])


def human_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Q12: one human label per id."""
    return first_per_key(X.ground_truth(spark, sf), [ID], ["g_seq", "apet_manual", "NAF2008_code"])


def declarations(spark: SparkSession, sf: str) -> DataFrame:
    ex = X.extraction(spark, sf).select(ID, "row_seq", *K.ATTRIBUTE_COLUMNS)
    return first_per_key(ex, [ID], ["row_seq", *K.ATTRIBUTE_COLUMNS]).select(ID, *K.ATTRIBUTE_COLUMNS)


def model_results(spark: SparkSession, sf: str, model: str = "a") -> DataFrame:
    return X.predictions(spark, sf).filter(F.col("model") == model).select(ID, "nace2025", "codable")


def wide(spark: SparkSession, sf: str) -> DataFrame:
    return models_wide(X.predictions(spark, sf), X.MODELS)


def model_cols() -> list[str]:
    return [f"nace2025_{m}" for m in X.MODELS]


def with_ensembles(w: DataFrame) -> DataFrame:
    cols = model_cols()
    return w.select(
        "*",
        cascade(cols).alias("nace2025_cascade"),
        majority_vote(cols).alias("nace2025_vote"),
        weighted_vote(cols, X.MODEL_WEIGHTS, mode="last").alias("nace2025_weighted"),
    )


def mapping_template(spark: SparkSession) -> dict[str, str]:
    return load_template(None, "mapping-classifier")


def prompts_for(spark: SparkSession, sf: str, annotated: bool) -> DataFrame:
    ws = workset(spark, sf, annotated)
    return mapping_prompts(ws, mapping(spark, sf), mapping_template(spark), check=False)  # its codes are the mapping's


def assembled(spark: SparkSession, sf: str, **options) -> dict[str, DataFrame]:
    ex = X.extraction(spark, sf)
    mp = mapping(spark, sf)
    ws_ids = workset(spark, sf).select(ID)
    labels = model_results(spark, sf).join(ws_ids, ID, "left_semi").select(ID, "nace2025")
    human = X.ground_truth(spark, sf).select(ID, F.col("apet_manual").alias("nace2025"), "g_seq")
    return assemble(ex, recode_unambiguous(ex, mp), labels, human, order=["row_seq"], human_order=["g_seq"], **options)


def evaluation_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Wide predictions + ensembles, joined to human labels with their mapping_ok flag."""
    gt = with_mapping_ok(human_labels(spark, sf), mapping(spark, sf), "NAF2008_code", "apet_manual")
    return with_ensembles(wide(spark, sf)).join(gt.select(ID, "apet_manual", "mapping_ok"), ID, "inner")


def parsed_responses(spark: SparkSession, sf: str) -> DataFrame:
    out = post_process(X.responses(spark, sf), keep=(ID,))
    return out.withColumn("confidence", F.round("confidence", SCORE_DIGITS))


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "embeddings")


# ---------------------------------------------------------------- one query per item

def q_mapping_nested_size(spark, sf):
    m = nested_mapping(X.correspondence(spark, sf), X.notes(spark, sf))
    return m.select(
        "code08", "label08", "n_targets",
        F.array_join(F.col("targets.code"), ",").alias("target_codes"),
        (F.col("n_targets") > 1).alias("is_ambiguous"),
    )


def q_mapping_unique_targets(spark, sf):
    return unique_targets(mapping(spark, sf))


def q_notes_by_kind(spark, sf):
    corr = X.correspondence(spark, sf)
    n = notes_by_code(X.notes(spark, sf))
    c = corr.select(
        F.replace("naf08_niv5", F.lit("."), F.lit("")).alias("code08"),
        F.replace("naf25_niv5", F.lit("."), F.lit("")).alias("code25"),
        "pos",
    )
    return c.join(n, "code25", "left").select("code08", "code25", "pos", "title", "include", "not_include", "notes")


def q_recode_unambiguous(spark, sf):
    return recode_unambiguous(X.extraction(spark, sf), mapping(spark, sf))


def q_workset_ambiguous(spark, sf):
    return workset(spark, sf)


def q_workset_annotated(spark, sf):
    return workset(spark, sf, annotated=True)


def q_workset_thirds(spark, sf):
    return split_shards(workset(spark, sf).select(ID)).select(ID, "position", "shard")


def q_enrich_left(spark, sf):
    h = human_labels(spark, sf).select(ID, F.col("apet_manual").alias("nace2025"))
    return enrich(h, declarations(spark, sf))


def q_anti_annotated(spark, sf):
    return anti_join_ids(model_results(spark, sf).select(ID, "nace2025"), human_labels(spark, sf).select(ID))


def q_propagate_labels(spark, sf):
    return assembled(spark, sf)["model_propagated"]


def q_assemble_final(spark, sf):
    return assembled(spark, sf)["final"]


def q_assemble_unique(spark, sf):
    """The final table by rule: human labels first, one model label per activity; repeated ids are an error."""
    final = assembled(spark, sf, prefer_human=True)["final"]
    path = scratch_path(spark, "final")
    write_unique(final, path, [ID], "the final table holds repeated ids")
    return spark.read.parquet(path)


def q_assemble_violations(spark, sf):
    return assembled(spark, sf)["violations"]


def q_models_wide(spark, sf):
    return wide(spark, sf)


def q_models_common_ids(spark, sf):
    return common_ids(X.predictions(spark, sf), X.MODELS)


def _ensemble(expr_fn):
    def q(spark, sf):
        return wide(spark, sf).select(ID, expr_fn(model_cols()).alias("label"))
    return q


q_ensemble_cascade = _ensemble(lambda c: cascade(c))
q_ensemble_vote = _ensemble(lambda c: majority_vote(c))
q_ensemble_weighted_last = _ensemble(lambda c: weighted_vote(c, X.MODEL_WEIGHTS, mode="last"))
q_ensemble_weighted_sum = _ensemble(lambda c: weighted_vote(c, X.MODEL_WEIGHTS, mode="sum"))


def q_ensemble_named_models(spark, sf):
    """The vote over models with real names (dots, slashes, dashes), each with a second, empty answer per id."""
    preds = X.predictions(spark, sf)
    named = F.create_map(*[F.lit(x) for pair in X.MODEL_NAMES.items() for x in pair])
    preds = preds.withColumn("model", named[F.col("model")])
    empty = preds.withColumn("nace2025", F.lit(None).cast("string")).withColumn("codable", F.lit(True))
    w = models_wide(preds.unionByName(empty), list(X.MODEL_NAMES.values()))
    return w.select(ID, majority_vote([f"nace2025_{m}" for m in X.MODEL_NAMES.values()]).alias("label"))


def q_agreement_rows(spark, sf):
    return E.agreement_rows(wide(spark, sf), model_cols())


def q_agreement_stats(spark, sf):
    s = E.agreement_stats(wide(spark, sf), model_cols())
    return s.select(*[c for c in s.columns if not c.startswith("agreement_")])


def q_agreement_pairs(spark, sf):
    s = E.agreement_stats(wide(spark, sf), model_cols())
    return s.select(*[c for c in s.columns if c.startswith("agreement_")])


def q_mapping_ok(spark, sf):
    gt = human_labels(spark, sf).select(ID, "apet_manual", "NAF2008_code")
    return with_mapping_ok(gt, mapping(spark, sf), "NAF2008_code", "apet_manual")


def q_accuracy_levels(spark, sf):
    # the prompts hold exactly the work set's ids, so joining them restricts the results to it
    prompts = prompts_for(spark, sf, True)
    return E.evaluate_results(model_results(spark, sf), X.ground_truth(spark, sf), prompts,
                              gt_order=["g_seq", "apet_manual", "NAF2008_code"])


def q_accuracy_matrix(spark, sf):
    return E.accuracy_matrix(evaluation_frame(spark, sf), X.MODELS, ENSEMBLES)


def q_best_strategy(spark, sf):
    w = stored(with_ensembles(wide(spark, sf)), "wide")  # the matrix and the labels both read it
    gt = with_mapping_ok(human_labels(spark, sf), mapping(spark, sf), "NAF2008_code", "apet_manual")
    ev = w.join(gt.select(ID, "apet_manual", "mapping_ok"), ID, "inner")
    best = E.best_strategy(E.accuracy_matrix(ev, X.MODELS, ENSEMBLES), STRATEGY_ORDER).first()
    # Keep only the winning strategy's column (one scalar reached the driver)
    return w.select(ID, F.col(f"nace2025_{best['strategy']}").alias("nace2025"), F.lit(best["strategy"]).alias("strategy"))


def q_coded_stats(spark, sf):
    return E.coded_stats(model_results(spark, sf))


def q_coverage_pct(spark, sf):
    cov = E.prompt_coverage(prompts_for(spark, sf, True), human_labels(spark, sf))
    return E.coverage_pct(cov)


def q_activity_text(spark, sf):
    ex = X.extraction(spark, sf)
    return ex.select(ID, "row_seq", activity_description().alias("activity"))


def q_text_case_docs(spark, sf):
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", lower_if_all_upper("text").alias("text_cased"))


def q_text_nfkc_docs(spark, sf):
    ship_package(spark)
    d = read_table(spark, sf, "documents")
    return d.select("doc_id", nfkc(F.col("text")).alias("text_nfkc"))


def q_label_documents(spark, sf):
    return label_documents(mapping(spark, sf))


def q_prompts_mapping(spark, sf):
    return prompts_for(spark, sf, False).select(ID, "proposed_codes", "system_prompt", "user_prompt")


def q_prompts_retrieval(spark, sf):
    tpl = None  # the built-in template table
    docs = label_documents(mapping(spark, sf))
    return retrieval_prompts(
        workset(spark, sf), docs, load_template(tpl, "retrieval-classifier"), load_template(tpl, "retriever"),
        letter_count_embedder(),
    ).select(ID, "proposed_codes", "user_prompt")


def q_prompt_dataset_codes(spark, sf):
    return E.prompt_coverage(prompts_for(spark, sf, True), human_labels(spark, sf))


def q_chat_messages_user_text(spark, sf):
    conv = read_table(spark, sf, "conversations")
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    second = conv.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") == 2)
    counts = conv.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_messages"))
    return counts.join(second.select("conv_id", F.col("role").alias("user_role"), F.col("text").alias("user_text")),
                       "conv_id", "left")


def q_similar_topk(spark, sf):
    e = embeddings(spark, sf)
    q = e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    d = e.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("doc_vec"))
    top = similar_topk(q, d, k=K.TOP_K)  # exact; the document side is a nomenclature in real use
    return top.select("query_id", "doc_id", F.round("cosine", SCORE_DIGITS).alias("score"), "rank")


def q_similar_rerank(spark, sf):
    e = embeddings(spark, sf)
    q = e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    d = e.select(F.col("vec_id").alias("doc_id"), F.col("embedding").alias("doc_vec"))
    top = similar_topk(q, d, k=K.TOP_K, fetch_k=K.RERANK_FETCH_K, scorer=dot_product_scorer)
    return top.select("query_id", "doc_id", F.round("pair_score", SCORE_DIGITS).alias("score"), "rank")


def _embedding_index(spark, sf):
    """The queries (every vector whose id is divisible by 20) and the stored index of all vectors."""
    e = embeddings(spark, sf)
    q = e.filter(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    return q, build_index(e, scratch_path(spark, "index"), "vec_id", "embedding")


def q_index_search(spark, sf):
    """J11 by the clustered index: the lists a query needs for the recall measured when the index was built."""
    q, index = _embedding_index(spark, sf)
    top = search_index(q, index, k=K.TOP_K)
    return top.select("query_id", "doc_id", F.round("cosine", SCORE_DIGITS).alias("score"), "rank")


def q_index_search_exact(spark, sf):
    """J11 by the clustered index in its exact mode."""
    q, index = _embedding_index(spark, sf)
    top = search_index(q, index, k=K.TOP_K, exact=True)
    return top.select("query_id", "doc_id", F.round("cosine", SCORE_DIGITS).alias("score"), "rank")


def q_responses_parsed(spark, sf):
    return parsed_responses(spark, sf)


def q_responses_status(spark, sf):
    return answer_status(X.responses(spark, sf))


def q_confidence_scores(spark, sf):
    r = parse_answers(X.responses(spark, sf))
    code = F.coalesce(F.col("__code"), F.lit(""))
    r = with_sequence_confidence(r.withColumn("__t", text_tokens(code)), "token_ids", "logprobs", "__t")
    return r.select(ID, F.round("confidence", SCORE_DIGITS).alias("confidence"))


def q_infer_batch(spark, sf):
    prompts = prompts_for(spark, sf, False)
    answers = run_predictor(prompts, first_candidate_predictor, carry=[ID])
    out = post_process(answers, keep=(ID,))
    return out.withColumn("confidence", F.round("confidence", SCORE_DIGITS))


def q_infer_resumed(spark, sf):
    """A run that answered the annotated declarations only is started again for all of them, with the same log."""
    log = scratch_path(spark, "answers")
    prompts = stored(prompts_for(spark, sf, False).drop("prompt"), "prompts")
    human = X.ground_truth(spark, sf).select(ID).distinct()
    run_resumably(prompts.join(human, ID, "left_semi"), first_candidate_predictor, log, ID, carry=[ID])
    answers = run_resumably(prompts, first_candidate_predictor, log, ID, carry=[ID])
    return answers.select(ID, "output_text", F.size("token_ids").alias("n_tokens"))


def _write_two_runs(spark, sf) -> str:
    root = scratch_path(spark, "results")
    parsed = parsed_responses(spark, sf).cache()  # written as two runs: parse once
    for run_id in RUN_IDS:
        write_results(parsed, root, RESULTS_MODEL, run_id)
    parsed.unpersist()
    return root


def q_results_roundtrip(spark, sf):
    root = _write_two_runs(spark, sf)
    return read_runs(spark, root, {RESULTS_MODEL: RUN_IDS[:1]}).select(ID, "codable", "nace2025", "nace08_valid", "confidence", "model", "run_id")


def q_runs_by_path(spark, sf):
    root = _write_two_runs(spark, sf)
    return read_runs(spark, root, {RESULTS_MODEL: RUN_IDS}).select(ID, "codable", "nace2025", "model", "run_id")


def q_embeddings_roundtrip(spark, sf):
    docs = label_documents(mapping(spark, sf))
    vecs = embed(docs.select("code", "content"), "content", letter_count_embedder(), "vector")
    path = scratch_path(spark, "collection")
    write_collection(vecs.select("code", "vector"), path, "letter-count-26")
    coll, model = attach_collection(spark, path)
    # letter counts can be recomputed in SQL, so the values are compared too
    first = F.transform("vector", lambda x: F.round(x.cast("double"), SCORE_DIGITS))
    return coll.select("code", "model", F.size("vector").alias("dims"), F.lit(model).alias("collection_model"),
                       F.array_join(F.transform(first, lambda x: F.round(x * 1_000_000).cast("long").cast("string")), ",").alias("values"))


def q_collection_updated(spark, sf):
    """A collection of some label documents, built again over all of them: who was embedded when."""
    docs = label_documents(mapping(spark, sf)).select("code", "content")
    old = docs.withColumn("content", F.when(F.length("content") % 2 == 0, F.col("content")).otherwise(F.lit("an older text")))
    root = scratch_path(spark, "collection")
    build_collection(old, letter_count_embedder(), "letter-count-26", root)
    build_collection(docs, letter_count_embedder(), "letter-count-26", root)
    coll, model = attach_collection(spark, root)
    return coll.select("code", "embedded", F.lit(model).alias("model"),
                       F.array_join(F.transform("vector", lambda x: F.round(F.round(x.cast("double"), SCORE_DIGITS) * 1_000_000)
                                                .cast("long").cast("string")), ",").alias("values"))


def q_metrics_long(spark, sf):
    acc = q_accuracy_levels(spark, sf)
    coded = E.to_long(E.coded_stats(model_results(spark, sf)))
    return acc.unionByName(coded)


def q_sheets_by_position(spark, sf):
    """Both sheets written as CSV, read back as text with row numbers, normalised, nested."""
    root = scratch_path(spark, "sheets")
    corr = X.correspondence(spark, sf).orderBy("pos").drop("pos")  # files in the order of the rows
    names = [f"col {i}" for i in range(max(K.CORRESPONDENCE_POSITIONS.values()) + 1)]
    at = {i: name for name, i in K.CORRESPONDENCE_POSITIONS.items()}
    corr = corr.select(*[(F.col(at[i]) if i in at else F.lit("-")).alias(n) for i, n in enumerate(names)])
    notes = X.notes(spark, sf).orderBy("pos")
    notes = notes.select(*[F.col(short).alias(long) for long, short in K.NOTES_SHEET_COLUMNS.items()])
    for name, sheet in (("corr", corr), ("notes", notes)):
        sheet.write.option("header", "true").option("escape", '"').csv(f"{root}/{name}")
    read_corr = normalise_correspondence(read_sheet(spark, f"{root}/corr", names, row_col="row"), "row")
    read_notes = normalise_notes(read_sheet(spark, f"{root}/notes", list(K.NOTES_SHEET_COLUMNS), row_col="row"), "row")
    m = nested_mapping(read_corr, read_notes)
    return m.select(
        "code08", "label08", "n_targets",
        F.array_join(F.col("targets.code"), ",").alias("target_codes"),
        (F.col("n_targets") > 1).alias("is_ambiguous"),
    )


def q_sql_over_frames(spark, sf):
    """SQL over two frames."""
    frames = {"ex": X.extraction(spark, sf), "gt": X.ground_truth(spark, sf)}
    return sql_over(spark, "SELECT ex.apet_finale AS code08, count(*) AS n_rows FROM {ex} ex "
                           "WHERE ex.liasse_numero IN (SELECT liasse_numero FROM {gt}) GROUP BY ex.apet_finale", frames)


def q_metrics_written(spark, sf):
    """K4: the metrics of a run, written twice under their shard and read back once."""
    root = scratch_path(spark, "metrics")
    coded = E.to_long(E.coded_stats(model_results(spark, sf)))
    for _ in range(2):
        path = write_metrics(coded, root, "r1", "org/model-1.5", 2)
    return spark.read.option("basePath", root).parquet(path).select("metric", "value", "run_id", "model", F.col("shard").cast("int").alias("shard"))


def q_encode_ambiguous_metrics(spark, sf):
    """Entry A end to end with the test-double predictor: metrics of the run."""
    from recoda.plans.entrypoints import encode_ambiguous

    return encode_ambiguous(
        X.extraction(spark, sf), mapping(spark, sf), X.ground_truth(spark, sf), first_candidate_predictor,
        mapping_template(spark), model="first-candidate", run_id="r1", results_root=scratch_path(spark, "runs"),
        order=["row_seq"], gt_order=["g_seq", "apet_manual", "NAF2008_code"],
    )


def q_recode_streaming(spark, sf):
    from recoda.streaming.recode_stream import recode_files_once

    return recode_files_once(spark, X.extraction(spark, sf), mapping(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_") and callable(fn)
}
