"""The end-to-end jobs a user runs, as Spark jobs over DataFrames.

* ``encode_unambiguous`` – recode single-target declarations and write them (Q1).
* ``encode_ambiguous``   – work set -> prompts -> predictor -> parsed answers ->
  results written per model/run -> evaluation metrics appended (Q2, Q5-Q8).
* ``choose_labels``      – several models' runs -> ensembles -> accuracy matrix ->
  best strategy's labels written (Q9).
* ``build_final``        – unambiguous + model + human labels propagated to every
  declaration, uniqueness checked, written (Q10).
* ``build_label_collection`` – label documents embedded and written (Q4 + K3).

Inputs are DataFrames (read with ``recoda.sources``); outputs go to paths the
caller chooses (the shared storage of the cluster).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoda.functions import constants as K
from recoda.functions.ensemble import cascade, majority_vote, weighted_vote
from recoda.functions.names import column
from recoda.functions.response import post_process, python_tokenizer, text_tokens
from recoda.operators import evaluate as E
from recoda.operators.assemble import assemble
from recoda.operators.dedup import duplicate_keys
from recoda.operators.infer import Embedder, Predictor, run_predictor
from recoda.operators.mapping import with_mapping_ok
from recoda.operators.models import models_wide
from recoda.operators.prompts import STRATEGIES, label_documents
from recoda.operators.recode import recode_unambiguous
from recoda.operators.resume import run_resumably
from recoda.operators.workset import ambiguous_workset, read_shard, split_shards
from recoda.session import scratch_path
from recoda.sources.collection import build_collection
from recoda.sources.sinks import path_name, run_path, write_metrics, write_params, write_results, write_table, write_unique
from recoda.sources.tables import attach_collection

ID = K.ID


def encode_unambiguous(extraction: DataFrame, mapping: DataFrame, output: str) -> str:
    """Entry B: every declaration with a single-target old code, recoded, written."""
    return write_table(recode_unambiguous(extraction, mapping), output)


def encode_ambiguous(
    extraction: DataFrame,
    mapping: DataFrame,
    ground_truth: DataFrame,
    predictor: Predictor,
    template: Mapping[str, str],
    model: str,
    run_id: str,
    results_root: str,
    metrics_path: str | None = None,
    strategy: str = "mapping",
    shard: int | None = None,
    only_annotated: bool = True,
    order: Sequence[str] = (),
    gt_order: Sequence[str] = (),
    retrieval: Mapping | None = None,
    prompts_path: str | None = None,
    shards_path: str | None = None,
    per_worker: bool = False,
    settings: Mapping | None = None,
    tokenizer: Callable | None = None,
    answers_log: str | None = None,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Entry A: encode the ambiguous work set with one model and evaluate it.

    ``shard`` (1..3) keeps one third of the ordered work set, as the original
    one-job-per-third fan-out (with ``shards_path``, written once by
    ``workset.write_shards``, a job reads its third only); ``None`` keeps all.  ``strategy`` is ``mapping``
    (candidates from the correspondence) or ``retrieval`` (``retrieval`` then
    holds ``documents, retriever_template, embedder`` and optional ``scorer``,
    ``k``, ``fetch_k`` and ``collection``, the path of a stored collection whose
    vectors are used instead of embedding the documents again, with ``model``,
    the name its vectors must come from).
    ``predictor`` gets whole chats and the generation ``settings`` (default: the
    fixed temperature, length, seed, one log-prob per token and the JSON schema of
    the strategy's answers, ``answer_schema``, which its output must follow).  With
    ``per_worker``, ``predictor`` and ``tokenizer`` are factories that a worker
    process calls once, and so is the embedder with ``per_worker`` in ``retrieval``;
    ``profile`` states the resources of the model's tasks.  ``tokenizer`` maps codes
    to the model's token ids, which the confidence needs (default: the test tokenizer).
    ``answers_log``: a folder in which every batch of answers is kept as soon as it
    is there; a run started again with the same model, run id and shard asks the
    model for missing answers only.
    The prompt dataset goes to ``prompts_path`` (default: the shared checkpoint
    folder).  Returns the long metrics table (accuracy, sizes, coded counts).
    """
    spark = extraction.sparkSession
    if shard is not None and shards_path:
        data = read_shard(spark, shards_path, shard)
    else:
        data = ambiguous_workset(extraction, mapping, ground_truth if only_annotated else None, order=order)
        if shard is not None:
            data = split_shards(data).filter(F.col("shard") == shard).drop("position", "shard")
    prompts = _prompts(data, mapping, template, strategy, retrieval)
    # Q11: the prompt dataset is written once; inference, results and evaluation
    # all read it, and the lineage before the (expensive) model call is cut.
    ds_path = prompts_path or scratch_path(spark, f"prompts-{path_name(model)}-{run_id}-{shard or 'all'}")
    write_table(prompts.drop("prompt"), ds_path)  # the chat is rebuilt from its two texts
    dataset = spark.read.parquet(ds_path)
    fixed = {"temperature": K.TEMPERATURE, "max_new_tokens": K.MAX_NEW_TOKENS, "seed": K.SEED, "logprobs": K.LOGPROBS,
             "answer_schema": K.ANSWER_SCHEMAS[strategy]}
    settings = {**fixed, **(settings or {})}
    # the row's columns travel with its prompt: no join back
    if answers_log:
        log = run_path(answers_log, shard, model=model, run_id=run_id)
        answers = run_resumably(dataset, predictor, log, ID, data.columns, settings, per_worker, profile=profile)
    else:
        answers = run_predictor(dataset, predictor, data.columns, settings, per_worker, profile=profile)
    results = post_process(answers, keep=tuple(data.columns), with_nace08=strategy == "mapping",
                           tokenize=python_tokenizer(tokenizer, per_worker) if tokenizer else text_tokens)
    # labels and coverage join the results on their way into the file; the metrics come with that one write
    labelled = E.with_labels(results, ground_truth, dataset, gt_order)
    path, seen = write_results(labelled, results_root, model, run_id, shard, E.result_metrics(), E.LABEL_COLUMNS)
    rows = [(name, None if seen[name] is None else float(seen[name])) for name in E.result_metrics()]
    metrics = spark.createDataFrame(rows, "metric string, value double")
    if not metrics_path:
        return metrics
    written = write_metrics(metrics, metrics_path, run_id, model, shard)
    stated = {**settings, "answer_schema": json.dumps(settings["answer_schema"], sort_keys=True)}
    write_params(spark, {"strategy": strategy, **stated, "output_path": path, "prompts_path": ds_path},
                 metrics_path + "_params", run_id, model, shard)
    return spark.read.schema("metric string, value double").parquet(written)  # computed once


def _prompts(
    data: DataFrame, mapping: DataFrame, template: Mapping[str, str], strategy: str, retrieval: Mapping | None
) -> DataFrame:
    """The prompts of a work set by the named strategy, its columns carried along."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; one of {sorted(STRATEGIES)}")
    source, options = mapping, {"check": False}  # the work set's codes are the mapping's
    if strategy == "retrieval":
        options = {"k": K.TOP_K, "fetch_k": K.RERANK_FETCH_K, **(retrieval or {})}
        source, path, queries_by = options.pop("documents"), options.pop("collection", None), options.pop("model", None)
        if path:
            vectors, made_by = attach_collection(data.sparkSession, path)
            if queries_by and queries_by != made_by:
                raise ValueError(f"the collection's vectors come from {made_by!r}, the queries from {queries_by!r}")
            options["doc_vectors"] = vectors.select("code", "vector")
    return STRATEGIES[strategy](data, source, template, carry=data.columns, **options)


def write_prompts(
    extraction: DataFrame,
    mapping: DataFrame,
    ground_truth: DataFrame,
    template: Mapping[str, str],
    output: str,
    order: Sequence[str] = (),
    gt_order: Sequence[str] = (),
    strategy: str = "mapping",
    retrieval: Mapping | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Q11: write the prompt dataset of the annotated work set; its rows' coverage and the covered share.

    ``strategy`` and ``retrieval`` as in ``encode_ambiguous``: prompts from the
    correspondence, or from the closest label documents, re-ranked when a scorer is
    given.  Returns ``(coverage per row, one-row percentage)``, both read from the
    written dataset.
    """
    data = ambiguous_workset(extraction, mapping, ground_truth, order=order)
    write_table(_prompts(data, mapping, template, strategy, retrieval).drop("prompt"), output)
    dataset = extraction.sparkSession.read.parquet(output)
    coverage = E.prompt_coverage(dataset, E.ground_truth_first(ground_truth, gt_order))
    return coverage, E.coverage_pct(coverage)


class Choice(NamedTuple):
    labels: DataFrame
    matrix: DataFrame
    best: str
    agreement: DataFrame


def choose_labels(
    predictions: DataFrame,
    ground_truth: DataFrame,
    mapping: DataFrame,
    models: Sequence[str],
    weights: Sequence[float],
    output: str | None = None,
    gt_order: Sequence[str] = (),
) -> Choice:
    """Entry C: ensembles of several models, accuracy matrix, agreement, the best strategy's labels.

    ``predictions`` is the long ``(model, id, nace2025, codable)`` table (read
    with ``read_runs``).  The agreement statistics are those of the evaluated (labelled) rows.
    """
    cols = [f"nace2025_{m}" for m in models]
    wide = models_wide(predictions, models).select(
        "*",
        cascade(cols).alias("nace2025_cascade"),
        majority_vote(cols).alias("nace2025_vote"),
        weighted_vote(cols, weights, mode="last").alias("nace2025_weighted"),
    )
    # the matrix, the agreement and the labels all read it
    spark = predictions.sparkSession
    wide = spark.read.parquet(write_table(wide, scratch_path(spark, "wide")))
    gt = with_mapping_ok(E.ground_truth_first(ground_truth, gt_order), mapping, "NAF2008_code", "apet_manual")
    ev = wide.join(gt.select(ID, "apet_manual", "mapping_ok"), ID, "inner")
    ensembles = ("cascade", "vote", "weighted")
    matrix = E.accuracy_matrix(ev, models, ensembles)
    best = E.best_strategy(matrix, list(models) + list(ensembles)).first()["strategy"]
    labels = wide.select(ID, column(f"nace2025_{best}").alias("nace2025"))
    if output:
        write_table(labels, output)
    return Choice(labels, matrix, best, E.agreement_stats(ev, cols))


def build_final(
    extraction: DataFrame,
    univocal: DataFrame,
    model_labels: DataFrame,
    human_labels: DataFrame,
    output: str | None = None,
    order: Sequence[str] = (),
    human_order: Sequence[str] = (),
    fail_on_duplicates: bool = True,
    prefer_human: bool = False,
    salts: int | None = None,
    hot_rows: int = 1_000_000,
) -> dict[str, DataFrame]:
    """Entry D: the final table; duplicate ids fail the job before the output is replaced.

    The table is written once, to ``output`` (default: the shared scratch folder);
    its rows and repeated ids are counted during that write (``counts``), and it
    takes the old table's place only when the check has passed.  ``prefer_human``
    makes ids unique by rule (see ``assemble``) instead of failing.
    """
    parts = assemble(extraction, univocal, model_labels, human_labels, order=order, human_order=human_order,
                     prefer_human=prefer_human, salts=salts, hot_rows=hot_rows)
    spark, path = extraction.sparkSession, output or scratch_path(extraction.sparkSession, "final")
    message = "the final table would hold duplicate ids" if fail_on_duplicates else None
    counts = write_unique(parts["final"], path, [ID], message)
    parts["final"] = spark.read.parquet(path)
    parts["violations"] = duplicate_keys(parts["final"], [ID])
    parts["counts"] = spark.createDataFrame([(counts["rows"], counts["repeated"])], "rows long, repeated long")
    return parts


def build_label_collection(
    mapping: DataFrame, embedder: Embedder | Callable[[], Embedder], model: str, output: str, per_worker: bool = False
) -> str:
    """Entry E: one document per new code, embedded, published below ``output`` with its model name.

    A build over an earlier one embeds new and changed documents only.  ``per_worker``:
    the embedder comes from a factory.  Returns the published version's folder.
    """
    return build_collection(label_documents(mapping), embedder, model, output, per_worker).path
