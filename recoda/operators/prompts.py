"""Candidate lists and prompts (Q5 mapping-based, Q6 retrieval-based) and the strategies.

A prompt is ``array<struct<role, content>>`` (system then user) plus the row
key.  Candidate blocks depend only on the old code, so they are built once per
code on the (small) mapping and joined to the work set, not rebuilt per row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoda.functions import constants as K
from recoda.functions.codes import dot, quoted_list, undot
from recoda.functions.text import activity_description, candidate_block, label_document, render, retrieved_block
from recoda.operators.dedup import require_empty
from recoda.operators.infer import Embedder, embed
from recoda.operators.mapping import unique_targets
from recoda.operators.retrieve import PairScorer, similar_topk
from recoda.operators.vector_index import VectorIndex, search_index
from recoda.session import sized_broadcast, stored


def candidates_by_code(mapping: DataFrame) -> DataFrame:
    """Per old code: the rendered candidate block (X11) and the quoted code list."""
    dotted = F.transform(
        "targets",
        lambda t: F.struct(
            dot(t["code"]).alias("code"), t["label"].alias("label"), t["include"].alias("include"),
            t["not_include"].alias("not_include"), t["notes"].alias("notes"),
        ),
    )
    return mapping.select(
        F.col("code08"),
        F.col("label08"),
        candidate_block(dotted).alias("proposed_codes"),
        quoted_list(F.transform("targets", lambda t: dot(t["code"]))).alias("list_proposed_codes"),
    )


def chat(system: F.Column, user: F.Column) -> F.Column:
    return F.array(
        F.struct(F.lit("system").alias("role"), system.alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )


def mapping_prompts(workset: DataFrame, mapping: DataFrame, template: Mapping[str, str],
                    id_col: str = K.ID, code_col: str = K.OLD_CODE, check: bool = True,
                    carry: Sequence[str] = ()) -> DataFrame:
    """Q5: prompt each declaration with the targets of its old code.

    J9: an old code missing from the mapping is an error: the distinct old codes
    (not the rows) are compared with the mapping before anything else runs.
    ``check=False`` skips that for rows restricted to mapped codes already, as
    those of ``ambiguous_workset``.  The old code reaches the prompt dotted.
    """
    cands = sized_broadcast(candidates_by_code(mapping))
    if check:
        codes = workset.select(undot(F.col(code_col)).alias("code08")).distinct()
        require_empty(codes.join(cands.select("code08"), "code08", "left_anti"), "old codes missing from the mapping")
    rows = workset.join(cands, undot(F.col(code_col)) == cands["code08"], "left")
    activity = activity_description()
    user = render(
        template["user"],
        {
            "nace_old": dot(F.col(code_col)),
            "proposed_codes": F.col("proposed_codes"),
            "list_proposed_codes": F.col("list_proposed_codes"),
            "activity": activity,
        },
        user_text=("activity",),
    )
    system = F.lit(template["system"])
    return rows.select(
        F.col(id_col),
        *[F.col(c) for c in carry if c != id_col],
        F.col("list_proposed_codes").alias("proposed_codes"),
        system.alias("system_prompt"),
        user.alias("user_prompt"),
        chat(system, user).alias("prompt"),
    )


def label_documents(mapping: DataFrame) -> DataFrame:
    """Q4: one markdown document per new code (D3 + X8), nulls filled with ``""``."""
    u = unique_targets(mapping)
    doc = label_document(dot(F.col("code")), "label", "notes", "include", "not_include")
    return u.select(
        F.col("code"),
        F.coalesce(F.col("label"), F.lit("")).alias("label"),
        F.coalesce(F.col("include"), F.lit("")).alias("include"),
        F.coalesce(F.col("not_include"), F.lit("")).alias("not_include"),
        F.coalesce(F.col("notes"), F.lit("")).alias("notes"),
        doc.alias("content"),
    )


def retrieval_prompts(
    workset: DataFrame,
    documents: DataFrame,
    template: Mapping[str, str],
    retriever_template: Mapping[str, str],
    embedder: Embedder | Callable[[], Embedder],
    k: int = K.TOP_K,
    scorer: PairScorer | None = None,
    fetch_k: int = K.RERANK_FETCH_K,
    id_col: str = K.ID,
    doc_vectors: DataFrame | None = None,
    carry: Sequence[str] = (),
    per_worker: bool = False,
    index: VectorIndex | None = None,
) -> DataFrame:
    """Q6: retrieve the ``k`` closest label documents for each activity and prompt with them.

    ``documents``: ``(code, content)``; their vectors are computed with the
    same embedder unless ``doc_vectors`` ``(code, vector)`` is given; with
    ``per_worker`` the embedder comes from a factory.  ``index``: search this index
    of the documents (codes and vectors of the same embedder) instead of all of them.
    """
    activity = activity_description()
    carried = [c for c in carry if c != id_col]
    queries = workset.select(
        F.col(id_col),
        *[F.col(c) for c in carried],
        activity.alias("__activity"),
        render(retriever_template["user"], {"activity_description": activity}, ("activity_description",)).alias("__q"),
    )
    # read twice below (scores, prompts): work set and vectors are computed once
    queries = stored(embed(queries, "__q", embedder, "__qvec", per_worker).drop("__q"), "queries")
    if doc_vectors is None and index is None:
        doc_vectors = embed(documents.select("code", "content"), "content", embedder, "vector", per_worker).select("code", "vector")
    names = {"query_id": id_col, "query_vec": "__qvec", "doc_id": "code"}
    fetch = {"fetch_k": fetch_k, "scorer": scorer} if scorer is not None else {}
    if index is not None:
        top = search_index(queries, index, k, **names, **fetch)
    else:
        top = similar_topk(queries, doc_vectors, k, **names, doc_vec="vector", **fetch)
    top = top.join(sized_broadcast(documents.select("code", "content")), "code")
    # at most k rows per id: a bounded list
    per_id = top.groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("rank", dot(F.col("code")).alias("code"), "content"))).alias("__docs")
    )
    rows = queries.select(id_col, *carried, "__activity").join(per_id, id_col, "left")
    docs = F.coalesce(F.col("__docs"), F.array().cast("array<struct<rank:int,code:string,content:string>>"))
    user = render(
        template["user"],
        {
            "proposed_codes": retrieved_block(F.transform(docs, lambda d: d["content"])),
            "list_proposed_codes": quoted_list(F.transform(docs, lambda d: d["code"])),
            "activity": F.col("__activity"),
        },
        user_text=("activity",),
    )
    system = F.lit(template["system"])
    return rows.select(
        F.col(id_col),
        *[F.col(c) for c in carried],
        quoted_list(F.transform(docs, lambda d: d["code"])).alias("proposed_codes"),
        system.alias("system_prompt"),
        user.alias("user_prompt"),
        chat(system, user).alias("prompt"),
    )


# A strategy is a prompt builder chosen by name
STRATEGIES = {"mapping": mapping_prompts, "retrieval": retrieval_prompts}
