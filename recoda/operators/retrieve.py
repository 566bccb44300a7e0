"""Exact cosine top-k between query vectors and document vectors.

No pair table is ever materialised: scores are computed block by block with a
matrix product inside Arrow-batched Python tasks and only the best ``k`` (or
``fetch_k``) documents per query leave a task.

* Document side within a checked size bound (a nomenclature: a few thousand
  codes): it is shipped once to every executor as a broadcast matrix and the
  queries are scored where they lie -- no shuffle at all.
* Beyond it, with at most ``FEW_QUERIES`` queries: these are shipped to every executor
  and the documents scored where they lie; only candidates are shuffled.
* Else documents are cut into blocks of bounded size, queries
  into as few hash chunks as keep every core busy (each side is
  shuffled once per block of the other), and each (chunk, block) pair meets in one cogroup task;
  a per-query window with ``row_number() <= k`` (planned as a
  ``WindowGroupLimit``) merges the per-block winners.

Scores are rounded to twelve digits, ties go to the smaller document id; so the
result is the same for every block size.  Vectors are compared in double.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recoda.session import row_count_at_most, ship_package, stored

PairScorer = Callable[[np.ndarray, np.ndarray], np.ndarray]
BROADCAST_MAX_BYTES = 256 * 1024 * 1024
SCORE_DIGITS = 12  # a matrix product adds in an order that depends on the block; ranks must not
FEW_QUERIES = 1_000  # so many queries go to the documents, not the documents to them
SCORE_CELLS = 4_000_000  # query rows x documents scored at once inside a task


def _matrix(values) -> np.ndarray:
    """Stack a column of equal-length vectors (numpy arrays from Arrow) into a float64 matrix."""
    if len(values) == 0:
        return np.zeros((0, 0))
    return np.vstack(values).astype(np.float64, copy=False)


def _unit(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(norms > 0, m / np.where(norms > 0, norms, 1.0), 0.0)


def _take_top(scores: np.ndarray, k: int) -> np.ndarray:
    """Column indices of the k best scores per row: higher score first, then lower index."""
    n = scores.shape[1]
    k = min(k, n)
    if k == 0:
        return np.zeros((scores.shape[0], 0), dtype=np.int64)
    s = np.where(np.isnan(scores), -np.inf, scores)
    kth = -np.partition(-s, k - 1, axis=1)[:, k - 1]
    above = s > kth[:, None]
    need = k - above.sum(axis=1)
    at = s == kth[:, None]
    take = above | (at & (np.cumsum(at, axis=1) <= need[:, None]))
    cols = np.nonzero(take)[1].reshape(scores.shape[0], k)  # ascending index within each row
    picked = np.take_along_axis(s, cols, axis=1)
    order = np.argsort(-picked, axis=1, kind="stable")
    return np.take_along_axis(cols, order, axis=1)


def _block_topk(qids, qmat, dids, dmat, k: int, fetch_k: int | None, scorer: PairScorer | None,
                final: bool) -> pd.DataFrame:
    """Best documents for a block of queries.

    ``dids`` must be sorted ascending so that index order is id order.  With
    ``final`` the block holds every document, so the result is already the
    answer (re-ranked when a scorer is given) and carries ``rank``; otherwise
    the ``fetch_k`` (or ``k``) best by cosine are returned for a later merge.
    """
    first = fetch_k if scorer is not None else k
    cols_out = ["qid", "did", "cosine"] + (["pair_score"] if scorer is not None else []) + (["rank"] if final else [])
    if len(qids) == 0 or len(dids) == 0:
        return pd.DataFrame({c: [] for c in cols_out})
    qids, dids = np.asarray(qids), np.asarray(dids)
    qu, du = _unit(qmat), _unit(dmat)
    step = max(1, SCORE_CELLS // max(1, len(dids)))
    frames = []
    for lo in range(0, len(qids), step):
        hi = min(len(qids), lo + step)
        # equal vectors must get equal scores wherever they lie in a block: rank on the rounded score
        cos = np.round(qu[lo:hi] @ du.T, SCORE_DIGITS)
        idx = _take_top(cos, first)  # (rows, f): best cosine first, then smaller id
        rows = np.arange(lo, hi)[:, None].repeat(idx.shape[1], axis=1)
        out = {"qid": qids[rows], "did": dids[idx], "cosine": np.take_along_axis(cos, idx, axis=1)}
        if scorer is not None:
            p = np.round(np.asarray(scorer(qmat[rows.reshape(-1)], dmat[idx.reshape(-1)]), dtype=np.float64), SCORE_DIGITS)
            out["pair_score"] = p.reshape(idx.shape)
            if final:
                by_id = np.argsort(idx, axis=1, kind="stable")
                p_by_id = np.take_along_axis(out["pair_score"], by_id, axis=1)
                best = np.argsort(-p_by_id, axis=1, kind="stable")[:, :k]
                order = np.take_along_axis(by_id, best, axis=1)
                out = {name: np.take_along_axis(v, order, axis=1) for name, v in out.items()}
        if final:
            width = out["did"].shape[1]
            out["rank"] = np.tile(np.arange(1, width + 1, dtype=np.int32), (hi - lo, 1))
        frames.append(pd.DataFrame({name: v.reshape(-1) for name, v in out.items()}))
    return pd.concat(frames, ignore_index=True)[cols_out]


def _final_rank(cands: DataFrame, k: int, fetch_k: int | None, reranked: bool) -> DataFrame:
    by_cos = Window.partitionBy("qid").orderBy(F.col("cosine").desc(), F.col("did").asc())
    if not reranked:
        return cands.withColumn("rank", F.row_number().over(by_cos)).filter(F.col("rank") <= k)
    kept = cands.withColumn("__r", F.row_number().over(by_cos)).filter(F.col("__r") <= fetch_k).drop("__r")
    by_pair = Window.partitionBy("qid").orderBy(F.col("pair_score").desc(), F.col("did").asc())
    return kept.withColumn("rank", F.row_number().over(by_pair)).filter(F.col("rank") <= k)


def similar_topk(
    queries: DataFrame,
    docs: DataFrame,
    k: int = 5,
    query_id: str = "query_id",
    query_vec: str = "query_vec",
    doc_id: str = "doc_id",
    doc_vec: str = "doc_vec",
    fetch_k: int | None = None,
    scorer: PairScorer | None = None,
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
    block_rows: int = 50_000,
) -> DataFrame:
    """J11 (and J12 when ``scorer`` is given): top-``k`` documents per query.

    With a ``scorer`` (U4, a vectorised pair scorer ``(Q, D) -> scores``), the
    ``fetch_k`` best documents by cosine are re-scored and the top ``k`` by the
    new score kept.  Output: ``query_id, doc_id, cosine, [pair_score], rank``.
    """
    reranked = scorer is not None
    if reranked and not fetch_k:
        raise ValueError("a re-ranking scorer needs fetch_k")
    spark = queries.sparkSession
    ship_package(spark)
    q = queries.select(F.col(query_id).alias("qid"), F.col(query_vec).alias("qvec"))
    d = docs.select(F.col(doc_id).alias("did"), F.col(doc_vec).alias("dvec"))
    qid_type = q.schema["qid"].dataType.simpleString()
    did_type = d.schema["did"].dataType.simpleString()
    cand_schema = f"qid {qid_type}, did {did_type}, cosine double" + (", pair_score double" if reranked else "")

    d = d.cache()  # probed three times below (dimension, size, contents); computed once
    first = d.take(1)
    dim = len(first[0]["dvec"]) if first else 0
    max_rows = max(1, min(block_rows, broadcast_max_bytes // max(8 * dim, 1)))
    small, _ = row_count_at_most(d, max_rows)

    if small:
        # proven bound: at most max_rows documents of dim doubles each
        pdf = d.toPandas().sort_values("did", kind="stable")
        d.unpersist()
        shipped = spark.sparkContext.broadcast((pdf["did"].to_numpy(), _matrix(pdf["dvec"].to_numpy())))

        def score_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            dids, dmat = shipped.value
            for b in batches:
                yield _block_topk(b["qid"].to_numpy(), _matrix(b["qvec"].to_numpy()), dids, dmat,
                                  k, fetch_k, scorer, final=True)

        ranked = q.mapInPandas(score_partition, cand_schema + ", rank int")
    elif row_count_at_most(q, FEW_QUERIES)[0]:
        d.unpersist()
        pdf = q.toPandas()
        asked = spark.sparkContext.broadcast((pdf["qid"].to_numpy(), _matrix(pdf["qvec"].to_numpy())))

        def score_docs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            qids, qmat = asked.value
            for b in batches:
                b = b.sort_values("did", kind="stable")
                yield _block_topk(qids, qmat, b["did"].to_numpy(), _matrix(b["dvec"].to_numpy()), k, fetch_k, scorer, final=False)

        ranked = _final_rank(d.mapInPandas(score_docs, cand_schema), k, fetch_k, reranked)
    else:
        # past the bound the document side is large: kept in the shared folder, not in memory, and not computed again
        kept = stored(d, "document-vectors")
        d.unpersist()
        d = kept
        blocks = max(1, math.ceil(d.count() / max_rows))
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        chunks = max(1, math.ceil(q.count() / max_rows), math.ceil(parts / blocks))
        qx = q.withColumn("__q", F.pmod(F.xxhash64("qid"), F.lit(chunks))).withColumn(
            "__b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        )
        dx = d.withColumn("__b", F.pmod(F.xxhash64("did"), F.lit(blocks))).withColumn(
            "__q", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
        )

        def score_pair(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            right = right.sort_values("did", kind="stable")
            return _block_topk(
                left["qid"].to_numpy(), _matrix(left["qvec"].to_numpy()),
                right["did"].to_numpy(), _matrix(right["dvec"].to_numpy()), k, fetch_k, scorer, final=False,
            )

        cands = qx.groupBy("__q", "__b").cogroup(dx.groupBy("__q", "__b")).applyInPandas(score_pair, cand_schema)
        ranked = _final_rank(cands, k, fetch_k, reranked)
    cols = [F.col("qid").alias(query_id), F.col("did").alias(doc_id), "cosine"]
    if reranked:
        cols.append("pair_score")
    return ranked.select(*cols, F.col("rank").cast("int").alias("rank"))


def dot_product_scorer(qmat: np.ndarray, dmat: np.ndarray) -> np.ndarray:
    """A pair scorer for tests: the raw (unnormalised) dot product of the two vectors."""
    return np.einsum("ij,ij->i", qmat, dmat)
