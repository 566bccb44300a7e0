"""A clustered (inverted-list) index over document vectors: top-k search for large document sides.

``similar_topk`` compares every query with every document, which is right for a
nomenclature and quadratic beyond.  Here documents are dealt to the nearest of
about sqrt(n) centroids; a query is compared with the documents of a few lists
only, exactly (cosine in double, rounded as ``similar_topk`` rounds it).

* The centroids are fitted (Spark ML k-means) on a sample of ``sample_rows``
  documents; every document is indexed.
* How many lists a query probes is measured, not guessed: ``tune_queries`` documents
  are searched by brute force while the index is built, and ``probes`` is the least
  number of lists that holds the wanted share of their true neighbours.
* Neighbouring lists are put together up to ``BLOCK_ROWS`` rows, larger ones and the
  queries that probe them are cut into blocks of at most about that, so a list that holds a third of all documents, or is probed by
  a third of all queries, is many tasks; a task keeps k rows a query.
* ``exact=True`` goes on after the first lists: a list is skipped only if the angle to
  its centroid, less the list's largest angle, shows that none of its documents can
  reach the query's k-th score.  The result equals ``similar_topk``.

Zero vectors lie in a list of their own (their cosine is 0 with everything); rows
with a null id or vector are not indexed, and such queries have no neighbours.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recoda.operators.retrieve import PairScorer, _block_topk, _final_rank, _matrix, _unit, similar_topk
from recoda.session import ship_package

MAX_LISTS = 16_384
BLOCK_ROWS = 20_000
SLACK = 1e-9  # angles are compared with this much room, so that rounding never skips a list


class VectorIndex(NamedTuple):
    """A stored index: ``centroids`` (unit rows), per list its rows and largest angle, and the measured ``probes``."""

    vectors: DataFrame  # did, dvec, list
    centroids: np.ndarray
    rows: np.ndarray
    angles: np.ndarray
    probes: int
    recall: float


def _row_matrix(column: pa.Array) -> np.ndarray:
    """Equal-length vectors of an Arrow list column as a matrix."""
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _nearness(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return _unit(vectors) @ centroids.T


def _fit(vectors: DataFrame, lists: int, n: int, sample_rows: int, seed: int) -> np.ndarray:
    norm = F.aggregate("dvec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    usable = vectors.filter(norm > 0).select(array_to_vector(F.col("dvec").cast("array<double>")).alias("features"))
    sample = usable.sample(fraction=min(1.0, sample_rows / n), seed=seed).cache()
    try:
        if not sample.take(1):
            return np.zeros((0, 0))
        fitted = KMeans(k=lists, seed=seed, maxIter=15, distanceMeasure="cosine").fit(sample)
        return _unit(np.array(fitted.clusterCenters()))
    finally:
        sample.unpersist()


def build_index(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    doc_vec: str = "doc_vec",
    lists: int | None = None,
    sample_rows: int = 200_000,
    tune_queries: int = 200,
    tune_k: int = 5,
    wanted_recall: float = 0.95,
    seed: int = 7,
) -> VectorIndex:
    """Write the index of ``docs`` to ``path`` (``vectors``, ``lists``) and open it.

    ``lists``: about sqrt(n) by default, at most ``MAX_LISTS``, so the centroids have
    a bounded size.  ``wanted_recall`` of the ``tune_k`` nearest neighbours is
    reached on the tuning queries.
    """
    spark = docs.sparkSession
    ship_package(spark)
    vectors = docs.select(F.col(doc_id).alias("did"), F.col(doc_vec).alias("dvec")).na.drop()
    n = vectors.count()
    wanted = lists or max(1, min(MAX_LISTS, round(math.sqrt(max(n, 1)))))
    centroids = _fit(vectors, max(2, wanted), n, sample_rows, seed) if n else np.zeros((0, 0))
    shipped = spark.sparkContext.broadcast(centroids)
    did_type = vectors.schema["did"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            matrix, k = _row_matrix(rows.column("dvec")), len(shipped.value)
            none = np.linalg.norm(matrix, axis=1) == 0
            near = _nearness(matrix, shipped.value) if k else np.zeros((len(matrix), 1))
            best = np.argmax(near, axis=1)
            angle = np.arccos(np.clip(near[np.arange(len(near)), best], -1, 1))
            best[none], angle[none] = k, 0
            arrays = [rows.column("did"), rows.column("dvec"), pa.array(best.astype(np.int32)), pa.array(angle)]
            yield pa.RecordBatch.from_arrays(arrays, names=["did", "dvec", "list", "angle"])

    dvec_type = vectors.schema["dvec"].dataType.simpleString()
    dealt = vectors.mapInArrow(assign, f"did {did_type}, dvec {dvec_type}, list int, angle double")
    # sorted by list, so that a reader of few lists skips the other row groups
    dealt.repartitionByRange("list", "did").sortWithinPartitions("list").write.mode("overwrite").parquet(f"{path}/vectors")
    stored = spark.read.parquet(f"{path}/vectors")
    sizes = {r["list"]: r for r in stored.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("a")).collect()}
    table = [(i, centroids[i].tolist() if i < len(centroids) else None, sizes[i]["n"] if i in sizes else 0,
              float(sizes[i]["a"]) if i in sizes else 0.0) for i in range(len(centroids) + 1)]
    probes, recall = _tune(stored, vectors, centroids, n, tune_queries, tune_k, wanted_recall, seed)
    described = spark.createDataFrame(table, "list int, centroid array<double>, n long, angle double")
    described = described.withColumns({"probes": F.lit(probes), "recall": F.lit(float(recall))})
    described.coalesce(1).write.mode("overwrite").parquet(f"{path}/lists")
    return open_index(spark, path)


def _tune(
    stored: DataFrame, vectors: DataFrame, centroids: np.ndarray, n: int, queries: int, k: int, wanted: float, seed: int
) -> tuple[int, float]:
    """The least number of lists to probe for ``wanted`` recall on some documents as queries, and that recall."""
    if not len(centroids):
        return 1, 1.0
    sample = vectors.sample(fraction=min(1.0, 2 * queries / n), seed=seed).limit(queries)
    asked = sample.select(F.col("did").alias("qid"), F.col("dvec").alias("qvec"))
    truth = similar_topk(asked, vectors, k, "qid", "qvec", "did", "dvec")
    found = truth.join(stored.select("did", "list"), "did").join(asked, "qid").select("qvec", "list").collect()  # queries x k rows
    if not found:
        return 1, 1.0
    near = _nearness(np.array([r["qvec"] for r in found], np.float64), centroids)
    held = np.array([r["list"] for r in found])
    real = held < len(centroids)  # the list of zero vectors is always probed
    own = near[np.arange(len(held)), np.minimum(held, len(centroids) - 1)]
    place = np.where(real, (near > own[:, None]).sum(axis=1) + 1, 1)
    reached = np.array([(place <= p).mean() for p in range(1, len(centroids) + 1)])
    probes = int(np.argmax(reached >= wanted)) + 1
    return probes, float(reached[probes - 1])


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    lists = spark.read.parquet(f"{path}/lists").orderBy("list").collect()  # at most MAX_LISTS + 1 rows
    centroids = [r["centroid"] for r in lists if r["centroid"] is not None]
    return VectorIndex(
        spark.read.parquet(f"{path}/vectors").select("did", "dvec", "list"),
        np.array(centroids) if centroids else np.zeros((0, 0)),
        np.array([r["n"] for r in lists]), np.array([r["angle"] for r in lists]), lists[0]["probes"], lists[0]["recall"],
    )


def _groups(rows: np.ndarray) -> np.ndarray:
    """The first list of every group: neighbouring lists of at most ``BLOCK_ROWS`` rows together, or one larger list."""
    starts, held = [0], 0
    for i, n in enumerate(rows.tolist()):
        if i > starts[-1] and held + n > BLOCK_ROWS:
            starts.append(i)
            held = 0
        held += n
    return np.array(starts)


def _candidates(probing: DataFrame, index: VectorIndex, k: int, schema: str) -> DataFrame:
    """The k best documents per query within the lists it probes (qid, qvec, group, lists), block by block.

    A query goes once to every group of lists that it probes, and one task of a group
    returns k documents a query, however many lists the group has.
    """
    spark = probing.sparkSession
    starts = _groups(index.rows)
    asked = {r["group"]: r["count"] for r in probing.groupBy("group").count().collect()}  # one row per group
    sizes = np.add.reduceat(index.rows, starts).tolist()
    cut = [(i, max(1, -(-int(n) // BLOCK_ROWS)), max(1, -(-asked.get(i, 0) // BLOCK_ROWS)))
           for i, n in enumerate(sizes) if i in asked and n]
    blocks = F.broadcast(spark.createDataFrame(cut, "group int, __docs int, __queries int"))  # at most MAX_LISTS + 1 rows
    of = [(i, g) for g, (a, b) in enumerate(zip(starts, [*starts[1:], len(index.rows)], strict=True)) for i in range(int(a), int(b))]
    group_of = F.broadcast(spark.createDataFrame(of, "list int, group int"))  # at most MAX_LISTS + 1 rows
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    q = probing.join(blocks, "group").withColumn("__q", F.pmod(F.xxhash64("qid"), F.col("__queries")).cast("int"))
    d = index.vectors.join(group_of, "list").join(blocks, "group")
    d = d.withColumn("__d", F.pmod(F.xxhash64("did"), F.col("__docs")).cast("int"))
    q, d = q.withColumn("__d", every("__docs")), d.withColumn("__q", every("__queries"))
    key = ["group", "__d", "__q"]

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"qid": [], "did": [], "cosine": []})]
        if len(left) and len(right):
            right = right.sort_values(["list", "did"], kind="stable")
            qids, dids, held = left["qid"].to_numpy(), right["did"].to_numpy(), right["list"].to_numpy()
            qmat, dmat = _matrix(left["qvec"].to_numpy()), _matrix(right["dvec"].to_numpy())
            asker = np.repeat(np.arange(len(left)), [len(x) for x in left["lists"]])
            probed = np.concatenate(left["lists"].to_list())
            parts = [(asker[probed == i], slice(*np.searchsorted(held, [i, i + 1]))) for i in np.unique(held)]
            tops = [_block_topk(qids[who], qmat[who], dids[at], dmat[at], k, None, None, final=False) for who, at in parts if len(who)]
            found = tops or found
        best = pd.concat(found, ignore_index=True).sort_values(["cosine", "did"], ascending=[False, True], kind="stable")
        return best.groupby("qid", sort=False).head(k)

    q, d = q.select("qid", "qvec", "lists", *key), d.select("did", "dvec", "list", *key)
    return q.groupBy(*key).cogroup(d.groupBy(*key)).applyInPandas(score, schema)


def search_index(
    queries: DataFrame,
    index: VectorIndex,
    k: int = 5,
    query_id: str = "query_id",
    query_vec: str = "query_vec",
    doc_id: str = "doc_id",
    probes: int | None = None,
    exact: bool = False,
    fetch_k: int | None = None,
    scorer: PairScorer | None = None,
) -> DataFrame:
    """The ``k`` nearest documents of every query: ``query_id, doc_id, cosine, [pair_score], rank``, as ``similar_topk``.

    ``probes`` (default: as measured when the index was built) lists are searched;
    with ``exact`` also all others that may hold a nearer document.  With a
    ``scorer`` the ``fetch_k`` nearest are scored again and the ``k`` best kept.
    """
    if scorer is not None and not fetch_k:
        raise ValueError("a re-ranking scorer needs fetch_k")
    spark = queries.sparkSession
    ship_package(spark)
    q = queries.select(F.col(query_id).alias("qid"), F.col(query_vec).alias("qvec")).na.drop()
    types = {c: df.schema[c].dataType.simpleString() for df, c in ((q, "qid"), (q, "qvec"), (index.vectors, "did"))}
    schema = f"qid {types['qid']}, did {types['did']}, cosine double"
    centroids, rows, angles = index.centroids, index.rows, index.angles
    first, wanted = min(probes or index.probes, max(1, len(centroids))), fetch_k if scorer is not None else k
    shipped = spark.sparkContext.broadcast((centroids, rows, angles))
    starts = _groups(rows)
    probe_schema = f"qid {types['qid']}, qvec {types['qvec']}, group int, lists array<int>"

    def listed(batch: pa.RecordBatch, mask: np.ndarray) -> pa.RecordBatch:
        """Per query and group of lists one row: the lists of ``mask`` in that group."""
        counts = np.add.reduceat(mask.astype(np.int32), starts, axis=1)
        at, group = np.nonzero(counts)
        ends = np.concatenate([[0], np.cumsum(counts[at, group])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.nonzero(mask)[1].astype(np.int32)))
        picked = batch.select(["qid", "qvec"]).take(pa.array(at))
        return pa.RecordBatch.from_arrays([*picked.columns, pa.array(group.astype(np.int32)), lists],
                                          names=["qid", "qvec", "group", "lists"])

    def nearest(near: np.ndarray) -> np.ndarray:
        """Mask of the first lists of every query, ties to the smaller number; the zero vectors' list is one of them."""
        order = np.argsort(-near, axis=1, kind="stable")[:, :first]
        mask = np.zeros((len(near), near.shape[1] + 1), bool)
        np.put_along_axis(mask, order, True, axis=1)
        mask[:, -1] = True
        return mask

    def near_of(batch: pa.RecordBatch) -> np.ndarray:
        matrix, (c, _, _) = _row_matrix(batch.column("qvec")), shipped.value
        return _nearness(matrix, c) if len(c) else np.zeros((len(matrix), 0))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                yield listed(part, nearest(near_of(part)) & (shipped.value[1] > 0))

    def probe_more(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                near, (_, sizes, widest) = near_of(part), shipped.value
                matrix = _row_matrix(part.column("qvec"))
                angle = np.arccos(np.clip(near, -1, 1)) - widest[:-1]
                bound = np.cos(np.maximum(angle - SLACK, 0)) + SLACK
                bound[np.linalg.norm(matrix, axis=1) == 0] = 0  # a zero query ties with all documents
                kth = part.column("kth").fill_null(-2.0).to_numpy(zero_copy_only=False)
                more = np.column_stack([bound >= kth[:, None] - SLACK, np.zeros(len(near), bool)])
                yield listed(part, more & ~nearest(near) & (sizes > 0))

    found = _candidates(q.mapInArrow(probe, probe_schema), index, wanted, schema)
    if exact:
        best = Window.partitionBy("qid").orderBy(F.col("cosine").desc(), F.col("did").asc())
        ranked = found.withColumn("__r", F.row_number().over(best)).filter(F.col("__r") <= wanted)
        kth = ranked.filter(F.col("__r") == wanted).select(F.col("qid").alias("__of"), F.col("cosine").alias("kth"))
        open_ = q.join(kth, F.col("qid") == F.col("__of"), "left").select("qid", "qvec", "kth")
        found = ranked.drop("__r").unionByName(_candidates(open_.mapInArrow(probe_more, probe_schema), index, wanted, schema))
    top = _final_rank(found, wanted, None, False)
    columns = ["cosine"]
    if scorer is not None:
        pairs = top.join(q, "qid").join(index.vectors.select("did", "dvec"), "did").select("qid", "did", "cosine", "qvec", "dvec")

        def rescore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                score = np.asarray(scorer(_row_matrix(b.column("qvec")), _row_matrix(b.column("dvec"))), np.float64)
                arrays = [b.column("qid"), b.column("did"), b.column("cosine"), pa.array(np.round(score, 12))]
                yield pa.RecordBatch.from_arrays(arrays, names=["qid", "did", "cosine", "pair_score"])

        by_pair = Window.partitionBy("qid").orderBy(F.col("pair_score").desc(), F.col("did").asc())
        top = pairs.mapInArrow(rescore, schema + ", pair_score double")
        top = top.withColumn("rank", F.row_number().over(by_pair)).filter(F.col("rank") <= k)
        columns.append("pair_score")
    return top.select(F.col("qid").alias(query_id), F.col("did").alias(doc_id), *columns, F.col("rank").cast("int").alias("rank"))
