"""Embedding collections that are built incrementally.

A collection keeps, beside every vector, a hash of the text it was made from.  A new
build over a changed nomenclature reuses the vectors of unchanged documents, embeds
new and changed ones only and leaves out those that are gone; the result is a new
version, published at once (``recoda.sources.published``).  Nothing changed: no new
version, and the model is not called.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoda.operators.infer import Embedder, embed
from recoda.session import stored
from recoda.sources.published import current, publish


class Build(NamedTuple):
    path: str
    embedded: int
    reused: int
    removed: int


def _kept(spark: SparkSession, root: str, model: str, schema) -> DataFrame:
    """code, content_hash, vector of the published version made by ``model`` (none: another model made it)."""
    at = current(spark, root)
    if at is None:
        return spark.createDataFrame([], schema)
    held = spark.read.parquet(at)
    return held.filter(F.col("model") == model).select("code", "content_hash", "vector")


def build_collection(
    docs: DataFrame,
    embedder: Embedder | Callable[[], Embedder],
    model: str,
    root: str,
    per_worker: bool = False,
) -> Build:
    """Publish the vectors of ``docs`` (code, content, other columns) below ``root``; how many were embedded, reused, removed.

    Codes must be unique and not null.  A vector is reused when the version published
    holds it for the same code, the same text and the same model.
    """
    spark = docs.sparkSession
    hashed = docs.withColumn("content_hash", F.sha2(F.col("content"), 256))
    repeated = hashed.groupBy("code").count().filter("code IS NULL OR count > 1").take(1)
    if repeated:
        raise ValueError(f"documents of a collection need one code each; {repeated[0]['code']!r} has {repeated[0]['count']}")
    kind = hashed.schema["code"].dataType.simpleString()
    before = _kept(spark, root, model, f"code {kind}, content_hash string, vector array<float>")
    matched = hashed.join(before, ["code", "content_hash"], "left").select(*docs.columns, "content_hash", "vector")
    matched = stored(matched, "matched-documents")  # what is missing is decided once, before any model runs
    n, missing = matched.agg(F.count(F.lit(1)), F.count_if(F.col("vector").isNull())).first()
    held = before.count()
    removed = held - (n - missing)
    at = current(spark, root)
    if at is not None and held and not missing and not removed:
        return Build(at, 0, n, 0)
    ready = matched.filter("vector IS NOT NULL").withColumn("embedded", F.lit(False))
    fresh = embed(matched.filter("vector IS NULL").drop("vector"), "content", embedder, "vector", per_worker)
    every = ready.unionByName(fresh.withColumn("embedded", F.lit(True))).withColumn("model", F.lit(model))
    path = publish(spark, root, lambda folder: every.write.parquet(folder))
    return Build(path, missing, n - missing, removed)
