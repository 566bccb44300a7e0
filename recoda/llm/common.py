"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import os
import sys
import types
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recoda.session import scratch_path, ship_package

# ASCII white space, as the word definitions of the quality and near-copy operators take it.
ASCII_SPACE = " \t-\r"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, lean: bool = False) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing,
    and every later use sees the same rows in the same files.  ``lean`` is for
    whole texts: Zstandard files, and the write's own shuffles, which nothing
    reads after it, are dropped when it ends instead of at some later time.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if not lean:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def text_hash(text: Column) -> list[Column]:
    """128 bits that stand for a text (a null text equals only a null text)."""
    return [F.xxhash64(text, F.lit(0)), F.xxhash64(F.lit(1), text)]


def worker_state(key: tuple, make: Callable[[], object]) -> object:
    """An object a Python worker builds once and keeps for its later tasks.

    Functions reach the workers by value, so their own globals do not outlive a
    task; this store does.  It is dropped when the worker ends.
    """
    store = sys.modules.setdefault("_recoda_worker_state", types.ModuleType("_recoda_worker_state")).__dict__
    for old in [k for k in store if isinstance(k, tuple) and k[0] == key[0] and k != key]:
        del store[old]  # one state per kind: an older job's one must not pile up
    if key not in store:
        store[key] = make()
    return store[key]


def slices(texts: Iterable[str], max_chars: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive runs of texts with about ``max_chars`` characters each."""
    start, size, i = 0, 0, -1
    for i, t in enumerate(texts):
        size += len(t)
        if size >= max_chars:
            yield start, i + 1
            start, size = i + 1, 0
    if i >= start:
        yield start, i + 1


def map_batches(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with the package's functions sent by value.

    Arrow batches keep null integers as they are (pandas would make them floats).
    """
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def strings(column) -> list[str]:
    """An Arrow string column as Python strings, nulls as empty ones."""
    return [t or "" for t in column.to_pylist()]


def batch(**columns):
    """An Arrow record batch; a value is an Arrow or numpy array, or (type name, values)."""
    import pyarrow as pa

    made = [pa.array(c[1], getattr(pa, c[0])()) if isinstance(c, tuple) else c for c in columns.values()]
    made = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else pa.array(c) for c in made]
    return pa.RecordBatch.from_arrays(made, names=list(columns))


def single_threaded() -> None:
    """Leave the parallel work to Spark's tasks (tokenizer threads off)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
