"""Session construction and the few cluster-level helpers every job shares."""

from __future__ import annotations

import os
import sys
import tempfile
import types
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Reference tables (correspondence, notes, templates) hold one row per code of a
# nomenclature: a few thousand rows.  Anything under this many rows may be
# broadcast; above it the join falls back to a shuffle join.
DEFAULT_BROADCAST_ROWS = 200_000
DEFAULT_BROADCAST_BYTES = 128 * 1024 * 1024


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "recoda") -> SparkSession:
    """A session with AQE (coalescing + skew-join splitting) switched on and the UI off."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("RECODA_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint
    dir).  Only when neither is set and the master is local (tests) do we pick a
    private temporary folder and register it, so later calls agree; on a cluster
    each executor would write to its own disk, so that is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="recoda-ckpt-")
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/recoda/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing,
    and every later use sees the same rows in the same files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this library wrote below the checkpoint folder (call when no result needs it any more)."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/recoda")
    root.getFileSystem(spark._jsc.hadoopConfiguration()).delete(root, True)


def process_object(kind: str, key: str, make: Callable[[], object]) -> object:
    """The ``kind`` of object (a model, an embedder) this Python process holds, made by ``make`` if it has none under ``key``.

    Task functions reach the workers by value, so their own globals end with the
    task; this store is an entry of ``sys.modules`` and lives as long as the worker
    process, over all tasks it runs.  A new key replaces the kind's older object,
    so that models never pile up.
    """
    store = sys.modules.setdefault("_recoda_process_objects", types.ModuleType("_recoda_process_objects")).__dict__
    held = store.get(kind)
    if held is None or held[0] != key:
        store.pop(kind, None)  # let go of the old model before the new one is loaded
        held = store[kind] = (key, make())
    return held[1]


def row_count_at_most(df: DataFrame, limit: int) -> tuple[bool, int]:
    """Whether ``df`` has at most ``limit`` rows, counting no further than limit+1."""
    n = df.limit(limit + 1).count()
    return n <= limit, n


def sized_broadcast(
    df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES
) -> DataFrame:
    """Hint ``df`` for broadcast only after checking its rows and bytes.

    One probe reads at most ``max_rows + 1`` rows, uncached, and adds up their
    size as JSON text (an upper estimate of the data).  Beyond either bound the
    frame is returned unhinted, so Catalyst/AQE plan a shuffle join instead of
    shipping a growing table to every executor.
    """
    size = F.coalesce(F.octet_length(F.to_json(F.struct("*"))), F.lit(0))
    rows, n_bytes = df.limit(max_rows + 1).select(size.alias("s")).agg(F.count(F.lit(1)), F.sum("s")).first()
    return F.broadcast(df) if rows <= max_rows and (n_bytes or 0) <= max_bytes else df


def ship_package(spark: SparkSession | None = None) -> None:
    """Make the functions of this package runnable by the Python workers.

    Operators that run Python (Pandas UDFs, ``mapInPandas``, cogroups) would
    pickle functions of ``recoda`` by reference, which needs the package
    installed on every executor.  Registering the package with cloudpickle
    sends those functions by value with the task instead: nothing to install,
    no files to stage.  Idempotent.
    """
    from pyspark import cloudpickle

    pkg = sys.modules[__name__.split(".")[0]]
    cloudpickle.register_pickle_by_value(pkg)
