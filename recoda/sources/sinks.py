"""Sinks (K1–K4): whole tables, partitioned results, embedding collections, metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from recoda.sources.published import publish, replace_folder

# fixed value: run stamp layout (minutes), with "-" instead of ":" so it can be a path segment
RUN_STAMP_FORMAT = "%Y-%m-%d--%H-%M"


def run_stamp(at: datetime | None = None) -> str:
    """The identifier of a run, e.g. ``2024-11-13--00-39``."""
    return (at or datetime.now()).strftime(RUN_STAMP_FORMAT)


def write_table(df: DataFrame, path: str) -> str:
    """K1: replace a Parquet table once the new one is complete (a failing writer leaves the old one as it was)."""
    replace_folder(df.sparkSession, path, lambda folder: df.write.parquet(folder))
    return path


def path_name(name: str) -> str:
    """A model's name as a folder name: slashes become ``--`` (``read_runs`` gives the names back)."""
    return name.replace("/", "--")


def run_path(root: str, shard: int | str | None, **parts: str) -> str:
    """Hive-style folder of one shard (``all``: not sharded) of one run of one model, in the order of ``parts``."""
    values = {k: path_name(v) if k == "model" else v for k, v in parts.items()}
    values["shard"] = "all" if shard is None else str(shard)
    for name, value in values.items():
        if "/" in value or ":" in value or "=" in value:
            raise ValueError(f"{name} {value!r} cannot be a path segment")
    return "/".join([root.rstrip("/"), *[f"{k}={v}" for k, v in values.items()]])


def write_unique(df: DataFrame, path: str, keys: Sequence[str], message: str | None) -> dict[str, int]:
    """K1 + C1 in one write: the table's rows and how many of them repeat a key (null keys count as equal).

    Both are observed while the table is written.  With a ``message``, repeated keys
    are an error and the table at ``path`` stays as it was.
    """
    seen = Observation()
    counted = df.withColumn("__same", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    counted = counted.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("__same") > 1).alias("repeated"))

    def write(folder: str) -> None:
        counted.drop("__same").write.parquet(folder)
        if message and seen.get["repeated"]:
            raise AssertionError(message)

    replace_folder(df.sparkSession, path, write)
    return dict(seen.get)


def write_results(
    df: DataFrame,
    root: str,
    model: str,
    run_id: str,
    shard: int | str | None = None,
    metrics: Mapping[str, Column] | None = None,
    without: Sequence[str] = (),
) -> tuple[str, dict[str, object]] | str:
    """K2: results of one run under ``root/model=<m>/run_id=<r>/shard=<s>/version=<v>/codable=<bool>``.

    Writing replaces that shard of that run only: re-running it is idempotent,
    and the three shard jobs of one run can write concurrently without
    touching each other (``shard=all`` when the run is not sharded).  The new
    version of a shard is published when it is complete; ``read_runs`` reads
    published versions only, so a run that fails or is retried never tears one.
    Identifiers must be usable as path segments (e.g. run ``2024-11-13--00-39``);
    a slash in a model's name is written as ``--``.  Returns the version's folder;
    with ``metrics`` (aggregate expressions over ``df``) also their values, observed
    during the write; the columns ``without`` are measured but not written.
    """
    path, seen = run_path(root, shard, model=model, run_id=run_id), Observation()
    rows = df.observe(seen, *[v.alias(k) for k, v in metrics.items()]) if metrics else df
    rows = rows.drop("model", "run_id", "shard", *without)
    at = publish(df.sparkSession, path, lambda folder: rows.write.partitionBy("codable").parquet(folder))
    return (at, dict(seen.get)) if metrics else at


def write_collection(vectors: DataFrame, path: str, model: str) -> str:
    """K3: an embeddings collection ``(..., vector)`` tagged with the model that made it."""
    return write_table(vectors.withColumn("model", F.lit(model)), path)


def write_metrics(metrics: DataFrame, root: str, run_id: str, model: str, shard: int | str | None = None) -> str:
    """K4: a long ``(metric, value)`` table under its run, model and shard; writing it again replaces it."""
    return write_table(metrics.select("metric", "value").coalesce(1), run_path(root, shard, run_id=run_id, model=model))


def write_params(spark, params: dict, root: str, run_id: str, model: str, shard: int | str | None = None) -> str:
    """K4: the run's parameters ``(param, value)`` beside its metrics (a handful of driver-side settings)."""
    rows = [(str(k), str(v)) for k, v in params.items()]
    df = spark.createDataFrame(rows, "param string, value string")
    return write_table(df.coalesce(1), run_path(root, shard, run_id=run_id, model=model))
