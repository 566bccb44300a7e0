"""Resumable inference (Q7, J8): answers are logged batch by batch, and only missing ones are asked for.

A model's answers cost far more than anything around them, so a run that dies
half-way must not lose them.  Every task appends the answers of a batch to the
run's log as soon as it has them: one Parquet file per batch, written under a
hidden name and renamed when whole.  A row counts as answered when the log holds
its id with the same prompt and generation settings (their hash), so a changed
template or setting is asked again and an unchanged row never is.

* A new run of the job reads the log and anti-joins the prompts with it.
* A task that Spark runs again skips what its earlier attempt logged.
* Two attempts at once (speculation) may log a row twice; the result has it once.

The log's folder must be reachable by the tasks through Arrow's file systems
(local or mounted paths, ``s3://`` / ``s3a://``, ``hdfs://``, ``gs://``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from recoda.operators.infer import ANSWER_SCHEMA, Predictor, answered, carried, loader, with_prompts
from recoda.session import ship_package

ASKED = "prompt_hash"  # column of the log: what was asked


def _filesystem(uri: str):
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def prompt_hash(settings: Mapping[str, object]):
    """64 bits for a row's prompt and the run's settings."""
    stated = json.dumps(settings, sort_keys=True, default=str)
    return F.xxhash64("system_prompt", "user_prompt", F.lit(stated))


def read_log(spark: SparkSession, log: str, schema: StructType) -> DataFrame:
    """The answers logged so far, ``schema`` as ``logged_schema`` gives it; a batch may be there twice."""
    if not _exists(spark, log):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(log)


def logged_schema(df: DataFrame, kept: Sequence[str]) -> StructType:
    fields = df.select(*kept).schema.fields
    return StructType([*fields, StructField(ASKED, LongType()), *StructType.fromDDL(ANSWER_SCHEMA).fields])


def log_answers(
    batches: Iterator[pa.RecordBatch],
    folder: str,
    attempt: int,
    id_col: str,
    batch_rows: int,
    ask: Callable[[pa.RecordBatch], pa.RecordBatch],
) -> int:
    """Ask and log a task's rows, ``batch_rows`` at a time, but for those an earlier attempt logged in ``folder``; how many."""
    from pyarrow import fs
    from pyarrow import parquet as pq

    store, at = _filesystem(folder)
    done: set = set()
    for file in store.get_file_info(fs.FileSelector(at, allow_not_found=True)):
        if not file.base_name.startswith("_"):
            with store.open_input_file(file.path) as source:
                table = pq.read_table(source, columns=[id_col, ASKED])
            done.update(zip(table[id_col].to_pylist(), table[ASKED].to_pylist(), strict=True))
    count = 0
    for rows in batches:
        for start in range(0, rows.num_rows, batch_rows):
            part = rows.slice(start, batch_rows)
            if done:
                pairs = zip(part.column(id_col).to_pylist(), part.column(ASKED).to_pylist(), strict=True)
                part = part.filter(pa.array([pair not in done for pair in pairs], pa.bool_()))
            if not part.num_rows:
                continue
            table = pa.Table.from_batches([ask(part)])
            store.create_dir(at, recursive=True)
            name = f"{attempt}-{count:09d}.parquet"
            with store.open_output_stream(f"{at}/_{name}") as sink:
                pq.write_table(table, sink)
            store.move(f"{at}/_{name}", f"{at}/{name}")
            count += part.num_rows
    return count


def run_resumably(
    df: DataFrame,
    predictor: Predictor | Callable[[], Predictor],
    log: str,
    id_col: str,
    carry: Sequence[str] | None = None,
    settings: Mapping[str, object] | None = None,
    per_worker: bool = False,
    model_key: str | None = None,
    profile: ResourceProfile | None = None,
    batch_rows: int = 1000,
    tasks: int | None = None,
) -> DataFrame:
    """``run_predictor`` with a durable ``log``: the same result, one row per id; only unanswered ids reach the model.

    Ids must be unique in ``df`` (null counts as an id); ``log`` belongs to one run
    (model, run id, shard).  Runs the model when called and returns the answers as
    read from the log.  ``batch_rows``: rows of a model call and of a log file.
    ``tasks``: how many tasks share the missing rows (default: as Spark plans them,
    by bytes, which may be too few for a slow model).
    """
    spark = df.sparkSession
    ship_package(spark)
    kept, options = carried(df, carry), dict(settings or {})
    if id_col not in kept:
        raise ValueError(f"the id {id_col!r} must be carried along")
    schema = logged_schema(df, kept)
    load, job = loader("predictor", predictor, per_worker, model_key), uuid.uuid4().hex
    asked = df.withColumn(ASKED, prompt_hash(options))

    def same(left: DataFrame, right: DataFrame):
        return left[id_col].eqNullSafe(right["__id"]) & (left[ASKED] == right["__asked"])

    known = read_log(spark, log, schema).select(F.col(id_col).alias("__id"), F.col(ASKED).alias("__asked"))
    missing = asked.join(known, same(asked, known), "left_anti")
    if tasks:
        missing = missing.repartition(tasks)
    columns = [*kept, ASKED]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        folder = f"{log.rstrip('/')}/{job}/part-{context.partitionId():06d}"
        n = log_answers(batches, folder, context.attemptNumber(), id_col, batch_rows,
                        lambda rows: answered(rows, columns, load(), options))
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    # an action: the answers are in the log when it ends
    with_prompts(missing, columns).mapInArrow(work, "n long", profile=profile).agg(F.sum("n")).first()
    return answers_of(df, log, id_col, kept, options)


def answers_of(
    df: DataFrame, log: str, id_col: str, carry: Sequence[str] | None = None, settings: Mapping[str, object] | None = None
) -> DataFrame:
    """What the log holds of the prompts ``df``, each id once: the carried columns and the answers."""
    spark, kept = df.sparkSession, carried(df, carry)
    asked = df.select(F.col(id_col).alias("__id"), prompt_hash(dict(settings or {})).alias("__asked"))
    held = read_log(spark, log, logged_schema(df, kept)).withColumn("__file", F.input_file_name())
    held = held.join(asked, held[id_col].eqNullSafe(asked["__id"]) & (held[ASKED] == asked["__asked"]), "left_semi")
    first = Window.partitionBy(id_col).orderBy("__file")
    once = held.withColumn("__n", F.row_number().over(first)).filter("__n = 1")
    return once.drop("__file", "__n", ASKED)
