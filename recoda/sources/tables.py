"""Scans (S1–S6): Parquet tables, SQL over them, reference sheets, result datasets, collections."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from recoda.sources.published import children, current
from recoda.sources.sinks import path_name


def read_table(spark: SparkSession, root: str, name: str, schema: StructType | str | None = None) -> DataFrame:
    """A Parquet table (file or directory of files), optionally with an explicit schema."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(f"{root.rstrip('/')}/{name}.parquet")


def sql_over(spark: SparkSession, query: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Run SQL over named DataFrames; the result stays a lazy DataFrame."""
    return spark.sql(query, **tables)


def read_sheet(spark: SparkSession, path: str, columns: Sequence[str], fmt: str = "csv",
               row_col: str | None = None) -> DataFrame:
    """S3: a reference sheet exported as CSV/Parquet, every column read as text.

    Malformed rows, and header names other than ``columns`` in this order, fail
    the read (``FAILFAST``, no ``enforceSchema``) instead of being dropped or
    read into wrong columns.  ``row_col`` adds a row number that rises with the
    place in the sheet, which "first row" rules need: the sheet's files follow each
    other by name (numbers in names by value), rows by their place in the file, so
    a sheet may be many files, read by many tasks.
    """
    schema = StructType([StructField(c, StringType(), True) for c in columns])
    reader = spark.read.schema(schema)
    if fmt == "csv":
        options = {"header": "true", "mode": "FAILFAST", "multiLine": "true", "enforceSchema": "false", "escape": '"'}
        sheet = reader.options(**options).csv(path)
    else:
        sheet = reader.format(fmt).load(path)
    return _numbered(sheet, row_col, fmt) if row_col else sheet


def _numbered(sheet: DataFrame, row_col: str, fmt: str) -> DataFrame:
    """``sheet`` with gapless row numbers from 0: rows of the files before, then the place in the file."""
    placed = sheet.withColumn("__file", F.col("_metadata.file_path"))
    if fmt == "parquet":
        placed = placed.withColumn("__at", F.col("_metadata.row_index"))
    else:  # a file is read in order by one task
        in_file = Window.partitionBy("__file").orderBy("__seen")
        placed = placed.withColumn("__seen", F.monotonically_increasing_id())
        placed = placed.withColumn("__at", F.row_number().over(in_file).cast("long") - 1).drop("__seen")
    sizes = sheet.groupBy(F.col("_metadata.file_path").alias("file")).count().collect()  # one row per file of the sheet
    start, starts = 0, []
    for name, n in sorted(map(tuple, sizes), key=lambda s: [int(x) if x.isdigit() else x for x in re.split(r"(\d+)", s[0])]):
        starts.append((name, start))
        start += n
    offsets = sheet.sparkSession.createDataFrame(starts, "__file string, __start long")
    joined = placed.join(F.broadcast(offsets), "__file")
    return joined.withColumn(row_col, F.col("__start") + F.col("__at")).drop("__file", "__start", "__at")


RESULT_SCHEMA = (
    "liasse_numero string, nace2025 string, nace08_valid string, confidence double, "
    "model string, run_id string, shard string, codable boolean"
)


def read_runs(spark: SparkSession, root: str, runs: Mapping[str, Sequence[str]], schema: str = RESULT_SCHEMA) -> DataFrame:
    """Results of chosen runs of chosen models.

    Only the published version of every shard of the runs asked for is listed and
    read, so other runs cost nothing and half-written ones are never seen.  The
    schema is given so ``codable`` reads back as a boolean.  ``model`` holds the
    names asked for, with their slashes.
    """
    folders = {m: path_name(m) for m in runs}
    if len(set(folders.values())) < len(folders):
        raise ValueError(f"models of one folder name cannot be told apart: {sorted(folders)}")
    root = root.rstrip("/")
    paths = []
    for m, ids in runs.items():
        for run in dict.fromkeys(f"{root}/model={folders[m]}/run_id={i}" for i in ids):
            for shard in children(spark, run):
                if shard.startswith("shard="):
                    paths.append(current(spark, f"{run}/{shard}") or f"{run}/{shard}")
    if not paths:
        return spark.createDataFrame([], schema)
    read = spark.read.schema(schema + ", version string").option("basePath", root).parquet(*paths).drop("version")
    renamed = {folder: m for m, folder in folders.items() if folder != m}
    return read.replace(renamed, subset="model") if renamed else read


def read_files_matching(spark: SparkSession, root: str, stamps: Sequence[str], schema: str | None = None) -> DataFrame:
    """S4 (existing datasets): rows of the files under ``root`` whose path contains one of ``stamps``.

    For result folders written with the run stamp in the file name rather than
    as a partition column.  The filter is on the file-metadata column, so no
    file listing happens on the driver beyond Spark's own.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.option("recursiveFileLookup", "false").parquet(root)
    if not stamps:
        return df.limit(0)
    path = F.col("_metadata.file_path")
    return df.filter(reduce(lambda a, b: a | b, [path.contains(s) for s in stamps]))


def attach_collection(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """An embeddings collection ``(code, model, vector, ...)`` and its single model name.

    ``path``: a folder of vectors, or the root of a collection built incrementally.

    Reads one aggregated row; raises unless exactly one model produced the vectors.
    """
    df = spark.read.parquet(current(spark, path) or path)
    row = df.agg(F.count_distinct("model").alias("n"), F.min("model").alias("m")).first()
    if row is None or row["n"] != 1:
        raise RuntimeError(f"collection {path} must hold vectors of exactly one model")
    return df, row["m"]
