"""Q2: the deduplicated set of ambiguous declarations, and its split into shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recoda.functions import constants as K
from recoda.functions.codes import undot
from recoda.operators.dedup import first_per_key, require_nonempty
from recoda.operators.mapping import ambiguous
from recoda.session import scratch_path, sized_broadcast


def ambiguous_workset(
    extraction: DataFrame,
    mapping: DataFrame,
    annotated: DataFrame | None = None,
    order: Sequence[str] = (),
    columns: Sequence[str] = K.EXTRACTION_COLUMNS,
    id_col: str = K.ID,
    code_col: str = K.OLD_CODE,
    attributes: Sequence[str] = K.ATTRIBUTE_COLUMNS,
    check: bool = True,
) -> DataFrame:
    """Rows to send to a model.

    F1: keep rows whose old code is ambiguous (broadcast semi join on the code
    table); F5/J2: optionally only ids present in ``annotated``; D1: one row
    per id (first by ``order`` then every column); D2: one row per combination
    of the nine attributes (first by id).  The order of the two dedups matters
    and the old code is not part of the D2 key.  With ``check``, a mapping
    without any ambiguous code is an error (one-row probe).
    """
    amb = ambiguous(mapping).select("code08")
    if check:
        require_nonempty(amb, "no ambiguous code in the mapping")
    codes = sized_broadcast(amb)
    rows = extraction.join(codes, undot(F.col(code_col)) == codes["code08"], "left_semi")
    if annotated is not None:
        rows = rows.join(annotated.select(id_col), id_col, "left_semi")
    d1_order = list(order) + [c for c in [code_col, *attributes] if c not in order]
    per_id = first_per_key(rows, [id_col], d1_order)
    per_activity = first_per_key(per_id, list(attributes), [id_col])
    return per_activity.select(*columns)


def split_shards(df: DataFrame, key: str = K.ID, shards: int = K.SHARDS, partitions: int | None = None) -> DataFrame:
    """O1 + O2: global position by ``key`` and the shard of every row.

    Shard ``s`` (1-based) holds positions ``[(s-1)*q, s*q)`` with ``q = n // shards``;
    the last shard takes the remainder, and when ``n < shards`` every row is in
    the last shard.  This is not ``ntile``: 8 rows give 2, 2, 4.

    The position is computed without a single-partition window: rows are range
    partitioned and sorted by ``key``; the index inside a partition comes from
    ``monotonically_increasing_id`` (partition id in the upper bits), and a
    tiny table of per-partition counts (one row per partition) supplies the
    offsets.  ``key`` should be unique (the work set's id is).  The tagged rows
    are written once to the session's checkpoint folder and read back.
    """
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, F.col(key)).sortWithinPartitions(key)
    mid = F.monotonically_increasing_id()
    tagged = ranged.withColumn("__pid", F.shiftright(mid, 33)).withColumn(
        "__idx", mid - F.shiftleft(F.shiftright(mid, 33), 33)
    )
    # The range bounds come from a sample; a second evaluation could draw other
    # bounds.  Writing the tagged rows once to the shared checkpoint folder
    # freezes them, so the counts and the rows below see the same layout, and
    # the lineage is cut (an executor loss re-reads the table, not the sample).
    frozen = scratch_path(spark, "shards")
    tagged.write.parquet(frozen)
    tagged = spark.read.parquet(frozen)
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__cnt"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "__pid",
        F.coalesce(F.sum("__cnt").over(before), F.lit(0)).alias("__off"),
        F.sum("__cnt").over(Window.partitionBy()).alias("__n"),
    )
    # one row per partition: bounded by the partition count
    placed = tagged.join(F.broadcast(offsets), "__pid")
    pos = (F.col("__off") + F.col("__idx")).cast("long")
    q = F.floor(F.col("__n") / shards)
    shard = F.when(F.col("__n") < shards, F.lit(shards)).otherwise(
        F.least(F.lit(shards), (F.floor(pos / q) + 1).cast("int"))
    )
    return placed.select(*df.columns, pos.alias("position"), shard.cast("int").alias("shard"))


def write_shards(df: DataFrame, path: str, key: str = K.ID, shards: int = K.SHARDS) -> str:
    """O2 for several jobs: the ordered work set written once, one folder per shard."""
    split_shards(df, key, shards).write.mode("overwrite").partitionBy("shard").parquet(path)
    return path


def read_shard(spark: SparkSession, path: str, shard: int) -> DataFrame:
    """The rows of one shard of ``write_shards`` (other folders are not read)."""
    return spark.read.parquet(path).filter(F.col("shard") == shard).drop("position", "shard")
