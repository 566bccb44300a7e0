"""Reproducible global shuffle: a Feistel permutation of global row numbers.

Rows get a global number from their content order (id, then size and checksum),
a keyed Feistel network with cycle walking permutes ``0 .. n-1``, and shard and
slot follow from the permuted number alone: ``shard = p % shards`` and
``slot = p // shards``.  So shard sizes are at most one apart, slots have no
gaps, and anyone who knows ``n``, the seed and a row's number can compute its
place, or invert it, without the data.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoda.llm.common import batch, map_batches, stored

ROUNDS = 4


def feistel(numbers, n: int, seed: int = 0, inverse: bool = False):
    """Permute an array of row numbers below ``n`` (numpy, vectorised).

    A balanced network of ``ROUNDS`` rounds over the smallest even bit width
    that holds ``n``; a result at or above ``n`` is permuted again until it
    falls below (cycle walking), which keeps the map a bijection of 0..n-1.
    The domain is under 4n, so four steps are expected per number.
    """
    import numpy as np

    half = max(1, ((max(n - 1, 1)).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    shift = np.uint64(half)
    keys = [np.uint64(zlib.crc32(f"{seed}:{r}".encode()) * 0x9E3779B97F4A7C15 % 2**64) for r in range(ROUNDS)]

    def mix(x, key):
        x = (x + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9) + key
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(32))) & mask

    def once(x):
        left, right = x >> shift, x & mask
        for key in reversed(keys) if inverse else keys:
            if inverse:
                left, right = right ^ mix(left, key), left
            else:
                left, right = right, left ^ mix(right, key)
        return (left << shift) | right

    with np.errstate(over="ignore"):
        out = once(np.asarray(numbers, np.uint64))
        outside = np.flatnonzero(out >= np.uint64(n))
        while outside.size:
            out[outside] = once(out[outside])
            outside = outside[out[outside] >= np.uint64(n)]
    return out.astype(np.int64)


def numbered(df: DataFrame, order: list[str], number: str = "row_no") -> tuple[DataFrame, int]:
    """``df`` with gapless global numbers in the order of ``order``; and the row count.

    Rows are range partitioned on the order (rows equal in all of it are
    interchangeable and spread by a tie column, so no value can fill one task),
    sorted, and stored once in the shared folder; a per-partition count, one
    number per partition, gives the offsets.
    """
    spark = df.sparkSession
    mid = F.monotonically_increasing_id()
    keys = [F.col(c).asc_nulls_first() for c in order]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.withColumn("__tie", mid).repartitionByRange(parts, *keys, F.col("__tie"))
    ranged = ranged.sortWithinPartitions(*keys).drop("__tie")
    layout = stored(
        ranged.withColumn("__part", F.spark_partition_id()).withColumn("__at", mid.bitwiseAND(F.lit((1 << 33) - 1))),
        "numbered",
    )
    sizes = dict(layout.groupBy("__part").count().collect())  # one row per partition
    starts, total = [], 0
    for part in sorted(sizes):
        starts.append((part, total))
        total += sizes[part]
    offsets = spark.createDataFrame(starts, "__part int, __start long")
    placed = layout.join(F.broadcast(offsets), "__part") if starts else layout.withColumn("__start", F.lit(0))
    return placed.withColumn(number, F.col("__start") + F.col("__at")).drop("__part", "__at", "__start"), total


def shard_rows(
    docs: DataFrame,
    shards: int = 40,
    seed: int = 20240501,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_text: bool = False,
) -> DataFrame:
    """Place every row: doc_id, size, text_crc32, law, shard, slot, grown_shard, row_no.

    The law is ``rows``: shard sizes differ by one row at most.  ``size`` is the
    UTF-8 bytes of the text (null: none) plus 16, ``text_crc32`` its CRC (null:
    that of no bytes).  ``grown_shard`` is null: only a key law has one.  Equal
    texts are placed one by one; this law cannot also hold them together.
    Repeated rows, null ids and null texts each get a place of their own; rows
    equal in id, size and checksum may swap places, which no output shows.
    ``keep_text`` adds the text as a last column (it then travels along).
    """
    body = F.coalesce(F.col(text), F.lit(""))
    thin = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + F.lit(16)).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        *([F.col(text).alias("text")] if keep_text else []),
    )
    rows, n = numbered(thin, ["doc_id", "size", "text_crc32"])

    def place(batches):
        for part in batches:
            p = feistel(part.column("row_no").to_numpy(), n, seed)
            kept = dict(zip(part.schema.names, part.columns, strict=True))
            yield batch(**kept, shard=(p % shards).astype("int32"), slot=p // shards)

    kind = thin.schema["doc_id"].dataType.simpleString()
    body_kind = "text string, " if keep_text else ""
    schema = f"doc_id {kind}, size long, text_crc32 long, {body_kind}row_no long, shard int, slot long"
    return map_batches(rows, place, schema).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_no", *(["text"] if keep_text else []),
    )


def write_shards(
    docs: DataFrame, path: str, shards: int = 40, seed: int = 20240501, doc_id: str = "doc_id", text: str = "text"
) -> None:
    """Write the texts as Parquet folders ``shard=<k>``, each in slot order.

    Every shard is cut into slot ranges of their own tasks, so a shard may be
    far larger than a task's memory.
    """
    parts = max(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = shard_rows(docs, shards, seed, doc_id, text, keep_text=True).select("doc_id", "text", "shard", "slot")
    ranged = placed.repartitionByRange(parts, "shard", "slot").sortWithinPartitions("shard", "slot")
    ranged.write.mode("overwrite").partitionBy("shard").parquet(path)
