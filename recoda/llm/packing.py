"""Sum-of-squares packing of tokenised documents into fixed-length sequences.

Documents longer than a sequence are cut (only these), so every piece fits.  The
pieces are then packed by the sum-of-squares rule: with N(g) open sequences of
free space g, a piece goes where the sum of all N(g)^2 becomes smallest.

Pieces carry no text or ids while they are packed, only lengths.  They are dealt
into groups of about ``group_pieces`` by a hash of their stored row number (no
key of the data, so no key can be hot); each group is packed on its own, in
falling length, which with this rule ends within about one sequence of the
bound of total length over capacity.  A group ends with a few part-filled sequences at most, so the
loss against one global packing is bounded by that share of its some thousand
sequences, at any input size.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoda.llm.common import batch, map_batches, slices, stored, strings, worker_state
from recoda.llm.bpe import Encoder


def sum_of_squares(lengths, capacity: int):
    """Bin number and offset of every length (numpy arrays, in the given order).

    Among the open bins with room, the one that makes the sum of squares smallest
    is taken; ties go to the smallest free space left.  A new bin is opened only
    when no open one has room.  A length equal to the capacity fills a bin.
    """
    import numpy as np

    nowhere = np.iinfo(np.int64).max
    counts = np.zeros(capacity + 1, np.int64)  # open bins per free space; 0 and the full capacity stay 0
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    used = 0
    for i, size in enumerate(np.asarray(lengths).tolist()):
        # change of the sum when free space g = size .. capacity is taken:
        # (N(g-size)+1)^2 - N(g-size)^2 + (N(g)-1)^2 - N(g)^2
        have, rest = counts[size:], counts[: capacity + 1 - size]
        cost = 2 * rest - 2 * have + 2
        cost[0] -= 2 * rest[0] + 1  # a bin filled to the end is no longer open
        cost[:-1][have[:-1] == 0] = nowhere
        cost[-1] = nowhere - 1  # a new bin, if no open one has room
        gap = size + int(np.argmin(cost))
        if gap == capacity:
            at, used = used, used + 1
        else:
            at = open_bins[gap].pop()
            counts[gap] -= 1
        bins[i], offsets[i] = at, capacity - gap
        left = gap - size
        if left:
            counts[left] += 1
            open_bins[left].append(at)
    return bins, offsets


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the first one takes the remainder."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def document_pieces(
    docs: DataFrame, tokenizer: str, capacity: int, end_id: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 per piece of every document (null text: empty)."""

    def cut(batches):
        enc = worker_state(("encoder", tokenizer), lambda: Encoder(tokenizer))
        end = end_id.to_bytes(4, "little")
        for rows in batches:
            texts = strings(rows.column("text"))
            for a, b in slices(texts):
                at, piece, start, length, crc = [], [], [], [], []
                for i, flat in zip(range(a, b), enc.encode(texts[a:b]), strict=True):
                    flat += end
                    for k, (s, n) in enumerate(cut_points(len(flat) // 4, capacity)):
                        at.append(i)
                        piece.append(k)
                        start.append(s)
                        length.append(n)
                        crc.append(zlib.crc32(flat[4 * s : 4 * (s + n)]))
                yield batch(
                    doc_id=rows.column("doc_id").take(at_array(at)),
                    piece=("int32", piece),
                    start=("int64", start),
                    length=("int64", length),
                    ids_crc32=("int64", crc),
                )

    def at_array(values):
        import pyarrow as pa

        return pa.array(values, pa.int64())

    thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = thin.schema["doc_id"].dataType.simpleString()
    return map_batches(thin, cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 1024,
    end_id: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    group_pieces: int = 8_000,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece.

    Every document ends with ``end_id``, so an empty or null text is one piece of
    one id.  Repeated rows and null ids are packed as documents of their own.  An
    empty table gives no rows.  Sequence numbers are unique but not dense: group
    number times 2^32 plus the number in the group.
    """
    spark = docs.sparkSession
    cut = document_pieces(docs, tokenizer, capacity, end_id, doc_id, text)
    # stored once: the ids are computed once, and the row numbers that deal the groups are fixed
    pieces = stored(cut.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    n = pieces.filter(F.col("length") < capacity).count()
    groups = max(1, -(-n // group_pieces))
    kind = cut.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def pack(key, rows):
        rows = rows.sort_by([("length", "descending"), ("__row", "ascending")])
        bins, offsets = sum_of_squares(rows.column("length").to_numpy(), capacity)
        out = rows.select(names).append_column("sequence_id", [key[0].as_py() * 2**32 + bins])
        return out.append_column("offset", [offsets])

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    group = F.pmod(F.xxhash64("__row"), F.lit(groups))
    part = pieces.filter(F.col("length") < capacity).withColumn("__group", group)
    packed = part.groupBy("__group").applyInArrow(pack, schema)
    # a piece as long as a sequence is one: nothing to choose
    full = pieces.filter(F.col("length") >= capacity).select(
        *names, (-F.col("__row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(full)


def sequence_ids(
    docs: DataFrame, packed: DataFrame, tokenizer: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The packed sequences themselves: sequence_id, n_docs, ids (array<int>).

    For tables whose ids name one document each.  The pieces of one sequence are
    bounded by its length, so gathering them is too.
    """

    def ids_of(batches):
        import numpy as np

        enc = worker_state(("encoder", tokenizer), lambda: Encoder(tokenizer))
        for rows in batches:
            flats = [b + end_id.to_bytes(4, "little") for b in enc.encode(strings(rows.column("text")))]
            spans = zip(flats, rows.column("start").to_pylist(), rows.column("length").to_pylist(), strict=True)
            cut = [np.frombuffer(f, "<u4")[s : s + n].astype("int32") for f, s, n in spans]
            yield batch(sequence_id=rows.column("sequence_id"), offset=rows.column("offset"), ids=arrays(cut))

    def arrays(values):
        import pyarrow as pa

        return pa.array(values, pa.list_(pa.int32()))

    body = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    placed = packed.join(body, "doc_id").select("sequence_id", "offset", "start", "length", "text")
    cut = map_batches(placed, ids_of, "sequence_id long, offset long, ids array<int>")
    gathered = cut.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return gathered.select(
        "sequence_id",
        F.size("parts").alias("n_docs"),
        F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"),
    )
