"""Conversation prefix trie, rolled up by centroid decomposition.

Every conversation is a sequence of turns; conversations that begin alike share
the nodes of a trie.  Subtree totals (leaves, tokens saved) must not climb the
trie turn by turn: a conversation may be as long as a third of all rows.

1. Turns are digested, then range partitioned by (conversation, place) and sorted,
   so that a long conversation spans partitions.  A rolling hash modulo a prime of
   127 bits names every prefix; hashes concatenate, so a partition starts at zero
   and the totals of the partitions before it are added afterwards.
2. A node is the hash of its prefix; its number is (smallest member, depth).  The
   nodes with one smallest member form a chain, which ends where that conversation
   does, so the nodes below a node are those of its members' chains, less the part
   of the owner's chain above it: component sizes come from one aggregation.
3. The forest of parent edges starts as one component.  While a component has more
   than ``task_nodes`` nodes, Spark splits it at its centroid, the deepest node with
   over half of the component below it.  The nodes with over half below them are
   the path from the centroid to the component's top, so no pointer is chased.
   Which piece a node falls into is a join of its smallest member with the children
   of the centroid.  Components so halve; smaller ones go whole to one task, which
   goes on splitting them the same way.
4. Backwards, a centroid's total is its own value and the totals of the components
   below it; it is added along the path to the component's top.

Every join whose many-rows side may hold a hot conversation is keyed by
(conversation, run of ``SEGMENT`` places), so no key holds more rows than that.
"""

from __future__ import annotations

import hashlib
import zlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recoda.llm.common import batch, map_batches, stored
from recoda.session import sized_broadcast

PRIME, BASE = 2**127 - 1, 0x5BD1E9955BD1E9955BD1E9955BD1E995
ROOT = bytes(16)
SEGMENT = 1 << 16  # places of one conversation that may share a join key
FAMILY, HEADS = 5, 9  # fixed values: conversations of a family; own turns replaced are below this


def _segment(place: Column) -> Column:
    return F.shiftright(place, SEGMENT.bit_length() - 1)


def _segments(df: DataFrame, length: Column) -> DataFrame:
    """One row per run of places up to ``length``."""
    return df.withColumn("seg", F.explode(F.sequence(F.lit(0).cast("long"), _segment(length))))


# -- 1: prefixes


def _prefixes(turns: DataFrame) -> DataFrame:
    """conv, i (from 1), h and before (hashes of the first i and i-1 turns), bytes."""
    spark = turns.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.monotonically_increasing_id()
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest")]
    ranged = turns.withColumn("tie", tie).repartitionByRange(parts, *order, F.col("tie")).sortWithinPartitions(*order)
    ranged = ranged.select("conv", "digest", "bytes", F.spark_partition_id().alias("part"))

    def roll(batches):
        conv, i, h = None, 0, 0
        for rows in batches:
            places, hashes, befores = [], [], []
            for c, digest in zip(rows.column("conv").to_pylist(), rows.column("digest").to_pylist(), strict=True):
                if c != conv:
                    conv, i, h = c, 0, 0
                befores.append(h.to_bytes(16, "big"))
                i, h = i + 1, (h * BASE + int.from_bytes(digest, "big") + 1) % PRIME
                places.append(i)
                hashes.append(h.to_bytes(16, "big"))
            kept = {c: rows.column(c) for c in ("conv", "bytes", "part")}
            yield batch(**kept, i=("int64", places), h=("binary", hashes), before=("binary", befores))

    # within the partition; stored, so that the partitions are the same ones from here on
    held = stored(map_batches(ranged, roll, "conv long, bytes long, part int, i long, h binary, before binary"), "prefixes")
    # one row per partition: its first and last conversation, and how far the last one got
    ends = held.groupBy("part").agg(
        F.min("conv").alias("first"), F.max("conv").alias("last"), F.max_by("h", F.struct("conv", "i")).alias("h"),
        F.max(F.struct("conv", "i"))["i"].alias("i"),
    )
    carried: dict[int, tuple[int, int, int]] = {}
    last, places, total = None, 0, 0
    for e in sorted(ends.collect(), key=lambda e: e["part"]):
        if e["first"] == last:
            carried[e["part"]] = (last, places, total)
        if e["first"] != last or e["last"] != last:
            places, total = 0, 0
        last, places = e["last"], places + e["i"]
        total = (total * pow(BASE, e["i"], PRIME) + int.from_bytes(e["h"], "big")) % PRIME
    known = spark.sparkContext.broadcast(carried)

    def shift(batches):
        for rows in batches:
            columns = [rows.column(c).to_pylist() for c in ("part", "conv", "i", "h", "before")]
            places, hashes, befores = [], [], []
            for part, conv, i, h, before in zip(*columns, strict=True):
                first, more, total = known.value.get(part, (None, 0, 0))
                if first == conv:
                    ahead = total * pow(BASE, i - 1, PRIME) % PRIME
                    before = ((int.from_bytes(before, "big") + ahead) % PRIME).to_bytes(16, "big")
                    h = ((int.from_bytes(h, "big") + ahead * BASE) % PRIME).to_bytes(16, "big")
                    i += more
                places.append(i)
                hashes.append(h)
                befores.append(before)
            yield batch(
                conv=rows.column("conv"), i=("int64", places), h=("binary", hashes), before=("binary", befores),
                bytes=rows.column("bytes"),
            )

    return map_batches(held, shift, "conv long, i long, h binary, before binary, bytes long")


def _replaced(conv: int) -> int:
    return zlib.crc32(str(conv).encode()) % HEADS


def rebuilt_turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations, and the conversations (conv, len).

    A turn: conv, depth, len (of its conversation), node and parent (prefix
    hashes), bytes.  The first turns come from the family's first conversation.
    """
    who, body = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    framed = F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, body)
    turns = conversations.select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"),
        F.unhex(F.substring(F.sha2(F.encode(framed, "UTF-8"), 256), 1, 30)).alias("digest"),
        F.octet_length(body).cast("long").alias("bytes"),
    ).filter("conv IS NOT NULL")
    own = stored(_prefixes(turns), "own-prefixes")
    rest = F.col("conv") % FAMILY
    head = F.when(F.col("i") < HEADS, F.struct("conv", "i", "h", "before", "bytes"))
    others = range(1 - FAMILY, FAMILY)  # remainders, below zero for ids below zero
    families = own.groupBy((F.col("conv") - rest).alias("base")).agg(
        F.collect_list(head).alias("heads"), *[F.max(F.when(rest == r, F.col("i"))).alias(f"n{r}") for r in others]
    )

    def rebuild(batches):
        import pyarrow as pa

        for rows in batches:
            lengths = list(zip(*[rows.column(f"n{r}").to_pylist() for r in others], strict=True))
            out = []
            for base, heads, sizes in zip(rows.column("base").to_pylist(), rows.column("heads").to_pylist(), lengths, strict=True):
                at = {(x["conv"], x["i"]): x for x in heads}
                for r, n in zip(others, sizes, strict=True):
                    if n is None:
                        continue
                    conv, cut = base + r, _replaced(base + r)
                    first = [at[base, i] for i in range(1, cut + 1) if (base, i) in at]
                    shift = int.from_bytes(first[-1]["h"], "big") if first else 0
                    if 0 < cut < n:
                        shift -= int.from_bytes(at[conv, cut]["h"], "big")
                    taken = [{"depth": d, "node": x["h"], "parent": x["before"], "bytes": x["bytes"]} for d, x in enumerate(first, 1)]
                    out.append((conv, len(first), cut, len(first) + max(0, n - cut), (shift % PRIME).to_bytes(16, "big"), taken, n))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(one), pa.int64()]
            columns = zip(*out, strict=True) if out else [[]] * len(kinds)
            made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(made, names=["conv", "taken", "cut", "len", "shift", "heads", "n"])

    import pyarrow as pa

    one = pa.struct([("depth", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("bytes", pa.int64())])
    schema = (
        "conv long, taken long, cut long, len long, shift binary, "
        "heads array<struct<depth: long, node: binary, parent: binary, bytes: long>>, n long"
    )
    plans = stored(map_batches(families, rebuild, schema), "rebuilt")
    heads = plans.select("conv", "len", F.explode("heads").alias("t")).select("conv", "len", "t.*")
    tails = _segments(plans.filter("n > cut").select("conv", "taken", "cut", "len", "shift", "n"), F.col("n")).drop("n")
    tails = own.withColumn("seg", _segment(F.col("i"))).join(tails, ["conv", "seg"]).filter(F.col("i") > F.col("cut"))

    def shifted(batches):
        for rows in batches:
            columns = [rows.column(c).to_pylist() for c in ("i", "cut", "taken", "shift", "h", "before")]
            depths, nodes, parents = [], [], []
            for i, cut, taken, shift, h, before in zip(*columns, strict=True):
                ahead = int.from_bytes(shift, "big") * pow(BASE, i - cut - 1, PRIME) % PRIME
                depths.append(taken + i - cut)
                parents.append(((int.from_bytes(before, "big") + ahead) % PRIME).to_bytes(16, "big"))
                nodes.append(((int.from_bytes(h, "big") + ahead * BASE) % PRIME).to_bytes(16, "big"))
            yield batch(
                conv=rows.column("conv"), len=rows.column("len"), depth=("int64", depths), node=("binary", nodes),
                parent=("binary", parents), bytes=rows.column("bytes"),
            )

    names = ["conv", "len", "depth", "node", "parent", "bytes"]
    tails = map_batches(tails, shifted, "conv long, len long, depth long, node binary, parent binary, bytes long")
    turns = stored(heads.select(names).unionByName(tails), "trie-turns")
    return turns, plans.select("conv", "len")


# -- 2: nodes


def trie_nodes(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """node, parent, conv, depth, parent_conv, n_convs, size (nodes of its subtree), leaf, saved, comp (one, so far)."""
    owners = turns.groupBy("node").agg(F.min("conv").alias("conv"), F.max("depth").alias("depth"))
    chains = owners.groupBy("conv").agg(F.count(F.lit(1)).alias("own"), F.min("depth").alias("start"))
    chains = _segments(chains, F.col("start") + F.col("own") - 1)
    known = turns.withColumn("seg", _segment(F.col("depth"))).join(chains, ["conv", "seg"], "left")
    size = F.coalesce(F.sum("own"), F.lit(0)) - (F.max("depth") - F.min_by("start", "conv"))
    nodes = known.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("conv").alias("conv"), F.max("depth").alias("depth"),
        F.min_by("start", "conv").alias("start"), F.count(F.lit(1)).alias("n_convs"), size.alias("size"),
        ((F.count(F.lit(1)) - 1) * F.max("bytes")).alias("saved"),
    )
    nodes = stored(nodes, "trie-nodes")
    least, n_convs = convs.agg(F.min("conv"), F.count(F.lit(1))).first()
    root = nodes.agg((F.count(F.lit(1)) + 1).alias("size")).filter(F.lit(n_convs > 0)).select(
        F.lit(bytearray(ROOT)).alias("node"), F.lit(None).cast("binary").alias("parent"),
        F.lit(least).cast("long").alias("conv"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv"), F.lit(n_convs).cast("long").alias("n_convs"), "size",
        F.lit(0).cast("long").alias("saved"),
    )
    # a chain's nodes have their parents in it, but for its first; most of those hang on the root
    first, on_root = F.col("depth") == F.col("start"), F.col("parent") == F.lit(bytearray(ROOT))
    inner = nodes.filter(~first).withColumn("parent_conv", F.col("conv"))
    upper = nodes.filter(first & on_root).withColumn("parent_conv", F.lit(least).cast("long"))
    names = nodes.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv"))
    hung = nodes.filter(first & ~on_root).join(names, "parent")
    every = reduce(DataFrame.unionByName, [x.drop("start") for x in (inner, upper, hung)] + [root])
    return stored(every.select("*", (F.col("size") == 1).cast("long").alias("leaf"), F.lit(bytearray(ROOT)).alias("comp")), "trie")


# -- 3 and 4: centroid decomposition


def centroid_rollup(parents: list[int], sizes: list[int], values: list[tuple]) -> list[tuple]:
    """Subtree totals of one component: ``parents`` are positions (the top is first, -1), ``values`` pairs."""
    kids: list[list[int]] = [[] for _ in parents]
    for i, p in enumerate(parents):
        if p >= 0:
            kids[p].append(i)
    size, when = list(sizes), [-1] * len(parents)  # when: number of the split that took the node as its centroid
    splits, todo = [], [0]
    while todo:
        top = c = todo.pop()
        path, whole = [], size[top]
        while True:
            heavy = next((x for x in kids[c] if when[x] < 0 and 2 * size[x] > whole), None)
            if heavy is None:
                break
            path.append(c)
            c = heavy
        for v in path:
            size[v] -= size[c]
        when[c] = len(splits)
        splits.append((c, path))
        todo += [x for x in kids[c] if when[x] < 0]
        if path:
            todo.append(top)
    totals: list[tuple] = [(0, 0)] * len(parents)
    for at in range(len(splits) - 1, -1, -1):  # all pieces of a component come after it
        c, path = splits[at]
        leaf, saved = values[c]
        for x in kids[c]:
            if when[x] > at:
                leaf, saved = leaf + totals[x][0], saved + totals[x][1]
        totals[c] = (leaf, saved)
        for v in path:
            totals[v] = (totals[v][0] + leaf, totals[v][1] + saved)
    return totals


def _roll_up_small(state: DataFrame) -> DataFrame:
    """node, parent, leaf, saved: totals within components, each of which fits one task."""
    parts = int(state.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ["comp", "node", "parent", "depth", "size", "leaf", "saved"]
    dealt = state.select(columns).repartition(parts, "comp").sortWithinPartitions("comp", "depth")

    def roll(batches):
        out: list[tuple] = []
        held: list[tuple] = []

        def finish():
            if len(held) == 1:
                out.append((held[0][1], held[0][2], held[0][5], held[0][6]))
            elif held:
                at = {row[1]: k for k, row in enumerate(held)}
                parents = [-1] + [at[row[2]] for row in held[1:]]
                totals = centroid_rollup(parents, [row[4] for row in held], [(row[5], row[6]) for row in held])
                out.extend((row[1], row[2], a, b) for row, (a, b) in zip(held, totals, strict=True))
            held.clear()

        def flush():
            node, parent, leaf, saved = zip(*out, strict=True)
            out.clear()
            return batch(node=("binary", node), parent=("binary", parent), leaf=("int64", leaf), saved=("int64", saved))

        for rows in batches:
            for row in zip(*[rows.column(c).to_pylist() for c in columns], strict=True):
                if held and held[0][0] != row[0]:
                    finish()
                    if len(out) >= 10_000:
                        yield flush()
                held.append(row)
        finish()
        if out:
            yield flush()

    return map_batches(dealt, roll, "node binary, parent binary, leaf long, saved long")


def subtree_totals(nodes: DataFrame, turns: DataFrame, task_nodes: int) -> DataFrame:
    """node, n_leaves, saved_tokens: ``leaf`` and ``saved`` summed over every node's subtree."""
    names = ["node", "parent", "conv", "depth", "size", "leaf", "saved", "comp"]
    active = nodes.select(names)
    ready: list[DataFrame] = []
    rounds: list[tuple[DataFrame, DataFrame]] = []  # centroids, paths
    while True:
        # at most (number of nodes) / task_nodes components are that large
        large = active.filter((F.col("node") == F.col("comp")) & (F.col("size") > task_nodes))
        large = stored(large.select("comp", F.col("size").alias("whole")), "components")
        if not large.take(1):
            break
        marked = active.join(sized_broadcast(large), "comp", "left")
        ready.append(marked.filter("whole IS NULL").select(names))
        split = marked.filter("whole IS NOT NULL")
        heavy = split.filter(2 * F.col("size") > F.col("whole"))
        least = heavy.groupBy("comp").agg(F.min_by(F.struct("node", "parent", "depth", "size", "leaf", "saved"), "size").alias("c"))
        centroids = stored(least.select("comp", "c.*"), "centroids")
        cut = centroids.select("comp", F.col("node").alias("c"), F.col("depth").alias("c_depth"), F.col("size").alias("c_size"))
        at_cut = sized_broadcast(cut)
        path = heavy.join(at_cut, "comp").filter(F.col("node") != F.col("c")).select("node", "parent", "c")
        rounds.append((centroids, stored(path, "paths")))
        # the members of a centroid go on through one of its children
        below = turns.select("conv", "len", F.col("parent").alias("c"), F.col("node").alias("piece"))
        below = _segments(below.join(at_cut, "c").select("conv", "comp", "len", "piece"), F.col("len")).drop("len")
        below = stored(below, "below-centroids")
        keyed = stored(split.join(at_cut, "comp").filter(F.col("node") != F.col("c")).withColumn("seg", _segment(F.col("depth"))), "split")
        moved = keyed.join(below, ["conv", "comp", "seg"], "left")
        under = F.col("piece").isNotNull() & (F.col("depth") > F.col("c_depth"))
        shrunk = F.when(2 * F.col("size") > F.col("whole"), F.col("size") - F.col("c_size")).otherwise(F.col("size"))
        active = moved.select(
            "node", "parent", "conv", "depth", shrunk.alias("size"), "leaf", "saved",
            F.when(under, F.col("piece")).otherwise(F.col("comp")).alias("comp"),
        )
        active = stored(active, "pieces")
    ready.append(active)
    parts = [stored(_roll_up_small(reduce(DataFrame.unionByName, ready)), "small-components")]
    for centroids, path in reversed(rounds):
        own = centroids.select(F.col("node").alias("c"), "leaf", "saved")
        tops = reduce(DataFrame.unionByName, parts).select(F.col("parent").alias("c"), "leaf", "saved")
        tops = tops.join(sized_broadcast(centroids.select(F.col("node").alias("c"))), "c")
        total = own.unionByName(tops).groupBy("c").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
        total = stored(total, "centroid-totals")
        parts.append(total.join(centroids.select(F.col("node").alias("c"), "parent"), "c").withColumnRenamed("c", "node"))
        parts.append(path.join(sized_broadcast(total), "c").drop("c"))
    every = reduce(DataFrame.unionByName, parts)
    return every.groupBy("node").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def _ends(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """node, ends_sha256: over the conversations that end there, in order, one at a time.

    A digest is sequential, so a node's conversations go through one task; they are
    sorted (with spill) and streamed, never gathered.
    """
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = turns.filter("depth = len").select("node", "conv")
    last = last.unionByName(convs.filter("len = 0").select(F.lit(bytearray(ROOT)).alias("node"), "conv"))
    dealt = last.repartition(parts, "node").sortWithinPartitions("node", "conv")

    def digest(batches):
        node, state, done = None, None, []
        for rows in batches:
            for n, conv in zip(rows.column("node").to_pylist(), rows.column("conv").to_pylist(), strict=True):
                if n != node:
                    if state:
                        done.append((node, state.hexdigest()))
                    node, state = n, hashlib.sha256(str(conv).encode())
                else:
                    state.update(b",%d" % conv)
            if len(done) >= 10_000:
                yield pairs(done)
                done = []
        if state:
            yield pairs([*done, (node, state.hexdigest())])

    def pairs(done):
        nodes, digests = zip(*done, strict=True)
        return batch(node=("binary", nodes), ends_sha256=("string", digests))

    return map_batches(dealt, digest, "node binary, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    task_nodes: int = 50_000,
) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: one row per node.

    Conversations are rebuilt first: conversation c begins with the first h turns
    of conversation c - c % 5 (h: CRC-32 of c mod 9), then come its own turns after
    its first h.  Turns are ordered by ``turn``, nulls first; turns equal in that, by
    a digest of role and text (equal rows are turns of their own).  A null role or
    text is empty.  Rows without a conversation id belong to no conversation and
    are left out.  An empty table has no nodes, not even a root.
    """
    turns, convs = rebuilt_turns(conversations, conv_id, turn, role, text)
    nodes = trie_nodes(turns, convs)
    totals = subtree_totals(nodes, turns, task_nodes)
    children = nodes.groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children")).filter("node IS NOT NULL")
    empty = hashlib.sha256(b"").hexdigest()
    joined = nodes.join(totals, "node").join(children, "node", "left").join(_ends(turns, convs), "node", "left")
    return joined.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )
