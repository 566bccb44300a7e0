"""SimHash near-copies through a Gray-order hierarchical index.

A fingerprint's bit is set when it is set in over half of the shingle hashes.
Distinct fingerprints that differ in at most ``max_bits`` bits are linked, and
documents linked directly or through others form one component.

Search: fingerprints are cut into segments.  Two that differ in ``max_bits`` bits
or fewer agree on at least ``segments - max_bits`` whole segments, so routing
every fingerprint once per choice of that many segments brings each linked pair
together, exactly.  In a task the fingerprints of every route are sorted by
Gray rank and put into a tree: a node keeps the bits all its members share.  The
tree is searched against itself from the root: a pair of nodes is dropped when
its shared bits already differ in more than ``max_bits`` places, taken whole when
it cannot differ in more, and opened otherwise.  Only a spanning forest of the
links leaves a task, never the pairs.

A route with many fingerprints (a large family of near copies) is cut into
blocks, and pairs of blocks become routes of their own, so no task holds it
whole.  Only thin rows move: fingerprints are grouped before they are routed,
so copies of any number count once.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from recoda.llm.common import batch, map_batches, stored, strings

FANOUT = 8


def simhash(text: str, shingle: int = 4, seed: int = 42) -> int:
    """64-bit fingerprint (unsigned): A-Z lowered, words between ASCII white space, XXH64 of the shingles."""
    import numpy as np
    import xxhash

    lowered = text.encode().lower()  # bytes: only A-Z change
    words = lowered.split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    hashes = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def gray_rank(codes):
    """Place of each code in the Gray sequence."""
    import numpy as np

    out = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(s)
    return out


def _bits(x):
    import numpy as np

    return np.bitwise_count(x).astype(np.int64)


class Forest:
    """Components of the links found so far (vectorised union by smallest member)."""

    def __init__(self, n: int):
        import numpy as np

        self.root = np.arange(n)

    def link(self, a, b) -> None:
        import numpy as np

        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def gray_tree(codes, groups):
    """Levels of (shared mask, shared bits, first child, end child, first leaf, end leaf), leaves first.

    ``codes`` are sorted by (group, Gray rank); no node spans two groups; the last
    level has one node per group.
    """
    import numpy as np

    n = len(codes)
    span = np.arange(n + 1)
    levels = [(np.full(n, 2**64 - 1, np.uint64), codes, None, None, span[:-1], span[1:])]
    group = groups
    while len(np.unique(group)) < len(group):
        mask, bits, *_, leaf, leaf_end = levels[-1]
        first = np.concatenate([[True], group[1:] != group[:-1]])
        begin = np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
        heads = np.flatnonzero((np.arange(len(group)) - begin) % FANOUT == 0)
        ends = np.concatenate([heads[1:], [len(group)]])
        parent = np.repeat(np.arange(len(heads)), ends - heads)
        differs = np.bitwise_or.reduceat(bits ^ bits[heads][parent], heads)
        shared = np.bitwise_and.reduceat(mask, heads) & ~differs
        levels.append((shared, bits[heads] & shared, heads, ends, leaf[heads], leaf_end[ends - 1]))
        group = group[heads]
    return levels


def link_codes(codes, groups, max_bits: int, chunk: int = 200_000):
    """Root position of every code: codes of one group within ``max_bits`` are linked.

    ``codes`` (unsigned, distinct within a group) come sorted by (group, Gray rank).
    Works depth first on runs of ``chunk`` node pairs, so memory stays bounded;
    node pairs whose leaves are already one component are not opened.
    """
    import numpy as np

    forest = Forest(len(codes))
    if not len(codes):
        return forest.root
    levels = gray_tree(codes, groups)
    top = np.arange(len(levels[-1][0]))
    todo = [(len(levels) - 1, top[i : i + chunk], top[i : i + chunk]) for i in range(0, len(top), chunk)]
    while todo:
        level, a, b = todo.pop()
        mask, bits, child, child_end, leaf, leaf_end = levels[level]
        both = mask[a] & mask[b]
        least = _bits((bits[a] ^ bits[b]) & both)
        near = least <= max_bits
        a, b, least, both = a[near], b[near], least[near], both[near]
        most = least + 64 - _bits(both)
        whole = most <= max_bits
        if whole.any():  # every leaf of both is in reach of every other: a star links them
            ends = [(leaf[x[whole]], leaf_end[x[whole]]) for x in (a, b)]
            for begin, end in ends:
                size = end - begin
                hub = np.repeat(ends[0][0], size)
                spoke = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begin, size)
                forest.link(hub, spoke)
        a, b = a[~whole], b[~whole]
        if not level or not len(a):
            continue
        # opened no more when both sides are one component already
        low = np.minimum.reduceat(forest.root, leaf)
        high = np.maximum.reduceat(forest.root, leaf)
        # reduceat runs to the next node's first leaf, which is this node's end: nodes of a level are gapless
        one = (low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b])
        a, b = a[~one], b[~one]
        na, nb = child_end[a] - child[a], child_end[b] - child[b]
        size = na * nb
        bounds = np.searchsorted(np.cumsum(size), np.arange(chunk, size.sum() + chunk, chunk))
        at = 0
        for stop in np.unique(np.minimum(bounds + 1, len(a))):
            pa, pb, s, m = a[at:stop], b[at:stop], size[at:stop], nb[at:stop]
            at = stop
            nth = np.arange(s.sum()) - np.repeat(np.cumsum(s) - s, s)
            m = np.repeat(m, s)
            ca, cb = np.repeat(child[pa], s) + nth // m, np.repeat(child[pb], s) + nth % m
            once = ca <= cb
            if once.any():
                todo.append((level - 1, ca[once], cb[once]))
    return forest.root


def segment_masks(segments: int, equal: int) -> list[int]:
    """Masks of every choice of ``equal`` of the 64 bits' ``segments`` near-equal segments."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    parts = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(cuts, cuts[1:], strict=False)]
    return [sum(c) for c in combinations(parts, equal)]


def routing(n: int, max_bits: int, group_size: int = 2_000) -> list[int]:
    """Segment masks for ``n`` fingerprints: the least copies whose routes hold about ``group_size`` at random."""
    for equal in range(1, 5):
        masks = segment_masks(max_bits + equal, equal)
        if n >> min(m.bit_count() for m in masks) <= group_size:
            break
    return masks


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def fingerprint_links(codes: DataFrame, max_bits: int, block: int = 1_000) -> DataFrame:
    """A spanning forest (u, v) of the links among the distinct signed fingerprints in ``codes.fp``."""
    masks = routing(codes.count(), max_bits)
    routes = codes.select(
        "fp",
        F.explode(
            F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(_signed(m)).alias("v")) for k, m in enumerate(masks)])
        ).alias("r"),
    ).select("fp", F.col("r.k").alias("k"), F.col("r.v").alias("v"))
    sizes = routes.groupBy("k", "v").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    blocks = F.ceil(F.col("m") / block).cast("int")
    sizes = sizes.select("k", "v", F.when(F.col("m") > 2 * block, blocks).otherwise(1).alias("p"))
    placed = routes.join(sizes, ["k", "v"])  # routes of one fingerprint alone end here
    own = F.pmod(F.xxhash64("fp"), F.col("p")).cast("int")
    # one block: the route itself; else a route for this block with every other one
    partners = F.when(F.col("p") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("p") - 1), lambda j: j != own)
    )
    cells = placed.select("fp", "k", "v", own.alias("i"), F.explode(partners).alias("j")).select(
        "fp", F.xxhash64("k", "v", F.least("i", "j"), F.greatest("i", "j")).alias("route")
    )
    parts = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cells.repartition(parts, "route")

    def search(batches):
        import numpy as np
        import pyarrow as pa

        table = pa.Table.from_batches(list(batches)) if batches else None
        if table is None or not table.num_rows:
            return
        fp, route = table.column("fp").to_numpy(), table.column("route").to_numpy()
        code = fp.view(np.uint64)
        order = np.lexsort((gray_rank(code), route))
        code, route = code[order], route[order]
        # routes are told apart by a hash; if two ever shared one, a code could come twice: a link to itself
        root = link_codes(code, route, max_bits)
        moved = np.flatnonzero(root != np.arange(len(root)))
        yield batch(u=code[moved].view(np.int64), v=code[root[moved]].view(np.int64))

    def guarded(batches):
        yield from search(list(batches))

    return map_batches(dealt, guarded, "u long, v long").filter("u != v").distinct()


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node with a link; root is the component's smallest node.

    Alternating large-star and small-star steps: each is one partially aggregated
    minimum and one join on the node; the links are stored after every round, so
    lineage stays short.  Ends when a round changes nothing.
    """

    def digest(edges):
        r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(r)

    def star(edges, large: bool):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        sides = both if large else both.filter("u > v")
        least = sides.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        joined = sides.join(least, "u")
        if large:
            return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        hooks = joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return hooks.union(least.select("u", F.col("m").alias("v"))).distinct()

    edges = stored(links.select("u", "v").filter("u != v"), "links")
    before = digest(edges)
    for _ in range(rounds):
        if not before[0]:
            break
        edges = stored(star(star(edges, True), False), "stars")
        now = digest(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def _components(prints: DataFrame, max_bits: int) -> DataFrame:
    """(fp, component_id) of every fingerprint of ``prints`` (doc_id, fp)."""
    codes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "codes")
    roots = connected_components(fingerprint_links(codes.select("fp"), max_bits))
    named = codes.join(roots, codes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return named.join(least, "root").select(F.col("fp").alias("of_fp"), "component_id")


def fingerprints(docs: DataFrame, shingle: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp (signed 64-bit) per row; a null text has no words."""

    def hash_rows(batches):
        for rows in batches:
            codes = [_signed(simhash(t, shingle)) for t in strings(rows.column("text"))]
            yield batch(doc_id=rows.column("doc_id"), fp=("int64", codes))

    thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = thin.schema["doc_id"].dataType.simpleString()
    return map_batches(thin, hash_rows, f"doc_id {kind}, fp long")


def simhash_components(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest id reachable): one row per input row.

    Null, empty and wordless texts have fingerprint zero and link like any other.
    A text shorter than a shingle is one shingle.  Null ids never name a
    component unless it has no other id (then null).  Repeated rows stay; an
    empty table gives no rows.
    """
    prints = stored(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    joined = prints.join(_components(prints, max_bits), F.col("fp") == F.col("of_fp"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return joined.select("doc_id", digits.alias("fingerprint"), "component_id")


def drop_near_copies(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of every component stays, unchanged: the first by id, then by a stored row number.

    Rows of equal id are told apart by that number, so exactly one row remains
    per component; null ids come last.
    """

    names = docs.columns

    def hash_rows(batches):
        for rows in batches:
            codes = [_signed(simhash(t, shingle)) for t in strings(rows.column(text))]
            yield batch(**{c: rows.column(c) for c in names}, __fp=("int64", codes))

    schema = StructType([*docs.schema.fields, StructField("__fp", LongType())])
    held = stored(
        map_batches(docs.select("*"), hash_rows, schema).withColumn("__row", F.monotonically_increasing_id()), "near"
    )
    thin = held.select(F.col(doc_id).alias("doc_id"), F.col("__fp").alias("fp"), F.col("__row").alias("row"))
    codes = stored(thin.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")), "codes")
    roots = connected_components(fingerprint_links(codes.select("fp"), max_bits))
    named = codes.join(roots, codes["fp"] == roots["node"], "left")
    firsts = named.groupBy(F.coalesce("root", "fp").alias("c")).agg(F.min("first").alias("f"))
    keep = firsts.select(F.col("f.row").alias("__keep"))
    return held.join(keep, F.col("__row") == F.col("__keep"), "left_semi").select(*docs.columns)
