"""Ranked lexical search by dual trees: the best documents of every item, exactly.

A document's coordinate for a term is what the term adds to a score before its
weight (whole numbers, so results do not depend on any order of addition); an
item's coordinates are the weights of its terms.  Both sides get a hierarchy whose
nodes hold coordinate maxima.  The product of two nodes' maxima bounds every score
between their members; where it stays below the weakest of the items' k-th scores,
the whole batch of pairs is done with.  Bounds are never below a score and ties are
kept (by document id), so the pruning is exact.

Items are a stated query set, read in blocks of at most ``block_terms`` terms; the
driver and the broadcast hold one block at a time.  For a block, documents are cut
into terms where they lie and only the block's terms are kept (stored, as the
weights need all documents first).  Each task then searches its documents in
batches of bounded size against the block's items and passes on k documents an
item at most; these are ranked once more.  Nothing else is shuffled.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recoda.llm.common import batch, map_batches, stored
from recoda.llm.decontaminate import words_of

LEAF, FAN, ITEM_FAN = 32, 8, 4  # documents of a leaf; children of a node
MATRIX_BYTES = 64 * 1024 * 1024  # coordinate maxima of one batch's leaves
# Fixed values of the score.
SCALE, LENGTH_SHARE = 1_000_000_000, 90


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def item_blocks(items: DataFrame, item_id: str, text: str, block_terms: int) -> Iterator[list[tuple]]:
    """Lists of (item number, item id, terms), each of about ``block_terms`` terms; items without terms are left out."""
    names = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text"))

    def cut(batches):
        import pyarrow as pa

        for rows in batches:
            terms = [sorted(set(words_of(t))) for t in rows.column("text").to_pylist()]
            yield batch(item_id=rows.column("item_id"), terms=pa.array(terms, pa.list_(pa.binary())))

    kind = names.schema["item_id"].dataType.simpleString()
    held, size = [], 0
    for number, row in enumerate(map_batches(names, cut, f"item_id {kind}, terms array<binary>").toLocalIterator()):
        if not row["terms"]:
            continue
        if held and size + len(row["terms"]) > block_terms:
            yield held
            held, size = [], 0
        held.append((number, row["item_id"], [bytes(t) for t in row["terms"]]))
        size += len(row["terms"])
    if held:
        yield held


def document_vectors(docs: DataFrame, numbers: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """doc_id, n (all terms of the document), terms and tfs (those with a number), stored; documents without terms too."""
    known = docs.sparkSession.sparkContext.broadcast(numbers)

    def count(batches):
        import pyarrow as pa

        for rows in batches:
            sizes, terms, tfs = [], [], []
            for t in rows.column("text").to_pylist():
                words = words_of(t)
                found = Counter(map(known.value.get, words))
                found.pop(None, None)
                sizes.append(len(words))
                terms.append(list(found))
                tfs.append(list(found.values()))
            yield batch(
                doc_id=rows.column("doc_id"), n=("int64", sizes), terms=pa.array(terms, pa.list_(pa.int32())),
                tfs=pa.array(tfs, pa.list_(pa.int64())),
            )

    thin = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    vectors = stored(map_batches(thin, count, "doc_id long, n long, terms array<int>, tfs array<long>"), "term-vectors")
    known.unpersist()
    return vectors


# -- trees


class ItemNode:
    """Items ``first`` to ``last`` - 1 and all their terms; a term's coordinate maximum is its weight."""

    def __init__(self, terms, first: int, last: int, children: list[ItemNode]):
        self.terms, self.first, self.last, self.children = terms, first, last, children


def item_tree(terms: list) -> ItemNode:
    """The hierarchy over items given in an order that puts like ones together."""
    import numpy as np

    level = [ItemNode(t, i, i + 1, []) for i, t in enumerate(terms)]
    while len(level) > 1:
        groups = [level[i : i + ITEM_FAN] for i in range(0, len(level), ITEM_FAN)]
        level = [ItemNode(np.unique(np.concatenate([x.terms for x in g])), g[0].first, g[-1].last, g) for g in groups]
    return level[0]


class DocumentTree:
    """Some documents' coordinates, and their maxima for leaves of ``LEAF`` documents and the levels above."""

    def __init__(self, ids, terms, impacts, starts, weights):
        import numpy as np

        n, sizes = len(ids), np.diff(starts)
        # documents with the same rarest term lie side by side, so that a leaf has few high coordinates
        rarest = np.maximum.reduceat(weights[terms] * np.int64(len(weights)) + terms, starts[:-1]) % len(weights)
        order = np.lexsort((ids, rarest))
        at = np.repeat(starts[:-1][order], sizes[order])
        self.starts = np.concatenate([[0], np.cumsum(sizes[order])])
        take = at + np.arange(len(terms)) - np.repeat(self.starts[:-1], sizes[order])
        self.ids, self.terms, self.impacts = ids[order], terms[take], impacts[take]
        leaf = np.repeat(np.arange(n) // LEAF, sizes[order])
        maxima = np.zeros((-(-n // LEAF), len(weights)), np.int32)
        np.maximum.at(maxima, (leaf, self.terms), self.impacts)
        smallest = np.minimum.reduceat(self.ids, np.arange(0, n, LEAF))
        self.levels = [(maxima, smallest)]
        while len(maxima) > 1:
            edges = np.arange(0, len(maxima), FAN)
            maxima, smallest = np.maximum.reduceat(maxima, edges, axis=0), np.minimum.reduceat(smallest, edges)
            self.levels.append((maxima, smallest))


class Search:
    """The best ``k`` documents so far of every item."""

    def __init__(self, root: ItemNode, weights, k: int):
        import numpy as np

        self.root, self.weights, self.k = root, weights, k
        self.best: list[list[tuple[int, int]]] = [[] for _ in range(root.last)]  # heaps of (score, -id)
        self.kth = np.zeros(root.last, np.int64)  # 0: fewer than k yet
        self.kth_id = np.full(root.last, np.iinfo(np.int64).max)
        self.visited = 0

    def add(self, docs: DocumentTree) -> None:
        import numpy as np

        top = len(docs.levels) - 1
        self._visit(self.root, docs, top, np.arange(len(docs.levels[top][0])))

    def _visit(self, items: ItemNode, docs: DocumentTree, level: int, nodes) -> None:
        """Search pairs of ``items`` and document nodes of one level."""
        import numpy as np

        maxima, smallest = docs.levels[level]
        bound = maxima[np.ix_(nodes, items.terms)].astype(np.int64) @ self.weights[items.terms]
        kth, ids = self.kth[items.first : items.last], self.kth_id[items.first : items.last]
        weakest = kth.min()
        last_id = ids[kth == weakest].max()
        open_ = (bound > weakest) | ((bound == weakest) & (weakest > 0) & (smallest[nodes] <= last_id))
        nodes, bound = nodes[open_], bound[open_]
        if not nodes.size:
            return
        if level == 0 and not items.children:
            for at in np.argsort(-bound, kind="stable").tolist():
                if bound[at] < self.kth[items.first]:
                    break
                self._score(items, docs, int(nodes[at]))
            return
        if level:
            nodes = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
            nodes = nodes[nodes < len(docs.levels[level - 1][0])]
            level -= 1
        for child in items.children or [items]:
            self._visit(child, docs, level, nodes)

    def _score(self, item: ItemNode, docs: DocumentTree, leaf: int) -> None:
        import numpy as np

        self.visited += 1
        first, last = leaf * LEAF, min((leaf + 1) * LEAF, len(docs.ids))
        a, b = docs.starts[first], docs.starts[last]
        own = np.zeros(len(self.weights), np.int64) if len(item.terms) > 64 else None
        if own is None:
            at = np.searchsorted(item.terms, docs.terms[a:b])
            at[at == len(item.terms)] = 0
            gain = np.where(item.terms[at] == docs.terms[a:b], self.weights[docs.terms[a:b]], 0)
        else:
            own[item.terms] = self.weights[item.terms]
            gain = own[docs.terms[a:b]]
        scores = np.add.reduceat(gain * docs.impacts[a:b], docs.starts[first:last] - a)
        heap, i = self.best[item.first], item.first
        for d in np.flatnonzero((scores > 0) & (scores >= self.kth[i])).tolist():
            entry = (int(scores[d]), -int(docs.ids[first + d]))
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
        if len(heap) == self.k:
            self.kth[i], self.kth_id[i] = heap[0][0], -heap[0][1]


# -- the operator


def _search_block(block: list[tuple], docs: DataFrame, doc_id: str, text: str, k: int, id_type: str) -> DataFrame:
    """item_no, item_id, doc_id, score: every task's best documents of the block's items."""
    import numpy as np

    spark = docs.sparkSession
    vocabulary = sorted({t for _, _, terms in block for t in terms})
    numbers = {t: i for i, t in enumerate(vocabulary)}
    vectors = document_vectors(docs, numbers, doc_id, text)
    n_docs, all_terms = vectors.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for term, count in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row a term
        df[term] = count
    weights = np.array([weight(n_docs, int(x)) for x in df], np.int64)
    # items with the same frequent terms lie side by side
    by_df = np.argsort(np.argsort(-df, kind="stable"), kind="stable")
    held = [(sorted(by_df[[numbers[t] for t in terms]].tolist()), number, name, terms) for number, name, terms in block]
    held.sort(key=lambda x: x[:2])
    terms = [np.array(sorted(numbers[t] for t in x[3]), np.int64) for x in held]
    shipped = spark.sparkContext.broadcast((terms, weights, [(x[1], x[2]) for x in held]))
    step = max(1, MATRIX_BYTES // (4 * len(vocabulary))) * LEAF  # documents of a batch
    none = np.iinfo(np.int64).max  # a null id comes last

    def search(batches):
        import pyarrow as pa

        terms, weights, names = shipped.value
        found = Search(item_tree(terms), weights, k)
        for rows in batches:
            for start in range(0, rows.num_rows, step):
                part = rows.slice(start, step)
                ids = part.column("doc_id").fill_null(none).to_numpy()
                counts = part.column("terms")
                if not len(counts.flatten()):
                    continue
                tf = part.column("tfs").flatten().to_numpy()
                sizes = counts.value_lengths().to_numpy()
                m = [100 - LENGTH_SHARE + LENGTH_SHARE * n * n_docs // all_terms for n in part.column("n").to_pylist()]
                spread = np.repeat(np.array(m, np.int64), sizes)
                impacts = (SCALE * tf) // (1000 * tf + 8 * spread)
                some = sizes > 0
                starts = np.concatenate([[0], np.cumsum(sizes[some])]).astype(np.int64)
                found.add(DocumentTree(ids[some], counts.flatten().to_numpy().astype(np.int64), impacts, starts, weights))
        out = [(*names[i], -d, s) for i, heap in enumerate(found.best) for s, d in heap]
        if out:
            number, name, doc, score = zip(*out, strict=True)
            yield batch(
                item_no=("int64", number), item_id=pa.array(name), score=("int64", score),
                doc_id=("int64", [None if d == none else d for d in doc]),
            )

    schema = f"item_no long, item_id {id_type}, score long, doc_id long"
    result = stored(map_batches(vectors.filter(F.size("terms") > 0), search, schema), "block-best")
    shipped.unpersist()
    return result


def ranked_search(
    items: DataFrame,
    docs: DataFrame,
    k: int = 10,
    item_id: str = "item_id",
    item_text: str = "text",
    doc_id: str = "doc_id",
    text: str = "text",
    block_terms: int = 200_000,
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` documents with the highest scores above 0, for every item row.

    Equal scores go by ascending document id (nulls last; repeated rows are
    documents of their own).  Null and empty texts have no terms: such a document
    does not count, such an item has no rows.  Rows with one item id are items of
    their own, each with its ranks.  Ids of documents are whole numbers.
    """
    id_type = items.schema[item_id].dataType.simpleString()
    blocks = [_search_block(b, docs, doc_id, text, k, id_type) for b in item_blocks(items, item_id, item_text, block_terms)]
    spark = docs.sparkSession
    if not blocks:
        return spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
    best = Window.partitionBy("item_no").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = reduce(DataFrame.unionByName, blocks).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
