"""Ranked search against a plain-Python version, and the pruning's effect."""

import math
import random
import re
from collections import Counter

import numpy as np

from recoda.llm import jobs, ranked_search

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, n long, terms string, item_id string, rank int, score string"
ITEMS = "item_id string, text string, rank int, doc_id string, item_no int"


def terms_of(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def brute(items, docs, k=10):
    """items: (id, text), docs: (id, text); Counter of (item_id, rank, doc_id, score)."""
    cut = [(d, terms_of(t)) for d, t in docs]
    n_docs, total = sum(bool(t) for _, t in cut), sum(len(t) for _, t in cut)
    df = Counter(t for _, terms in cut for t in set(terms))
    out = Counter()
    for item, text in items:
        scored = []
        for d, terms in cut:
            tf, n = Counter(terms), len(terms)
            m = 100 - 90 + (90 * n * n_docs) // total if total else 0
            score = 0
            for t in set(terms_of(text)):
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * tf[t]) // (1000 * tf[t] + 8 * m))
            if score > 0:
                scored.append((-score, d is None, d))
        for rank, (score, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            out[item, rank, d, -score] += 1
    return out


def found(items, docs, **options):
    return Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in ranked_search.ranked_search(items, docs, **options).collect())


def test_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    out = jobs.q_ranked_search(spark, SF)
    assert dict(out.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert Counter((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in out.collect()) == brute(items, docs)


def test_awkward_rows_ties_and_blocks(spark):
    rng = random.Random(2)
    words = ["Al", "be", "é", "É", "x1", "漢字", "o", "q", "zz", "İ", "a_b"]
    docs = [(i % 90, " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(100)]
    docs += [(i, "copy of al copy") for i in range(500, 400, -1)]  # a group of ties
    docs += [(None, "AL be"), (None, None), (7, None), (8, ""), (9, "al " * 30000), (2**60 + 1, "copy")]
    items = [("a", "al BE é"), ("a", "al BE é"), ("b", None), ("c", ""), ("d", "nowhere"), (None, "copy zz"), ("e", " ".join(words))]
    d = spark.createDataFrame([(*r, 5, "t", "i", 1, "s") for r in docs], DOCS).repartition(5)
    q = spark.createDataFrame([(*r, 1, "d", 2) for r in items], ITEMS).repartition(2)
    want = brute(items, docs)
    assert found(q, d) == want
    assert found(q, d, block_terms=4) == want  # several blocks
    assert found(q, d, k=1) == brute(items, docs, 1)


def test_empty_tables(spark):
    d, q = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    one = spark.createDataFrame([(1, "al", 1, "", "", 1, "")], DOCS)
    ask = spark.createDataFrame([("a", "al", 1, "", 1)], ITEMS)
    assert not found(q, one) and not found(ask, d) and not found(q, d)
    assert found(ask, one) == brute([("a", "al")], [(1, "al")])


def test_bounds_prune_most_leaves():
    rng = np.random.default_rng(1)
    weights = rng.integers(1000, 9000, 400)
    ids = np.arange(20_000)
    sizes = np.full(len(ids), 12)
    terms = np.concatenate([np.sort(rng.choice(400, 12, replace=False)) for _ in ids])
    impacts = rng.integers(100_000, 900_000, len(terms))
    items = [np.sort(rng.choice(400, 4, replace=False)) for _ in range(30)]
    search = ranked_search.Search(ranked_search.item_tree(items), weights, 10)
    tree = ranked_search.DocumentTree(ids, terms, impacts, np.concatenate([[0], np.cumsum(sizes)]), weights)
    search.add(tree)
    dense = np.zeros((len(ids), 400), np.int64)
    dense[np.repeat(ids, 12), terms] = impacts
    for i, item in enumerate(items):
        scores = dense[:, item] @ weights[item]
        order = np.lexsort((ids, -scores))[:10]
        want = [(int(scores[d]), int(d)) for d in order if scores[d] > 0]
        assert sorted(((s, -d) for s, d in search.best[i]), key=lambda x: (-x[0], x[1])) == want
    assert search.visited < 0.5 * len(items) * len(tree.levels[0][0])
