"""The prefix trie against a plain-Python version."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from recoda.llm import jobs, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth int, len int"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:30]


def brute(rows):
    """Rows of (conv_id, turn, role, text) to the set of node rows."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, digest(role, text), role, text))
    turns = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = tuple(turns.get(base, [])[:h] + turns[c][h:])
    members = defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own_saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[x] for x in children[node]) if children[node] else 1
        saved[node] = own_saved + sum(saved[x] for x in children[node])
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in m if len(rebuilt[c]) == len(node))
        out.append((
            m[0], len(node), members[node[:-1]][0] if node else None, len(m), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(df, **options):
    return sorted((tuple(r[c] for c in NAMES) for r in prefix_trie.prefix_trie(df, **options).collect()), key=str)


def random_rows(seed, convs=60, turns=7):
    rng = random.Random(seed)
    words = [("user", "a"), ("user", "b"), ("assistant", "é"), (None, None), ("", "long text")]
    rows = []
    for c in range(convs):
        start = rng.choice([[], [("user", "a")] * rng.randint(0, turns)])
        for i, (role, text) in enumerate(start + [rng.choice(words) for _ in range(rng.randint(0, turns))]):
            rows.append((c * rng.choice([1, 1, 1, 3]), rng.choice([i, i, None]), role, text))
    rows += [(None, 1, "user", "nobody"), (-7, 0, "user", "a"), (-5, 0, "user", "b"), (-3, 3, "user", "a")]
    return rows + rows[:5]


@pytest.mark.parametrize("task_nodes", [1, 4, 50_000])
def test_equals_brute_force(spark, task_nodes):
    rows = random_rows(task_nodes)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(4)
    assert found(df, task_nodes=task_nodes) == brute(rows)


def test_one_long_conversation_and_many_copies(spark, monkeypatch):
    """A conversation over many partitions, a path as deep, prefixes of all lengths, copies, a hub of children."""
    monkeypatch.setattr(prefix_trie, "SEGMENT", 16)
    rows = [(5, i, "user", f"t{i}") for i in range(300)]
    rows += [(10 * k, i, "user", f"t{i}") for k in range(1, 25) for i in range(12 * k)]
    rows += [(1000 + 5 * k, 0, "user", "same") for k in range(150)]
    rows += [(3000 + 5 * k, i, "user", "same" if i == 0 else str(k)) for k in range(150) for i in range(2)]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)
    assert found(df, task_nodes=40) == brute(rows)


def test_whole_table_and_empty_tables(spark):
    conversations = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in conversations.collect()]
    got = sorted((tuple(r[c] for c in NAMES) for r in jobs.q_prefix_trie(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == brute(rows)
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(None, 1, "user", "x", None, None, None)], SCHEMA)) == []


def test_local_rollup_of_awkward_shapes():
    rng = random.Random(3)
    for n in (1, 2, 3, 10, 400):
        shapes = [[-1] + list(range(n - 1)), [-1] + [0] * (n - 1), [-1] + [rng.randrange(i) for i in range(1, n)]]
        for parents in shapes:
            values = [(rng.randint(0, 3), rng.randint(0, 9)) for _ in range(n)]
            sizes, want = [1] * n, [list(v) for v in values]
            for i in range(n - 1, 0, -1):
                sizes[parents[i]] += sizes[i]
                want[parents[i]][0] += want[i][0]
                want[parents[i]][1] += want[i][1]
            assert [list(t) for t in prefix_trie.centroid_rollup(parents, sizes, values)] == want
