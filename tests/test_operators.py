"""Relational operators: dedup, shards, null-safe joins, mapping, evaluation, retrieval."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from recoda.functions import constants as K
from recoda.operators import evaluate as EV
from recoda.operators.assemble import anti_join_ids, propagate
from recoda.operators.dedup import duplicate_keys, first_per_key
from recoda.operators.mapping import ambiguous, nested_mapping, unique_targets
from recoda.operators.models import common_ids, merge_frames, models_wide
from recoda.operators.retrieve import dot_product_scorer, similar_topk
from recoda.operators.workset import split_shards

ATTRS = K.ATTRIBUTE_COLUMNS


def test_first_per_key_is_order_and_partition_independent(spark):
    rows = [(k % 7, (k * 37) % 11, f"v{(k * 13) % 5}") for k in range(300)]
    df = spark.createDataFrame(rows, "k int, o int, v string")
    a = sorted(first_per_key(df, ["k"], ["o"]).collect())
    b = sorted(first_per_key(df.repartition(13).orderBy(F.rand(3)), ["k"], ["o"]).collect())
    assert a == b
    # the kept row is the smallest (o, v) per key
    want = {}
    for k, o, v in rows:
        want[k] = min(want.get(k, (o, v)), (o, v))
    assert {r["k"]: (r["o"], r["v"]) for r in a} == want


def test_first_per_key_nulls_first_and_null_keys(spark):
    df = spark.createDataFrame([(None, 2, "a"), (None, None, "b"), (1, 3, None), (1, 3, "c")], "k int, o int, v string")
    got = {r["k"]: (r["o"], r["v"]) for r in first_per_key(df, ["k"], ["o"]).collect()}
    assert got == {None: (None, "b"), 1: (3, None)}


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    plan = first_per_key(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    # a partial limit runs map-side before the shuffle: a hot key cannot pile up in one task
    before_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


@pytest.mark.parametrize("n,sizes", [(0, []), (1, [0, 0, 1]), (2, [0, 0, 2]), (3, [1, 1, 1]), (8, [2, 2, 4]),
                                     (1001, [333, 333, 335])])
def test_split_shards(spark, n, sizes):
    df = spark.createDataFrame([(f"id{i:05d}",) for i in range(n)], "liasse_numero string") if n else \
        spark.createDataFrame([], "liasse_numero string")
    out = split_shards(df, partitions=4).collect()
    counts = [sum(1 for r in out if r["shard"] == s) for s in (1, 2, 3)]
    assert counts == (sizes or [0, 0, 0])
    # positions are a permutation of 0..n-1 following the key order, shards are contiguous
    ordered = sorted(out, key=lambda r: r["position"])
    assert [r["position"] for r in ordered] == list(range(n))
    assert [r["liasse_numero"] for r in ordered] == sorted(r["liasse_numero"] for r in out)
    assert [r["shard"] for r in ordered] == sorted(r["shard"] for r in out)


def _attrs_row(id_, label, values):
    return (id_, label, *values)


def test_propagate_null_safe(spark):
    schema = "liasse_numero string, nace2025 string, " + ", ".join(f"{a} string" for a in ATTRS)
    same = ["x"] * 9
    both_null = ["y"] * 8 + [None]
    labels = spark.createDataFrame([_attrs_row("L1", "AAA", same), _attrs_row("L2", "BBB", both_null),
                                    _attrs_row("L3", "CCC", ["z"] * 9)], schema)
    targets = spark.createDataFrame([
        _attrs_row("T1", None, same), _attrs_row("T2", None, same), _attrs_row("T3", None, both_null),
        _attrs_row("T4", None, ["y"] * 9), _attrs_row(None, None, ["z"] * 9)], schema).drop("nace2025")
    got = sorted((r["liasse_numero"], r["nace2025"]) for r in propagate(labels, targets).collect())
    # equal attributes match, null matches null, one-sided null does not, null target ids are dropped
    assert got == [("T1", "AAA"), ("T2", "AAA"), ("T3", "BBB")]
    plan = propagate(labels, targets)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_anti_join_null_ids(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "liasse_numero string, v int")
    with_null = spark.createDataFrame([("a",), (None,)], "liasse_numero string")
    without_null = spark.createDataFrame([("a",)], "liasse_numero string")
    assert sorted(r["v"] for r in anti_join_ids(left, with_null).collect()) == [3]
    assert sorted(r["v"] for r in anti_join_ids(left, without_null).collect()) == [2, 3]


def test_duplicate_keys_counts_null_ids(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "liasse_numero string")
    got = sorted((r["liasse_numero"] or "", r["n_rows"]) for r in duplicate_keys(df, ["liasse_numero"]).collect())
    assert got == [("", 2), ("a", 2)]


def _corr(spark, rows):
    return spark.createDataFrame(rows, "naf08_niv5 string, lib_naf08_niv5 string, naf25_niv5 string, lib_naf25_niv5 string, pos long")


def _notes(spark, codes):
    return spark.createDataFrame([(c, f"t {c}", None, f"inc {c}", None, None, i) for i, c in enumerate(codes)],
                                 "code25 string, title string, note_generale string, comprend string, "
                                 "comprend_aussi string, ne_comprend_pas string, pos long")


def test_nested_mapping_keeps_repeated_pairs_and_order(spark):
    corr = _corr(spark, [
        ("01.11A", "old one", "02.22B", "new b", 3),
        ("01.11A", "old one bis", "02.22C", "new c", 1),
        ("01.11A", "x", "02.22B", "new b", 5),       # repeated pair counts
        ("03.33A", "old three", "02.22C", "new c2", 2),
        (None, "dropped", "02.22C", "z", 0),
    ])
    m = nested_mapping(corr, _notes(spark, ["02.22B", "02.22C"]))
    got = {r["code08"]: r for r in m.collect()}
    assert set(got) == {"0111A", "0333A"}
    assert got["0111A"]["n_targets"] == 3
    assert [t["code"] for t in got["0111A"]["targets"]] == ["0222C", "0222B", "0222B"]
    assert got["0111A"]["label08"] == "old one bis"
    assert got["0111A"]["targets"][0]["include"] == "inc 02.22C"
    assert [r["code08"] for r in ambiguous(m).collect()] == ["0111A"]
    first = {r["code"]: (r["code08"], r["label"]) for r in unique_targets(m).collect()}
    assert first == {"0222C": ("0111A", "new c"), "0222B": ("0111A", "new b")}


def test_models_wide_and_common_ids(spark):
    long = spark.createDataFrame([
        ("a", "1", "X", True), ("b", "1", "Y", False), ("c", "1", None, False),
        ("a", "2", "X", True), ("b", "2", "X", True),
        ("a", "3", "Z", True), ("a", "3", "A", True), ("b", "3", "Q", True), ("c", "3", "Q", True),
    ], "model string, liasse_numero string, nace2025 string, codable boolean")
    w = {r["liasse_numero"]: r for r in models_wide(long, ["a", "b", "c"]).collect()}
    assert set(w) == {"1", "3"}
    assert w["3"]["nace2025_a"] == "A"  # first row of a repeated id
    assert sorted(r[0] for r in common_ids(long, ["a", "b", "c"]).collect()) == ["1", "3"]
    outer = models_wide(long, ["a", "b", "c"], how="outer")
    assert outer.count() == 3
    frames = {m: long.filter(F.col("model") == m).drop("model").dropDuplicates(["liasse_numero"]) for m in "abc"}
    merged = merge_frames(frames, "liasse_numero", ["liasse_numero", "nace2025"], {"nace2025": "nace2025_{key}"})
    assert sorted(merged.columns) == ["liasse_numero", "nace2025_a", "nace2025_b", "nace2025_c"]
    assert merged.count() == 2
    with pytest.raises(ValueError):
        merge_frames({}, "liasse_numero")


def test_accuracy_levels_edge_cases(spark):
    df = spark.createDataFrame([("0111Z", "0111Z"), ("0111Z", "0111A"), ("0111Z", "9111Z"), ("0111Z", None)],
                               "apet_manual string, nace2025 string")
    row = df.agg(*[v.alias(k) for k, v in EV.accuracy_metrics(df, filters=(None,)).items()]).first()
    assert [row[f"accuracy_overall_lvl_{i}"] for i in (5, 4, 3, 2, 1)] == [25.0, 50.0, 50.0, 50.0, 50.0]
    empty = df.limit(0)
    row = empty.agg(*[v.alias(k) for k, v in EV.accuracy_metrics(empty, filters=(None,)).items()]).first()
    assert row["accuracy_overall_lvl_5"] is None


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(i < 1,) for i in range(800)], "f boolean")  # 0.125 %
    assert df.agg(EV.pct(F.col("f")).alias("p")).first()["p"] == 0.12


def _brute_topk(q, d, k):
    out = {}
    for qi, qv in q.items():
        qv = np.asarray(qv, dtype=np.float64)
        scored = []
        for di, dv in d.items():
            dv = np.asarray(dv, dtype=np.float64)
            scored.append((-(qv @ dv) / (np.linalg.norm(qv) * np.linalg.norm(dv)), di))
        out[qi] = [di for _, di in sorted(scored)[:k]]
    return out


def test_similar_topk_paths_agree_with_brute_force(spark):
    rng = np.random.default_rng(7)
    qv = {i: rng.normal(size=8).astype(np.float32).tolist() for i in range(40)}
    dv = {i: rng.normal(size=8).astype(np.float32).tolist() for i in range(100, 190)}
    dv[190] = dv[101]  # an exact tie: smaller id first
    q = spark.createDataFrame(list(qv.items()), "query_id long, query_vec array<float>")
    d = spark.createDataFrame(list(dv.items()), "doc_id long, doc_vec array<float>")
    want = _brute_topk(qv, dv, 5)
    small = similar_topk(q, d, k=5)
    blocked = similar_topk(q, d, k=5, block_rows=16)  # forces the blocked cogroup path
    for res in (small, blocked):
        got = {}
        for r in res.orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append(r["doc_id"])
        assert got == want
    # broadcast path: no shuffle at all; blocked path: per-query limit planned as WindowGroupLimit
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "WindowGroupLimit" in blocked._jdf.queryExecution().executedPlan().toString()
    # re-ranking: both paths equal too
    r1 = sorted(tuple(r) for r in similar_topk(q, d, k=3, fetch_k=10, scorer=dot_product_scorer).select("query_id", "doc_id", "rank").collect())
    r2 = sorted(tuple(r) for r in similar_topk(q, d, k=3, fetch_k=10, scorer=dot_product_scorer, block_rows=16).select("query_id", "doc_id", "rank").collect())
    assert r1 == r2


def test_propagate_hot_attribute_key_is_split_by_aqe(spark):
    """A third of the targets share one attribute combination: AQE splits that partition."""
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 60000
        key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 2000).cast("string"))
        others = [F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.lit("x")).alias(a) for a in ATTRS[1:]]
        targets = spark.range(n).select(F.col("id").cast("string").alias("liasse_numero"), key.alias(ATTRS[0]), *others)
        labels = targets.dropDuplicates(ATTRS).select(F.lit("L").alias("nace2025"), *ATTRS)
        out = propagate(labels, targets)
        assert len(out.collect()) == n
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_sized_broadcast_only_below_the_bound(spark):
    from recoda.session import sized_broadcast

    big = spark.range(50_000).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = big.join(sized_broadcast(small, max_rows=100), "k")
        assert "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
        unhinted = small.join(sized_broadcast(big, max_rows=100), "k")
        assert "BroadcastHashJoin" not in unhinted._jdf.queryExecution().executedPlan().toString()
        assert unhinted.count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sized_broadcast_reads_no_further_than_its_bound_and_checks_bytes(spark):
    from recoda.session import sized_broadcast

    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for f in frames:
            seen.add(len(f))
            yield f

    big = spark.range(0, 400_000, 1, 4).mapInPandas(count, "id long")
    probed = sized_broadcast(big, max_rows=1_000)
    assert not probed.is_cached and seen.value <= 4 * 10_000 + 10_000
    wide = spark.range(50).select("id", F.lit("x" * 10_000).alias("t"))
    for bound, hinted in ((100_000, False), (1_000_000, True)):
        plan = sized_broadcast(wide, max_bytes=bound)._jdf.queryExecution().logical().toString()
        assert ("ResolvedHint" in plan or "UnresolvedHint" in plan) == hinted


def test_topk_ties_go_to_the_smaller_id_for_every_block_size(spark):
    import numpy as np

    from recoda.operators.retrieve import similar_topk

    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 33))
    vectors = [base[i % 60 if i % 7 else 3] for i in range(400)]  # many exact copies
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "doc_id long, doc_vec array<double>")
    queries = spark.createDataFrame([(i, (v + 0.01).tolist()) for i, v in enumerate(vectors[:90])],
                                    "query_id long, query_vec array<double>")
    got = []
    for rows in (50_000, 64, 37):
        top = similar_topk(queries, docs, k=5, block_rows=rows).collect()
        got.append(sorted((r["query_id"], r["rank"], r["doc_id"]) for r in top))
    assert got[0] == got[1] == got[2]
    unit = np.stack(vectors) / np.linalg.norm(np.stack(vectors), axis=1, keepdims=True)
    for q in range(90):
        own = (vectors[q] + 0.01) / np.linalg.norm(vectors[q] + 0.01)
        scores = [round(float(np.dot(own, u)), 11) for u in unit]
        want = sorted(range(400), key=lambda i: (-scores[i], i))[:5]
        assert [d for i, r, d in got[0] if i == q] == want


def test_wide_table_takes_any_model_name_and_prefers_an_answer(spark):
    from recoda.operators.models import models_wide

    rows = [("org/m-2.5", 1, None, True), ("org/m-2.5", 1, "B", False), ("a`b.c", 1, "C", True)]
    long = spark.createDataFrame(rows, "model string, liasse_numero long, nace2025 string, codable boolean")
    out = models_wide(long, ["org/m-2.5", "a`b.c"]).first().asDict()
    assert out["nace2025_org/m-2.5"] == "B" and out["nace2025_a`b.c"] == "C"


def test_predictor_sees_the_whole_chat_settings_and_is_set_up_per_task(spark):
    from recoda.functions.response import post_process, python_tokenizer
    from recoda.operators.infer import run_predictor

    def factory():
        def answer(chats, temperature):
            assert temperature == 0.5
            out = []
            for system, user in chats:
                assert (system["role"], user["role"]) == ("system", "user")
                code = f"{user['content']}-{system['content']}"
                text = '{"codable": true, "nace2025": "' + code + '"}'
                out.append((text, [9000, 9001, 9002, 9003], [-0.1, -0.2, -0.4, -0.3]))
            return out

        return answer

    df = spark.createDataFrame([(1, "keep", "S", "U"), (None, None, "T", "V")],
                               "liasse_numero long, extra string, system_prompt string, user_prompt string")
    answers = run_predictor(df, factory, settings={"temperature": 0.5}, per_worker=True)
    tokenizer = python_tokenizer(lambda texts: [[9001, 9002] for _ in texts])
    out = {r["extra"]: r for r in post_process(answers, keep=("liasse_numero", "extra"), tokenize=tokenizer).collect()}
    assert out["keep"]["nace2025"] == "U-S" and out[None]["nace2025"] == "V-T" and out[None]["liasse_numero"] is None
    assert abs(out["keep"]["confidence"] - (0.8187307530779818 + 0.6703200460356393) / 2) < 1e-12


def test_shards_do_not_depend_on_partition_count(spark):
    df = spark.createDataFrame([(f"k{(i * 7919) % 1009:05d}",) for i in range(1009)], "liasse_numero string")
    a = sorted(tuple(r) for r in split_shards(df, partitions=3).collect())
    b = sorted(tuple(r) for r in split_shards(df.repartition(11), partitions=17).collect())
    assert a == b


def test_propagate_salted_equals_plain(spark):
    n = 20000
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string"))
    others = [F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.lit("x")).alias(a) for a in ATTRS[1:]]
    targets = spark.range(n).select(F.col("id").cast("string").alias("liasse_numero"), key.alias(ATTRS[0]), *others)
    targets = targets.unionByName(spark.createDataFrame([(None,)], "liasse_numero string"), allowMissingColumns=True)
    labels = targets.dropDuplicates(ATTRS).select(F.concat(F.lit("L"), F.col(ATTRS[0])).alias("nace2025"), *ATTRS)
    plain = sorted(tuple(r) for r in propagate(labels, targets).collect())
    salted_df = propagate(labels, targets, salts=8, hot_rows=1000)
    salted = sorted(tuple(r) for r in salted_df.collect())
    assert plain == salted and len(plain) == n
    assert "__salt" in salted_df._jdf.queryExecution().optimizedPlan().toString()
