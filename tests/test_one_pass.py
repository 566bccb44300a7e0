"""Metrics observed during the write, unique writes, sketched hot keys, and the quick check before Python."""

import unicodedata

import pytest
from pyspark.sql import DataFrameReader, Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from recoda.functions import constants as K
from recoda.functions.text import nfkc
from recoda.operators import evaluate as E
from recoda.operators.assemble import hot_keys, propagate
from recoda.operators.infer import first_candidate_predictor
from recoda.operators.recode import recode_unambiguous
from recoda.plans import entrypoints as EP
from recoda.plans import jobs
from recoda.session import scratch_path
from recoda.sources import fixtures as X
from recoda.sources.sinks import write_results, write_unique
from recoda.sources.tables import read_runs

ATTRS = K.ATTRIBUTE_COLUMNS
GT_ORDER = ["g_seq", "apet_manual", "NAF2008_code"]


@pytest.fixture
def read_paths(monkeypatch):
    """Every path that is read as Parquet."""
    seen, plain = [], DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *paths, **kw: seen.extend(paths) or plain(self, *paths, **kw))
    return seen


def test_entry_a_measures_while_it_writes(spark, read_paths):
    root, prompts = scratch_path(spark, "t-once"), scratch_path(spark, "t-once-prompts")
    gt = X.ground_truth(spark, SF_SMALL)
    m = EP.encode_ambiguous(X.extraction(spark, SF_SMALL), jobs.mapping(spark, SF_SMALL), gt, first_candidate_predictor,
                            jobs.mapping_template(spark), "m", "r", root, order=["row_seq"], gt_order=GT_ORDER,
                            prompts_path=prompts, only_annotated=False)
    got = {r["metric"]: r["value"] for r in m.collect()}
    assert not [p for p in read_paths if p.startswith(root)]
    results = read_runs(spark, root, {"m": ["r"]})
    assert not set(E.LABEL_COLUMNS) & set(results.columns)
    again = E.evaluate_results(results, gt, spark.read.parquet(prompts), GT_ORDER).unionByName(E.to_long(E.coded_stats(results)))
    assert got == {r["metric"]: r["value"] for r in again.collect()}
    assert 0 < got["eval_size"] < results.count()


def test_metrics_of_an_empty_run_are_null(spark, tmp_path):
    empty = spark.createDataFrame([], "liasse_numero string, nace2025 string, codable boolean, apet_manual string, "
                                      "mapping_ok boolean, __labelled boolean")
    _, seen = write_results(empty, str(tmp_path), "m", "r", None, E.result_metrics(), E.LABEL_COLUMNS)
    assert seen["eval_size"] == 0 == seen["num_coded"] and seen["pct_not_coded"] is None
    assert seen["accuracy_overall_lvl_5"] is None


def test_entry_d_checks_while_it_writes(spark, tmp_path, read_paths):
    ex, mp = X.extraction(spark, SF_SMALL), jobs.mapping(spark, SF_SMALL)
    ws = jobs.workset(spark, SF_SMALL).select("liasse_numero")
    labels = jobs.model_results(spark, SF_SMALL).join(ws, "liasse_numero", "left_semi").select("liasse_numero", "nace2025")
    human = X.ground_truth(spark, SF_SMALL).select("liasse_numero", F.col("apet_manual").alias("nace2025"), "g_seq")
    options = {"order": ["row_seq"], "human_order": ["g_seq"], "output": str(tmp_path / "final")}
    parts = EP.build_final(ex, recode_unambiguous(ex, mp), labels, human, prefer_human=True, **options)
    counts = parts["counts"].first()
    assert read_paths.count(options["output"]) == 1  # opened for the caller, not for a count
    assert counts["rows"] == parts["final"].count() and counts["repeated"] == 0
    with pytest.raises(AssertionError, match="duplicate ids"):
        EP.build_final(ex, recode_unambiguous(ex, mp), labels, human, **options)
    assert spark.read.parquet(options["output"]).count() == counts["rows"]  # the good table is still there
    loose = EP.build_final(ex, recode_unambiguous(ex, mp), labels, human, fail_on_duplicates=False, **options)
    repeated = loose["violations"].agg(F.sum("n_rows")).first()[0]
    assert loose["counts"].first()["repeated"] == repeated > 0


def test_null_keys_count_as_equal_in_a_unique_write(spark, tmp_path):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert write_unique(df, str(tmp_path / "t"), ["k"], None) == {"rows": 3, "repeated": 2}
    with pytest.raises(AssertionError):
        write_unique(df, str(tmp_path / "u"), ["k"], "repeated")
    assert spark.read.parquet(str(tmp_path / "t")).columns == ["k", "v"] and not (tmp_path / "u").exists()


def test_a_third_of_the_rows_on_one_key_is_split_by_default(spark):
    """AQE's own skew handling is off; the sketch finds the key and its targets go to many partitions."""
    off = {"spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
           "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        n, key = 30_000, F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
        others = [F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.lit("x")).alias(a) for a in ATTRS[1:]]
        targets = spark.range(n).select(F.col("id").cast("string").alias("liasse_numero"), key.alias(ATTRS[0]), *others)
        labels = targets.dropDuplicates(ATTRS).select(F.concat(F.lit("L"), F.col(ATTRS[0])).alias("nace2025"), *ATTRS)
        hot = hot_keys(targets, ATTRS, 1000)
        assert len(hot) == 1 and 10 <= next(iter(hot.values())) <= 12
        split, plain = propagate(labels, targets, hot_rows=1000), propagate(labels, targets, salts=0)
        sizes = [sorted(r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
                 for df in (split, plain)]
        assert sizes[1][-1] > n / 3 > 2 * sizes[0][-1]
        assert sorted(map(tuple, split.collect())) == sorted(map(tuple, plain.collect()))
        assert propagate(labels.limit(0), targets.limit(0)).count() == 0
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_nfkc_sends_only_texts_that_can_change(spark):
    points = [c for c in [*range(0x3400), *range(0x3400, 0x110000, 53), *range(0xF900, 0xFFFE), *range(0x1F100, 0x1F250)]
              if not 0xD800 <= c < 0xE000 and c]
    texts = [f"e{chr(c)}a{chr(c)}ে{chr(c)}ᄀ{chr(c)}" for c in points] + [f"a{chr(c)}b" for c in points] + ["plain", "", None, "café", "각"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("o", nfkc("t"))
    rows = df.collect()
    assert len(rows) == len(texts)
    assert [r["t"] for r in rows if r["o"] != (None if r["t"] is None else unicodedata.normalize("NFKC", r["t"]))] == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "RLIKE" in plan and "ArrowEvalPython" in plan


def test_nfkc_looks_for_one_small_character_class(spark):
    """A class of all ranges that NFKC may change costs more a character than the normalisation itself."""
    texts = ["plain", "caf\u00e9", "cafe\u0301", "\ufb01n\u00b2", "a\u00a0b", "\x7f\x80\x9f", "\U0001f130", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", nfkc("t").alias("o"))
    assert [r["o"] for r in df.collect()] == [t and unicodedata.normalize("NFKC", t) for t in texts]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "octet_length" in plan and max(len(p) for p in plan.split("RLIKE")[1:]) < 500
