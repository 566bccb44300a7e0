"""Sources, sinks, templates, streaming and the plan shapes of the main jobs."""

from conftest import SF_SMALL
from recoda.functions import constants as K
from recoda.operators.mapping import normalise_correspondence, normalise_notes
from recoda.plans import jobs
from recoda.session import checkpoint_root, scratch_path
from recoda.sources.sinks import write_metrics, write_results
from recoda.sources.tables import read_runs, read_sheet
from recoda.sources.templates import load_template, prompt_templates


def test_checkpoint_root_reads_session(spark):
    root = checkpoint_root(spark)
    assert root and scratch_path(spark, "x").startswith(root)


def test_sheet_read_all_strings_and_positions(spark, tmp_path):
    header = [f"c{i}" for i in range(12)]
    row = ["r", "01.11Z", "old label", "01.11", "x", "02.2", "y", "z", "w", "v", "02.22B", "new label"]
    path = tmp_path / "corr.csv"
    path.write_text(",".join(header) + "\n" + ",".join(row) + "\n")
    sheet = read_sheet(spark, str(path), header)
    assert all(t == "string" for _, t in sheet.dtypes)
    got = normalise_correspondence(sheet).first().asDict()
    assert got == {"naf08_niv5": "01.11Z", "naf08_niv4": "01.11", "lib_naf08_niv5": "old label",
                   "naf25_niv5": "02.22B", "naf25_niv4": "02.2", "lib_naf25_niv5": "new label"}
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([StructField(c, StringType()) for c in K.NOTES_SHEET_COLUMNS])
    notes = spark.createDataFrame([("02.22B", "T", "g", "c", None, "n")], schema)
    assert normalise_notes(notes).columns == list(K.NOTES_SHEET_COLUMNS.values())


def test_results_partitioned_roundtrip_prunes(spark):
    root = scratch_path(spark, "test-results")
    df = spark.createDataFrame([("1", "0111Z", "True", 0.5, True), ("2", None, "undefined", 0.0, False)],
                               "liasse_numero string, nace2025 string, nace08_valid string, confidence double, codable boolean")
    write_results(df, root, "m1", "2024-11-13--00-39")
    write_results(df, root, "m1", "2024-11-15--01-13")
    write_results(df, root, "m2", "2024-11-13--00-39")
    write_results(df.limit(1), root, "m1", "2024-11-15--01-13")  # dynamic overwrite of one run only
    got = read_runs(spark, root, {"m1": ["2024-11-15--01-13"]})
    assert got.count() == 1
    assert dict(got.dtypes)["codable"] == "boolean"
    assert read_runs(spark, root, {"m1": ["2024-11-13--00-39"], "m2": ["2024-11-13--00-39"]}).count() == 4
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partitionFilters" in plan.lower()


def test_run_stamp_and_sql_over(spark):
    from datetime import datetime

    from recoda.sources.sinks import run_stamp
    from recoda.sources.tables import sql_over

    assert run_stamp(datetime(2024, 11, 13, 0, 39)) == "2024-11-13--00-39"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert sql_over(spark, "SELECT count(*) AS n FROM {t} WHERE k > 1", {"t": df}).first()["n"] == 1


def test_strict_mapping_and_empty_ambiguity(spark):
    import pytest

    from recoda.operators.mapping import nested_mapping
    from recoda.operators.workset import ambiguous_workset

    corr = spark.createDataFrame([("01.11A", "o", "02.22B", "n", 0)],
                                 "naf08_niv5 string, lib_naf08_niv5 string, naf25_niv5 string, lib_naf25_niv5 string, pos long")
    notes = spark.createDataFrame([("09.99Z", "t", None, None, None, None, 0)],
                                  "code25 string, title string, note_generale string, comprend string, "
                                  "comprend_aussi string, ne_comprend_pas string, pos long")
    with pytest.raises(AssertionError):
        nested_mapping(corr, notes)
    m = nested_mapping(corr, notes, strict=False)
    ex = spark.createDataFrame([("1", "0111A")], "liasse_numero string, apet_finale string")
    with pytest.raises(ValueError):
        ambiguous_workset(ex, m, columns=["liasse_numero"], attributes=[])


def test_metrics_of_shards_and_runs_stand_side_by_side_and_are_replaced(spark):
    path = scratch_path(spark, "test-metrics")
    m = spark.createDataFrame([("accuracy_overall_lvl_5", 12.5)], "metric string, value double")
    for run, shard in (("r1", 1), ("r1", 2), ("r2", None), ("r1", 1)):
        write_metrics(m, path, run, "org/m.1", shard)
    rows = spark.read.parquet(path).collect()
    assert sorted((r["run_id"], r["model"], str(r["shard"])) for r in rows) == [
        ("r1", "org--m.1", "1"), ("r1", "org--m.1", "2"), ("r2", "org--m.1", "all")]


def test_sheet_with_other_columns_fails(spark, tmp_path):
    import pytest

    (tmp_path / "s.csv").write_text("b,a\n1,2\n3,4\n")
    rows = read_sheet(spark, str(tmp_path / "s.csv"), ["b", "a"], row_col="row").orderBy("row").collect()
    assert [(r["b"], r["a"]) for r in rows] == [("1", "2"), ("3", "4")]
    with pytest.raises(Exception, match="header|column"):
        read_sheet(spark, str(tmp_path / "s.csv"), ["a", "b"]).collect()


def test_repeated_note_codes_need_a_row_number(spark):
    import pytest

    from recoda.operators.mapping import notes_by_code

    rows = [("01.1A", "z", None, None, None, None, 0), ("01.1A", "a", None, None, None, None, 1)]
    notes = spark.createDataFrame(rows, "code25 string, title string, note_generale string, comprend string, "
                                        "comprend_aussi string, ne_comprend_pas string, pos long")
    assert notes_by_code(notes).first()["title"] == "z"
    with pytest.raises(AssertionError):
        notes_by_code(notes.drop("pos"))


def test_the_nomenclature_stays_bounded_and_unambiguous_codes_remain(spark, tmp_path):
    from recoda.operators.mapping import nested_mapping
    from recoda.sources import fixtures as X

    part = spark.range(1, 70_001).selectExpr("id AS p_partkey", "'n' AS p_name", "'t' AS p_type", "'b' AS p_brand")
    part.write.parquet(str(tmp_path / "part.parquet"))
    m = nested_mapping(X.correspondence(spark, str(tmp_path)), X.notes(spark, str(tmp_path)), strict=False)
    sizes = {r["n_targets"]: r["count"] for r in m.groupBy("n_targets").count().collect()}
    assert sizes == {1: 10_000, 2: 10_000, 3: 10_000}


def test_no_private_folder_off_a_local_master(spark):
    import pytest

    from recoda.session import checkpoint_root

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "local-cluster[2,1,512]"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        checkpoint_root(Session())


def test_templates(spark):
    t = load_template(prompt_templates(spark), "mapping-classifier")
    assert set(t) == {"system", "user"} and "{{activity}}" in t["user"]
    newer = prompt_templates(spark).unionByName(
        spark.createDataFrame([("mapping-classifier", "production", 2, "user", 1, "v2 {{activity}}")],
                              "name string, label string, version int, role string, seq int, text string"))
    assert load_template(newer, "mapping-classifier")["user"] == "v2 {{activity}}"


def test_missing_old_code_is_an_error(spark):
    import pytest

    from recoda.operators.prompts import mapping_prompts

    m = jobs.mapping(spark, SF_SMALL)
    rows = spark.createDataFrame([("1", "9999Z", "x", None, None)],
                                 "liasse_numero string, apet_finale string, libelle string, activ_sec_agri_et string, activ_nat_lib_et string")
    with pytest.raises(AssertionError):
        mapping_prompts(rows, m, {"system": "s", "user": "{{activity}}"}, check=True)


def test_streaming_recode_matches_batch(spark):
    stream = jobs.q_recode_streaming(spark, SF_SMALL)
    batch = jobs.q_recode_unambiguous(spark, SF_SMALL)
    assert sorted(stream.collect()) == sorted(batch.collect())


def test_recode_broadcasts_the_lookup(spark):
    plan = jobs.q_recode_unambiguous(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_workset_scan_is_pruned(spark):
    plan = jobs.q_workset_ambiguous(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    # only the columns the declarations need are read from lineitem
    assert "l_shipdate" not in plan and "l_extendedprice" not in plan


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_read_files_matching_stamps(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from recoda.sources.tables import read_files_matching

    for stamp, n in (("2024-11-13--00-39", 2), ("2024-11-15--01-13", 3), ("2024-11-09--21-05", 4)):
        d = tmp_path / "codable=true"
        d.mkdir(exist_ok=True)
        pq.write_table(pa.table({"liasse_numero": [f"{stamp}-{i}" for i in range(n)]}), d / f"part-0-1--{stamp}.parquet")
    got = read_files_matching(spark, str(tmp_path), ["2024-11-13--00-39", "2024-11-09--21-05"])
    assert got.count() == 6
    assert dict(got.dtypes)["codable"] == "string"  # inferred partition value, as the original reader saw it
    typed = read_files_matching(spark, str(tmp_path), ["2024-11-15--01-13"], schema="liasse_numero string, codable boolean")
    assert typed.count() == 3 and dict(typed.dtypes)["codable"] == "boolean"


def test_streaming_recode_resumes_from_its_checkpoint(spark):
    from recoda.streaming.recode_stream import recode_stream
    from recoda.sources import fixtures as X

    ex = X.extraction(spark, SF_SMALL)
    mp = jobs.mapping(spark, SF_SMALL)
    landing, output, ckpt = (scratch_path(spark, n) for n in ("t-landing", "t-out", "t-ckpt"))
    first, second = ex.filter("row_seq % 2 = 0"), ex.filter("row_seq % 2 = 1")
    first.write.parquet(landing + "/batch=1")
    recode_stream(landing, spark, ex.schema, mp, output, ckpt, available_now=True).awaitTermination()
    n1 = spark.read.parquet(output).count()
    second.write.parquet(landing + "/batch=2")
    recode_stream(landing, spark, ex.schema, mp, output, ckpt, available_now=True).awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(output).collect())
    want = sorted(tuple(r) for r in jobs.q_recode_unambiguous(spark, SF_SMALL).collect())
    assert 0 < n1 < len(got)
    assert got == want  # every declaration exactly once across the two runs


def test_sheet_read_fails_fast_on_malformed_rows(spark, tmp_path):
    import pytest

    path = tmp_path / "bad.csv"
    path.write_text("a,b\n1,2\n3,4,5,6\n")
    with pytest.raises(Exception):
        read_sheet(spark, str(path), ["a", "b"]).collect()


def test_a_sheet_of_several_files_keeps_its_order(spark, tmp_path):
    """Files of unequal length, names with numbers, cells over several lines; as CSV and as Parquet."""
    rows = [(f"c{i:03d}", f'line "{i}"\nnext, line') for i in range(60)]
    cuts = {"part-2": rows[:7], "part-9": rows[7:8], "part-10": rows[8:51], "part-11": rows[51:]}
    (tmp_path / "csv").mkdir()
    for name, part in cuts.items():
        body = "".join('%s,"%s"\n' % (a, b.replace('"', '""')) for a, b in part)
        (tmp_path / "csv" / f"{name}.csv").write_text("code,text\n" + body)
    spark.createDataFrame(rows, "code string, text string").repartitionByRange(5, "code").sortWithinPartitions("code").write.parquet(
        str(tmp_path / "parquet"))
    for fmt in ("csv", "parquet"):
        sheet = read_sheet(spark, str(tmp_path / fmt), ["code", "text"], fmt, row_col="row")
        assert sheet.columns == ["code", "text", "row"]
        got = sorted((r["row"], r["code"], r["text"]) for r in sheet.repartition(3).collect())
        assert got == [(i, *row) for i, row in enumerate(rows)]
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "a.csv").write_text("code,text\n")
    assert read_sheet(spark, str(empty), ["code", "text"], row_col="row").count() == 0
