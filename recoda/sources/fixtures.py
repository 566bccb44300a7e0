"""Stand-in inputs derived from the driver's TPC-H-like tables.

The real inputs (declarations, correspondence sheet, notes, human labels,
model outputs) are not public, so each is derived, in full, from a table of
``/root/testdata/sf*/``: every part gives an old code with one to three new
codes, every line item a declaration, every finished line item a human label,
every order three model predictions.  Nothing is subset by id; the work of
every query grows with the tables.  The same derivations are written in SQL in
``recoda.plans.oracle`` for the DuckDB check.

Code rules (undotted, four digits then a letter):
  old code of n: ``lpad(floor(n/3) mod 10000, 4) || chr(65 + n mod 3)``
  new code of n: ``lpad(floor(n/2) mod 10000, 4) || chr(70 + n mod 4)``
Codes repeat every 30,000 parts, as a nomenclature does not grow with its use:
the sheet holds each (old code, new code, k) once, from the first part that has
it.  For every third part the targets k = 0 and k = 1 are one new code, so a
fixed share of pairs stays repeated and counts towards ambiguity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recoda.functions.codes import dot
from recoda.operators.dedup import first_per_key
from recoda.sources.tables import read_table

MODELS = ("a", "b", "c")
MODEL_WEIGHTS = (2.0, 2.0, 1.0)
# names as real models have them
MODEL_NAMES = {"a": "org-a/model-2.5-32B.chat", "b": "model--b-1.0", "c": "c`s model.v3"}
# (null when id mod this is 0, spread of the chosen target)
MODEL_RULES = {"a": (11, 2), "b": (7, 3), "c": (5, 4)}


def _code(n: Column, div: int, letter0: int, mod: int) -> Column:
    digits = F.lpad((F.floor(n / F.lit(div)).cast("long") % 10000).cast("string"), 4, "0")
    return F.concat(digits, F.char((F.lit(letter0) + n % mod).cast("long")))


def code08(n: Column) -> Column:
    return _code(n, 3, 65, 3)


def code25(n: Column) -> Column:
    return _code(n, 2, 70, 4)


def target_of(n: Column, k: Column) -> Column:
    """Index of the k-th new code of old code n (neighbouring old codes share new codes)."""
    return F.floor((F.lit(2) * n + k) / F.lit(3)).cast("long")


_TABLES: dict[tuple[str, str, str], DataFrame] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table, read once per application (the file listing is not repeated)."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _TABLES:
        _TABLES[key] = read_table(spark, sf_dir, name)
    return _TABLES[key]


def correspondence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat correspondence sheet (P1 names, dotted codes) plus a sheet row ``pos``."""
    part = load(spark, sf_dir, "part")
    rows = part.select("p_partkey", "p_name", "p_type", "p_brand",
                       F.explode(F.sequence(F.lit(0).cast("long"), F.col("p_partkey") % 3)).alias("k"))
    old = dot(code08(F.col("p_partkey")))
    new = dot(code25(target_of(F.col("p_partkey"), F.col("k"))))
    sheet = rows.select(
        old.alias("naf08_niv5"),
        F.substring(old, 1, 5).alias("naf08_niv4"),
        F.concat(F.lit("old "), F.col("p_name")).alias("lib_naf08_niv5"),
        new.alias("naf25_niv5"),
        F.substring(new, 1, 5).alias("naf25_niv4"),
        F.concat(F.lit("new "), F.col("p_type"), F.lit(" "), F.col("p_brand")).alias("lib_naf25_niv5"),
        (F.col("p_partkey") * 3 + F.col("k")).alias("pos"),
        "k",
    )
    return first_per_key(sheet, ["naf08_niv5", "naf25_niv5", "k"], ["pos"]).drop("k")


def notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The explanatory notes (P2 names), one row per new code, some parts missing."""
    p = load(spark, sf_dir, "part")
    n = F.col("p_partkey")
    return p.select(
        dot(code25(n)).alias("code25"),
        F.concat(F.lit("title "), F.col("p_name")).alias("title"),
        F.when(n % 5 != 0, F.concat(F.lit("general "), F.col("p_type"))).alias("note_generale"),
        # a ligature and a superscript, which the notes' NFKC turns into plain letters and digits
        F.when(n % 2 == 0, F.concat(F.lit("includes "), F.col("p_name"), F.lit(" \ufb01n\u00b2"))).alias("comprend"),
        F.when(n % 3 == 0, F.concat(F.lit("also "), F.col("p_brand"))).alias("comprend_aussi"),
        F.when(n % 4 == 0, F.concat(F.lit("excludes "), F.col("p_type"))).alias("ne_comprend_pas"),
        n.alias("pos"),
    )


def extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declarations: one per line item, with ``row_seq`` for a total dedup order."""
    li = load(spark, sf_dir, "lineitem")
    part = load(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    j = li.join(part, li["l_partkey"] == part["p_partkey"])
    pk = F.col("l_partkey")
    return j.select(
        F.col("l_orderkey").cast("string").alias("liasse_numero"),
        F.col("l_linenumber").alias("row_seq"),
        code08(pk).alias("apet_finale"),
        F.when(F.col("l_linenumber") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")).alias("libelle"),
        F.col("l_returnflag").alias("evenement_type"),
        (F.col("l_suppkey") % 3).cast("string").alias("cj"),
        F.when(F.col("l_quantity") >= 10, F.lit("N")).alias("activ_nat_et"),
        F.col("l_linestatus").alias("liasse_type"),
        F.floor(F.col("l_quantity") / 25).cast("int").cast("string").alias("activ_surf_et"),
        F.when(pk % 5 == 0, F.col("p_type")).alias("activ_sec_agri_et"),
        F.when(pk % 7 == 0, F.col("p_brand")).alias("activ_nat_lib_et"),
        (pk % 2).cast("string").alias("activ_perm_et"),
    )


def ground_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Human labels: every finished line item (status F) is annotated."""
    li = load(spark, sf_dir, "lineitem").filter(F.col("l_linestatus") == "F")
    return li.select(
        F.col("l_orderkey").cast("string").alias("liasse_numero"),
        F.col("l_linenumber").alias("g_seq"),
        code25(target_of(F.col("l_partkey"), F.col("l_orderkey") % 3)).alias("apet_manual"),
        code08(F.col("l_partkey")).alias("NAF2008_code"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three models' predictions for every order: ``(model, liasse_numero, nace2025, codable)``."""
    li = load(spark, sf_dir, "lineitem")
    base = li.groupBy("l_orderkey").agg(F.min("l_partkey").alias("on"))
    ident = F.col("l_orderkey")
    parts = []
    for m in MODELS:
        null_mod, spread = MODEL_RULES[m]
        code = F.when(ident % null_mod == 0, F.lit(None).cast("string")).otherwise(
            code25(target_of(F.col("on"), ident % spread))
        )
        parts.append(
            base.select(
                F.lit(m).alias("model"),
                ident.cast("string").alias("liasse_numero"),
                code.alias("nace2025"),
                (code.isNotNull() & (ident % 13 != 0)).alias("codable"),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _json_code(code: Column) -> Column:
    return F.when(code.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), dot(code), F.lit('"')))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw model answers for model ``a`` in thirteen shapes (valid, not JSON, no flag, text
    after the object, wrong quotes, ill-typed fields, lenient booleans, a repeated key, ...), with their
    (character) token ids and log-probs."""
    p = predictions(spark, sf_dir).filter(F.col("model") == "a")
    ident = F.col("liasse_numero").cast("long")
    cj = _json_code(F.col("nace2025"))
    case = ident % 13
    text = (
        F.when(case == 0, F.concat(F.lit('{"codable": true, "nace2025": '), cj, F.lit(', "nace08_valid": '),
                                   F.when(ident % 4 == 0, F.lit("false")).otherwise(F.lit("true")), F.lit("}")))
        .when(case == 1, F.concat(F.lit("codable: yes, code "), F.coalesce(dot(F.col("nace2025")), F.lit("none"))))
        .when(case == 2, F.concat(F.lit('{"nace2025": '), cj, F.lit("}")))
        .when(case == 3, F.lit('{"codable": true}'))
        .when(case == 4, F.concat(F.lit('{"codable": false, "nace2025": '), cj, F.lit("}")))
        .when(case == 5, F.concat(F.lit('{"codable": "true", "nace2025": '), cj, F.lit(', "confidence": 0.9}')))
        .when(case == 6, F.concat(F.lit('{"codable": true, "nace2025": '), cj, F.lit("} as asked")))
        .when(case == 7, F.concat(F.lit("{'codable': true, 'nace2025': "), cj, F.lit("}")))
        .when(case == 8, F.lit('{"codable": true, "nace2025": 111}'))
        .when(case == 9, F.concat(F.lit('{"codable": true, "nace2025": {"a": '), cj, F.lit("}}")))
        .when(case == 10, F.concat(F.lit('{"codable": true, "nace2025": '), cj, F.lit(', "confidence": "high"}')))
        .when(case == 11, F.concat(F.lit('{"codable": false, "nace2025": "00.00Z", "codable": true, "nace2025": '), cj, F.lit("}")))
        .otherwise(F.concat(F.lit('{"codable": '), F.when(ident % 4 == 3, F.lit('"On"')).otherwise(F.lit("1.0")),
                            F.lit(', "nace2025": '), cj, F.lit(', "nace08_valid": "no"}')))
    )
    texts = p.select("liasse_numero", text.alias("output_text"))
    tokens = texts.withColumn("token_ids", F.transform(F.split("output_text", ""), lambda ch: F.ascii(ch)))
    return tokens.withColumn("logprobs", F.transform("token_ids", lambda t, i: -(i % 10) / F.lit(10.0)))
