"""The correspondence old code -> new codes, with explanatory notes (Q3, Q4).

The nested mapping has one row per old code::

    code08 string, label08 string, n_targets int,
    targets array<struct<pos:long, code:string, label:string,
                         include:string, not_include:string, notes:string>>

Codes are undotted.  Both inputs are reference sheets bounded by the size of a
nomenclature; the notes side of the join is broadcast behind a size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoda.functions import constants as K
from recoda.functions.codes import undot
from recoda.functions.text import nfkc, note_of_kind
from recoda.operators.dedup import duplicate_keys, first_per_key, require_empty
from recoda.session import ship_package, sized_broadcast


def normalise_correspondence(sheet: DataFrame, pos_col: str | None = None) -> DataFrame:
    """Pick the six correspondence columns by position and name them.

    ``pos_col`` (a sheet row number) is carried along when given, because the
    order of targets inside an old code is the order of the sheet rows.
    """
    cols = sheet.columns
    out = [F.col(cols[i]).cast("string").alias(name) for name, i in K.CORRESPONDENCE_POSITIONS.items()]
    if pos_col:
        out.append(F.col(pos_col).alias("pos"))
    return sheet.select(*out)


def normalise_notes(sheet: DataFrame, pos_col: str | None = None) -> DataFrame:
    """The explanatory-notes columns under short names (``code25`` holds the 2025 code)."""
    out = [F.col(f"`{src}`").cast("string").alias(dst) for src, dst in K.NOTES_SHEET_COLUMNS.items()]
    if pos_col:
        out.append(F.col(pos_col).alias("pos"))
    return sheet.select(*out)


def notes_by_code(notes: DataFrame) -> DataFrame:
    """J10 + X6 + X7: one row per new code with its include / not_include / notes texts.

    The first sheet row wins for a repeated code, so ``notes`` needs ``pos``, its
    row number, whenever a code is repeated (else such a code is an error).  NFKC normalisation runs on
    this small, deduplicated table only.
    """
    ship_package(notes.sparkSession)
    if "pos" not in notes.columns:
        require_empty(duplicate_keys(notes, ["code25"]), "repeated note codes, and no row number to choose the first")
    first = first_per_key(notes, ["code25"], ["pos"] if "pos" in notes.columns else [])
    kinds = {kind: nfkc(note_of_kind(kind)) for kind in K.NOTE_KINDS}
    return first.select(
        undot("code25").alias("code25"),
        F.col("title"),
        kinds["include"].alias("include"),
        kinds["not_include"].alias("not_include"),
        kinds["notes"].alias("notes"),
    )


def missing_notes(correspondence: DataFrame, notes: DataFrame) -> DataFrame:
    """New codes of the correspondence with no explanatory note (the lookup must not miss)."""
    codes = correspondence.select(undot("naf25_niv5").alias("code25")).distinct()
    return codes.join(notes.select(undot("code25").alias("code25")), "code25", "left_anti")


def nested_mapping(correspondence: DataFrame, notes: DataFrame, strict: bool = True) -> DataFrame:
    """M1: group the flat correspondence into one row per old code.

    The old label is the one of the first sheet row; targets keep sheet order
    and repeated (old, new) pairs are kept, so they count towards ambiguity.
    Rows with a null old code are dropped, as a grouping by code drops them.
    A new code without explanatory notes is an error (J10) unless ``strict`` is off.
    """
    if strict:
        require_empty(missing_notes(correspondence, notes), "new codes without explanatory notes")
    corr = correspondence
    if "pos" not in corr.columns:
        corr = corr.withColumn("pos", F.monotonically_increasing_id())
    corr = corr.filter(F.col("naf08_niv5").isNotNull()).select(
        undot("naf08_niv5").alias("code08"),
        F.col("lib_naf08_niv5").alias("label08"),
        undot("naf25_niv5").alias("code25"),
        F.col("lib_naf25_niv5").alias("label25"),
        F.col("pos").cast("long").alias("pos"),
    )
    notes_small = sized_broadcast(notes_by_code(notes))
    enriched = corr.join(notes_small, "code25", "left")
    target = F.struct(
        F.col("pos"),
        F.col("code25").alias("code"),
        F.col("label25").alias("label"),
        F.col("include"),
        F.col("not_include"),
        F.col("notes"),
    )
    grouped = enriched.groupBy("code08").agg(
        F.min_by("label08", "pos").alias("label08"),
        F.array_sort(F.collect_list(target)).alias("targets"),
    )
    return grouped.select("code08", "label08", F.size("targets").alias("n_targets"), "targets")


def unambiguous(mapping: DataFrame) -> DataFrame:
    """old codes with exactly one target."""
    return mapping.filter(F.col("n_targets") == 1)


def ambiguous(mapping: DataFrame) -> DataFrame:
    """old codes with several targets (the ones a model must decide)."""
    return mapping.filter(F.col("n_targets") > 1)


def unique_targets(mapping: DataFrame) -> DataFrame:
    """D3: every new code once, taken from its first occurrence (old code, then sheet order)."""
    flat = mapping.select("code08", F.posexplode("targets").alias("k", "t")).select(
        F.col("t.code").alias("code"),
        F.col("code08"),
        F.col("t.pos").alias("pos"),
        F.col("t.label").alias("label"),
        F.col("t.include").alias("include"),
        F.col("t.not_include").alias("not_include"),
        F.col("t.notes").alias("notes"),
    )
    return first_per_key(flat, ["code"], ["code08", "pos"]).drop("pos")


def mapping_pairs(mapping: DataFrame) -> DataFrame:
    """Distinct (old code, new code) pairs of the mapping."""
    return mapping.select("code08", F.explode("targets.code").alias("code25")).distinct()


def with_mapping_ok(df: DataFrame, mapping: DataFrame, old_col: str, new_col: str, out: str = "mapping_ok") -> DataFrame:
    """Is (old, new) a pair of the correspondence?  A missing old code gives false."""
    pairs = sized_broadcast(mapping_pairs(mapping).withColumn("__hit", F.lit(True)))
    joined = df.join(
        pairs,
        (undot(F.col(old_col)) == pairs["code08"]) & (undot(F.col(new_col)) == pairs["code25"]),
        "left",
    )
    return joined.withColumn(out, F.coalesce(F.col("__hit"), F.lit(False))).drop("code08", "code25", "__hit")
