"""Recode declarations whose old code has exactly one new code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoda.functions import constants as K
from recoda.functions.codes import undot
from recoda.operators.mapping import unambiguous
from recoda.session import sized_broadcast


def single_target_lookup(mapping: DataFrame) -> DataFrame:
    """(old code, its only new code) for the unambiguous part of the mapping."""
    return unambiguous(mapping).select(
        F.col("code08").alias("__old"), F.get(F.col("targets"), 0)["code"].alias("nace2025")
    )


def recode_unambiguous(extraction: DataFrame, mapping: DataFrame, id_col: str = K.ID, code_col: str = K.OLD_CODE) -> DataFrame:
    """Every declaration whose old code maps to one new code, with that code.

    No deduplication: every input row is kept.  The lookup is the size of a
    nomenclature and is broadcast behind a size check, so the large side is
    never shuffled.
    """
    lookup = sized_broadcast(single_target_lookup(mapping))
    joined = extraction.join(lookup, undot(F.col(code_col)) == lookup["__old"], "inner")
    return joined.select(F.col(id_col), F.col("nace2025"))
