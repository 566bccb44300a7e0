"""Scalar logic on activity codes (Column -> Column).

Codes are stored undotted (``NNNNX``) everywhere and dotted (``NN.NNX``) only
when rendered into text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recoda.functions.constants import QUOTED_CODE_PATTERN


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def undot(code) -> Column:
    """Strip the dots of a code."""
    return F.replace(_c(code), F.lit("."), F.lit(""))


def dot(code) -> Column:
    """Insert a dot after the first two characters of an undotted code."""
    c = _c(code)
    return F.concat(F.substring(c, 1, 2), F.lit("."), F.substr(c, F.lit(3)))


def prefix(code, n: int) -> Column:
    """The first ``n`` characters (the code at hierarchy level ``n``)."""
    return F.substring(_c(code), 1, n)


def quoted_list(codes) -> Column:
    """``'01.11Z', '02.20A'`` from an array of (dotted) codes, in array order."""
    return F.array_join(F.transform(_c(codes), lambda c: F.concat(F.lit("'"), c, F.lit("'"))), ", ")


def quoted_codes_in(text) -> Column:
    """Every quoted dotted code found in a rendered prompt, undotted, in order."""
    found = F.regexp_extract_all(_c(text), F.lit(QUOTED_CODE_PATTERN), 1)
    return F.transform(found, lambda c: F.replace(c, F.lit("."), F.lit("")))


def label_covered(codes, label) -> Column:
    """X14 flag: is the label among the candidates (null label or list -> false)."""
    return F.coalesce(F.array_contains(_c(codes), _c(label)), F.lit(False))


def label_position(codes, label) -> Column:
    """X14 position: 0-based index of the label's first occurrence, null when absent."""
    return F.nullif(F.array_position(_c(codes), _c(label)), F.lit(0)) - F.lit(1)
