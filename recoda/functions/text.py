"""Scalar text logic: activity description, notes, documents, prompt rendering."""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from recoda.functions import constants as K


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nonempty(c) -> Column:
    """True when the value is neither null nor the empty string."""
    return F.coalesce(_c(c), F.lit("")) != F.lit("")


def lower_if_all_upper(text) -> Column:
    """Lower-case a text only when it is entirely upper-case.

    "Entirely upper-case" needs at least one cased letter: ``''`` and ``'123'``
    are kept, ``'ÉCOLE'`` is lowered.
    """
    t = _c(text)
    return F.when((F.upper(t) == t) & (F.lower(t) != t), F.lower(t)).otherwise(t)


def activity_description(text=K.TEXT, agri=K.AGRI_COLUMN, nature=K.NATURE_COLUMN) -> Column:
    """The activity text plus optional agricultural / other-nature lines."""
    a, n = _c(agri), _c(nature)
    return F.concat(
        lower_if_all_upper(text),
        F.when(nonempty(a), F.concat(F.lit(K.AGRI_LINE_PREFIX), F.lower(a))).otherwise(F.lit("")),
        F.when(nonempty(n), F.concat(F.lit(K.NATURE_LINE_PREFIX), F.lower(n))).otherwise(F.lit("")),
    )


# fixed value: NFKC changes no text without a character from U+00A0 on, alone or with the one before
BEYOND_CONTROLS = r"[^\x00-\x{9f}]"


@pandas_udf(StringType())
def _normalised(s: pd.Series) -> pd.Series:
    return s.str.normalize("NFKC")


def nfkc(text) -> Column:
    """Unicode NFKC normalisation.

    No JVM built-in exists, so it takes Python; but a text of ASCII characters only
    (as many bytes as characters) stays as it is, and only the others are sent there
    (Arrow-batched).  A normalised text is only scanned there, which is cheaper than a
    character class of all that NFKC may change in the JVM.
    """
    text = _c(text)
    affected = F.when((F.octet_length(text) != F.char_length(text)) & text.rlike(BEYOND_CONTROLS), text)
    return F.coalesce(_normalised(affected), text)


def note_of_kind(kind: str, columns: Mapping[str, str] | None = None) -> Column:
    """The note text of one kind; ``include`` joins its two parts by newline.

    Null when every part is null.  Unknown kinds raise.
    """
    if kind not in K.NOTE_KINDS:
        raise ValueError(f"unknown note kind {kind!r}; expected one of {sorted(K.NOTE_KINDS)}")
    names = [(columns or {}).get(c, c) for c in K.NOTE_KINDS[kind]]
    parts = [F.col(c) for c in names]
    if len(parts) == 1:
        return parts[0]
    all_null = parts[0].isNull()
    for p in parts[1:]:
        all_null = all_null & p.isNull()
    return F.when(all_null, F.lit(None).cast("string")).otherwise(F.concat_ws("\n", *parts))


def label_document(code="code", label="label", notes="notes", include="include", not_include="not_include") -> Column:
    """The markdown document describing one new code (empty sections skipped)."""
    n, i, x = _c(notes), _c(include), _c(not_include)
    return F.concat_ws(
        "\n\n",
        F.concat(F.lit("# "), _c(code), F.lit(K.DOC_TITLE_SEPARATOR), _c(label)),
        F.when(nonempty(n), F.concat(F.lit(K.DOC_NOTES_HEADER), n)),
        F.when(nonempty(i), F.concat(F.lit(K.DOC_INCLUDE_HEADER), i)),
        F.when(nonempty(x), F.concat(F.lit(K.DOC_NOT_INCLUDE_HEADER), x)),
    )


def tri_state(flag) -> Column:
    """``True`` / ``False`` / ``undefined`` for a nullable boolean."""
    f = _c(flag)
    t, fl, u = K.TRI_STATE
    return F.when(f, F.lit(t)).when(~f, F.lit(fl)).otherwise(F.lit(u))


def candidate_entry(code, label, include, not_include, notes) -> Column:
    """X11 (mapping form): ``code: label`` newline the non-empty notes, blank-line separated."""
    info = F.concat_ws(
        "\n\n",
        F.when(nonempty(include), include),
        F.when(nonempty(not_include), not_include),
        F.when(nonempty(notes), notes),
    )
    return F.concat(code, F.lit(": "), label, F.lit("\n"), info)


def candidate_block(targets) -> Column:
    """X11 over an ordered array of target structs (code dotted, label, notes)."""
    return F.array_join(
        F.transform(
            _c(targets),
            lambda t: candidate_entry(t["code"], t["label"], t["include"], t["not_include"], t["notes"]),
        ),
        "\n\n",
    )


def retrieved_block(contents) -> Column:
    """X11 (retrieval form): each document prefixed by a rule, blank-line separated."""
    return F.array_join(F.transform(_c(contents), lambda d: F.concat(F.lit(K.RETRIEVED_DOC_PREFIX), d)), "\n\n")


def render(template: str, variables: Mapping[str, Column], user_text: tuple[str, ...] = ()) -> Column:
    """Substitute ``{{name}}`` placeholders of a template.

    Variables named in ``user_text`` are substituted last, so text written by
    users cannot smuggle in a placeholder that a later substitution would fill.
    """
    out = F.lit(template)
    ordered = [k for k in variables if k not in user_text] + [k for k in variables if k in user_text]
    for name in ordered:
        out = F.replace(out, F.lit("{{" + name + "}}"), F.coalesce(variables[name], F.lit("")))
    return out
