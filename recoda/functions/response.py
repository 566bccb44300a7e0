"""Model answers: parsing / validation (X15) and log-prob confidence.

Parsing is done in stages (``parse_answers`` then ``post_process``), each a
projection over the previous one, so the JSON is parsed once per row and the
code's tokens are computed once -- never inside a lambda evaluated per
candidate position.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from recoda.functions.codes import undot
from recoda.functions.text import tri_state
from recoda.session import process_object

# fixed values: what a lenient JSON validator reads as a boolean
TRUE_WORDS = ("1", "on", "t", "true", "y", "yes")
FALSE_WORDS = ("0", "off", "f", "false", "n", "no")
NUMBER_KINDS = ("TINYINT", "SMALLINT", "INT", "BIGINT", "DECIMAL", "FLOAT", "DOUBLE")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def text_tokens(text) -> Column:
    """Test tokenizer: one token per character, the token id being its code point."""
    return F.transform(F.split(_c(text), ""), lambda ch: F.ascii(ch))


def sequence_confidence(ids, logprobs, target) -> Column:
    """Mean exp(logprob) over the first exact run of ``target`` in ``ids``.

    0.0 when the target is empty, longer than the output, or absent.  The run
    is found with one native string search over the comma-joined ids (the
    delimiters on both sides make it match whole tokens only); the index of
    the run is the number of delimiters before the match.  As a single Column
    it repeats the joined string; ``with_sequence_confidence`` stages it.
    """
    ids, lps, t = _c(ids), _c(logprobs), _c(target)
    hay = F.concat(F.lit(","), F.array_join(ids, ","), F.lit(","))
    needle = F.concat(F.lit(","), F.array_join(t, ","), F.lit(","))
    return _confidence_from(hay, F.position(needle, hay), lps, F.size(ids), F.size(t))


def _confidence_from(hay: Column, at: Column, lps: Column, n: Column, m: Column) -> Column:
    before = F.substring(hay, 1, at)
    start = F.length(before) - F.length(F.replace(before, F.lit(","), F.lit(""))) - 1
    mean = F.aggregate(F.slice(lps, start + 1, m), F.lit(0.0), lambda s, x: s + F.exp(x)) / m
    return F.when((m == 0) | (n < m) | (at == 0), F.lit(0.0)).otherwise(mean).cast("double")


def with_sequence_confidence(df: DataFrame, ids: str, logprobs: str, target: str, out: str = "confidence") -> DataFrame:
    """X16 as staged projections: the joined ids and the match position are computed once per row."""
    staged = df.withColumn("__hay", F.concat(F.lit(","), F.array_join(F.col(ids), ","), F.lit(","))).withColumn(
        "__at", F.position(F.concat(F.lit(","), F.array_join(F.col(target), ","), F.lit(",")), F.col("__hay"))
    )
    conf = _confidence_from(F.col("__hay"), F.col("__at"), F.col(logprobs), F.size(ids), F.size(target))
    return staged.withColumn(out, conf).drop("__hay", "__at")


def _field(name: str) -> tuple[Column, Column]:
    """Kind and text of a field of the parsed answer; a missing field and a JSON null are both ``VOID``."""
    raw = F.try_variant_get("__v", f"$.{name}", "variant")
    kind = F.regexp_extract(F.coalesce(F.schema_of_variant(raw), F.lit("VOID")), "^([A-Z]+)", 1)
    return kind, F.try_variant_get("__v", f"$.{name}", "string")


def _lax_boolean(kind: Column, text: Column) -> Column:
    """What a lenient validator reads as a boolean: JSON booleans, 0 and 1, a few words; else null."""
    number = text.try_cast("double")
    word = F.lower(text)
    return (
        F.when(kind == "BOOLEAN", text == "true")
        .when(kind.isin(*NUMBER_KINDS), F.when(number == 1, F.lit(True)).when(number == 0, F.lit(False)))
        .when(kind == "STRING", F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False)))
    )


def parse_answers(df: DataFrame, text_col: str = "output_text", with_nace08: bool = True) -> DataFrame:
    """X15 first stage: the typed fields and the validity of each answer.

    An answer is valid when its whole text is one JSON object in which
    ``codable`` is a boolean, ``nace2025`` a string or absent, ``nace08_valid``
    (mapping answers only) a boolean or absent, ``confidence`` a number or
    absent, and a codable answer carries a non-empty code.  Null counts as
    absent; booleans and numbers may also be written as strings; of a repeated key
    the last value counts (this sets ``spark.sql.variant.allowDuplicateKeys`` in the
    session).  Adds ``__codable, __code, __nace08, __keep`` (keep = valid and a code
    is present).
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    # one pass for the syntax (from_json alone would take single quotes and text after the object)
    whole = F.when(F.col(text_col).rlike(r"^\s*\{(?s:.*)\}\s*$"), F.col(text_col))
    j = df.withColumn("__v", F.try_parse_json(whole))
    kinds = {n: _field(n) for n in ("codable", "nace2025", "nace08_valid", "confidence")}
    f = j.select(
        "*",
        *[k.alias(f"__k_{n}") for n, (k, _) in kinds.items()],
        *[t.alias(f"__t_{n}") for n, (_, t) in kinds.items()],
    )
    f = f.withColumns({
        "__codable": _lax_boolean(F.col("__k_codable"), F.col("__t_codable")),
        "__nace08": _lax_boolean(F.col("__k_nace08_valid"), F.col("__t_nace08_valid")) if with_nace08
        else F.lit(None).cast("boolean"),
        "__code": F.when(F.col("__k_nace2025") == "STRING", F.col("__t_nace2025")),
    })
    absent = {n: F.col(f"__k_{n}") == "VOID" for n in kinds}
    number = F.col("__k_confidence").isin(*NUMBER_KINDS, "BOOLEAN") | (
        (F.col("__k_confidence") == "STRING") & F.col("__t_confidence").try_cast("double").isNotNull()
    )
    valid = (
        F.col("__v").isNotNull()
        & F.col("__codable").isNotNull()
        & (absent["nace2025"] | F.col("__code").isNotNull())
        & (F.lit(not with_nace08) | absent["nace08_valid"] | F.col("__nace08").isNotNull())
        & (absent["confidence"] | number)
        & ~(F.col("__codable") & (F.coalesce(F.col("__code"), F.lit("")) == ""))
    )
    keep = F.coalesce(valid, F.lit(False)) & F.col("__code").isNotNull()
    return f.withColumn("__keep", keep).drop("__v", *[f"__{p}_{n}" for n in kinds for p in "kt"])


def python_tokenizer(
    tokenizer: Callable, per_worker: bool = False, model_key: str | None = None
) -> Callable[[Column], Column]:
    """A ``tokenize`` for ``post_process`` from a user's tokenizer (a batch of texts -> their token ids).

    With ``per_worker``, ``tokenizer`` is a factory that a worker process calls once
    (for all jobs with the same ``model_key``), as for predictors.
    """
    name = model_key or uuid.uuid4().hex

    @pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        cut = process_object("tokenizer", name, tokenizer) if per_worker else tokenizer
        present = texts.notna()
        out = pd.Series([None] * len(texts), index=texts.index, dtype=object)
        out[present] = pd.Series([list(t) for t in cut(texts[present].tolist())], index=texts.index[present], dtype=object)
        return out

    return ids


def post_process(df: DataFrame, text_col: str = "output_text", ids_col: str | None = "token_ids",
                 lps_col: str | None = "logprobs", keep: tuple[str, ...] = (), tokenize=text_tokens,
                 with_nace08: bool = True) -> DataFrame:
    """X15 + X16 + X1 + X9: the stored fields of every answer.

    Invalid answers and answers without a code fall back to
    ``codable=false, nace2025=null, confidence=0.0`` (and ``nace08_valid`` reads
    ``undefined``); a stated confidence is always replaced by the log-prob
    confidence of the code's tokens.
    """
    p = parse_answers(df, text_col, with_nace08)
    if ids_col is not None:
        p = p.withColumn("__t", F.when(F.col("__keep"), tokenize(F.col("__code"))))
        p = with_sequence_confidence(p, ids_col, lps_col, "__t", "__conf")
    cols = [F.col(c) for c in keep]
    cols.append(F.when(F.col("__keep"), F.col("__codable")).otherwise(F.lit(False)).alias("codable"))
    cols.append(F.when(F.col("__keep"), undot(F.col("__code"))).alias("nace2025"))
    if with_nace08:
        cols.append(tri_state(F.when(F.col("__keep"), F.col("__nace08"))).alias("nace08_valid"))
    if ids_col is not None:
        cols.append(F.when(F.col("__keep"), F.col("__conf")).otherwise(F.lit(0.0)).alias("confidence"))
    return p.select(*cols)


def answer_status(df: DataFrame, text_col: str = "output_text") -> DataFrame:
    """Counts of answers by outcome: codable, declined with a code, fallback."""
    p = parse_answers(df, text_col)
    status = (
        F.when(F.col("__keep") & F.col("__codable"), F.lit("codable"))
        .when(F.col("__keep"), F.lit("declined_with_code"))
        .otherwise(F.lit("fallback"))
    )
    return p.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))
