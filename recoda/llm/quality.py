"""Quality rules: base counts of every text, and cross-document line frequency per host.

Lines are normalised and hashed; for every host (the ``source`` column) the
documents that hold a line are counted, equal texts once, as a copy says nothing
new about the site's layout.  A line in more than ``min_docs`` documents of a host
is boilerplate, in small and hot hosts alike, and is removed; a document that loses
more than half its words that way is depleted and rejected.  Lines of over
``long_words`` words are prose, which near copies share: for them, texts with the
same longest line, the counted one left out, count once, so that a family of near
copies is left to the dedup operators.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoda.llm.common import batch, map_batches, stored, strings, text_hash

_SPACE = re.compile(r"[ \t-\r]+")
_DIGITS = re.compile(r"[0-9]+")
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class LineLimits:
    """A line of more than ``min_docs`` documents of its host goes; so does a document that loses over ``max_lost_share``."""

    min_docs: int = 10
    long_words: int = 25
    max_lost_share: float = 0.5


def normal_line(line: str) -> str:
    """Lower case, single blanks, every run of digits as 0."""
    return _DIGITS.sub("0", _SPACE.sub(" ", line).strip(" ").lower())


def repeated_words(words: list) -> int:
    """Words that lie in a 3-word window found twice or more, first occurrences included."""
    import numpy as np

    n = len(words)
    if n < 4:
        return 0
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    base = len(number)
    pairs = ids[:-1] * base + ids[1:]
    if base >= 2**20:  # keep the triple's code below 2^63
        pairs = np.unique(pairs, return_inverse=True)[1]
    codes = pairs[:-1] * base + ids[2:]
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    hit = np.zeros(n, bool)
    hit[:-2] |= twice
    hit[1:-1] |= twice
    hit[2:] |= twice
    return int(hit.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.encode().split()  # bytes split at exactly the six ASCII white-space characters
    spaces = sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines = [x for x in text.split("\n") if x.encode().split()]
    symbols = sum(map(text.count, SYMBOLS))
    return len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeated_words(words)


def counted_lines(text: str, limits: LineLimits) -> tuple[list[dict], list[bytes]]:
    """Each normalised line (key, words in this text, long), and the keys of the two longest, equal lengths by their bytes."""
    import xxhash

    found: dict[bytes, dict] = {}
    for line in text.split("\n"):
        n = len(line.encode().split())
        if n:
            normal = normal_line(line).encode()
            entry = found.setdefault(normal, {"key": None, "words": 0, "long": n > limits.long_words})
            entry["words"] += n
    for normal, entry in found.items():
        entry["key"] = xxhash.xxh3_128_digest(normal)
    longest = heapq.nsmallest(2, found, key=lambda x: (-len(x), x))
    return list(found.values()), [found[x]["key"] for x in longest]


def strip_lines(text: str, keys: set[bytes]) -> str:
    """``text`` without the lines whose key is in ``keys``."""
    import xxhash

    return "\n".join(
        line
        for line in text.split("\n")
        if not (line.encode().split() and xxhash.xxh3_128_digest(normal_line(line).encode()) in keys)
    )


def _measured(docs: DataFrame, limits: LineLimits, doc_id: str, text: str, host: str) -> DataFrame:
    """One stored row per document: its counts, a 128-bit key of its text, its lines."""

    def measure(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("key", pa.binary()), ("words", pa.int32()), ("long", pa.bool_())]))
        for rows in batches:
            counts, lines, longest = [], [], []
            for t in strings(rows.column("text")):
                counts.append(base_counts(t))
                found, top = counted_lines(t, limits)
                lines.append(found)
                longest.append(top)
            columns = list(zip(*counts, strict=True)) if counts else [[]] * 5
            kept = {c: rows.column(c) for c in ("doc_id", "host", "th1", "th2")}
            yield batch(
                **kept,
                **{c: ("int64", v) for c, v in zip(COUNTS, columns, strict=True)},
                lines=pa.array(lines, kind),
                longest=pa.array(longest, pa.list_(pa.binary())),
            )

    body = F.col(text)
    thin = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(host).cast("string").alias("host"), body.alias("text"),
        *[h.alias(n) for h, n in zip(text_hash(body), ("th1", "th2"), strict=True)],
    )
    kind = thin.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in COUNTS)
    schema = (
        f"doc_id {kind}, host string, th1 long, th2 long, {counts}, "
        "lines array<struct<key binary, words int, long boolean>>, longest array<binary>"
    )
    return stored(map_batches(thin, measure, schema), "quality")


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _removed(measured: DataFrame, limits: LineLimits) -> DataFrame:
    """(host, th1, th2, removed words, removed keys) of texts with boilerplate lines."""
    text_key = ["host", "th1", "th2"]
    first, second = F.get("longest", F.lit(0)), F.get("longest", F.lit(1))
    other = F.when(F.col("l.long"), F.when(F.col("l.key") == first, second).otherwise(first))
    lines = measured.select(*text_key, "longest", F.explode("lines").alias("l")).select(
        *text_key, F.col("l.key").alias("key"), F.col("l.words").alias("words"), other.alias("other")
    )
    lines = lines.distinct()  # equal texts of a host count once
    # a long line with no other line in its text counts by the text, as a short one does
    counted = lines.select(
        "host", "key", "other", *[F.when(F.col("other").isNull(), F.col(c)).alias(c) for c in ("th1", "th2")]
    )
    held = counted.distinct().groupBy("host", "key").agg(F.count(F.lit(1)).alias("n_docs"))
    # stored, so that the join deals both sides anew and a line of very many documents can be split
    frequent = held.filter(F.col("n_docs") > limits.min_docs)
    frequent = stored(frequent.select(F.col("host").alias("of_host"), F.col("key").alias("of_key")), "boilerplate")
    hits = lines.join(frequent, F.col("host").eqNullSafe(F.col("of_host")) & (F.col("key") == F.col("of_key")))
    return hits.groupBy(*text_key).agg(F.sum("words").alias("removed_words"), F.collect_list("key").alias("keys"))


def _verdicts(measured: DataFrame, limits: LineLimits) -> DataFrame:
    removed = _removed(measured, limits).select(
        *[F.col(c).alias(f"r_{c}") for c in ("host", "th1", "th2")], "removed_words", "keys"
    )
    same = F.col("host").eqNullSafe(F.col("r_host")) & (F.col("th1") == F.col("r_th1")) & (F.col("th2") == F.col("r_th2"))
    lost = F.coalesce(F.col("removed_words"), F.lit(0)).cast("long")
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    depleted = lost > F.lit(limits.max_lost_share) * F.col("n_words")
    return (
        measured.drop("lines", "longest")
        .join(removed, same, "left")
        .select(
            "doc_id", "host", "th1", "th2", *COUNTS, base.alias("base_failed"),
            (~base & ~depleted).alias("kept"), lost.alias("n_boilerplate_words"), "keys",
        )
    )


def judge_quality(
    docs: DataFrame,
    limits: LineLimits = LineLimits(),  # noqa: B008
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
) -> DataFrame:
    """doc_id, the five counts, base_failed, kept, n_boilerplate_words: one row per input row.

    A null text has no words and fails the base rules.  A null host is a host of
    its own.  Repeated rows are judged alike, each in its row; an empty table
    gives no rows.
    """
    verdicts = _verdicts(_measured(docs, limits, doc_id, text, host), limits)
    return verdicts.select("doc_id", *COUNTS, "base_failed", "kept", "n_boilerplate_words")


def filter_quality(
    docs: DataFrame,
    limits: LineLimits = LineLimits(),  # noqa: B008
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
) -> DataFrame:
    """The rows of ``docs`` that pass, with boilerplate lines taken out of their texts.

    Only the text column changes.  The verdict depends on host and text alone, so
    rows that share both share it.
    """
    verdicts = _verdicts(_measured(docs, limits, doc_id, text, host), limits)
    kept = verdicts.filter("kept").select(
        F.col("host").alias("__h"), F.col("th1").alias("__t1"), F.col("th2").alias("__t2"), F.col("keys").alias("__keys")
    )
    kept = kept.dropDuplicates(["__h", "__t1", "__t2"])
    t1, t2 = text_hash(F.col(text))
    same = F.col(host).cast("string").eqNullSafe(F.col("__h")) & (t1 == F.col("__t1")) & (t2 == F.col("__t2"))
    joined = docs.join(kept, same).select(*docs.columns, "__keys")
    clean = joined.filter("__keys IS NULL").drop("__keys")

    names = docs.columns

    def strip(batches):
        import pyarrow as pa

        for rows in batches:
            texts = zip(rows.column(text).to_pylist(), rows.column("__keys").to_pylist(), strict=True)
            cut = pa.array([strip_lines(t, set(k)) for t, k in texts], pa.string())
            columns = {c: rows.column(c) for c in names}
            columns[text] = cut
            yield batch(**columns)

    schema = joined.drop("__keys").schema
    cut = map_batches(joined.filter("__keys IS NOT NULL"), strip, schema)
    return clean.unionByName(cut)
