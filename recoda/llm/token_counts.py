"""Token counts per document: a map-side two-tier lookup, without any shuffle of pre-tokens.

Tier one is a broadcast hash table of the corpus's frequent white-space units and
their token counts; tier two is each Python worker's own bounded cache, whose
misses the library encodes.  The table only saves work: its contents never
change a count.  It is built from a bounded sample of the documents
(``sample_docs``), counted inside the sample's tasks, and holds at most
``table_units`` units of at most ``MAX_UNIT_CHARS`` characters, so the broadcast
has a fixed bound (about 64 B a unit) at any input size.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoda.llm.common import batch, map_batches, slices, strings, worker_state
from recoda.llm.tokens import UnitEncoder

MAX_UNIT_CHARS = 32


def frequent_units(
    docs: DataFrame, tokenizer: str, text: str = "text", table_units: int = 50_000, sample_docs: int = 4_000
) -> dict[str, int]:
    """Tier one: the sample's most frequent units and their token counts.

    The sample is drawn over all documents (a row fraction that gives about
    ``sample_docs`` rows); each task returns its own distinct units, so what
    reaches the driver is bounded by the sample.
    """
    total = docs.count()
    if not total:
        return {}
    thin = docs.select(F.col(text).alias("text")).filter("text IS NOT NULL")
    sample = thin.sample(fraction=min(1.0, sample_docs / total), seed=7)
    keep = max(1000, table_units // 4)

    def count(batches):
        enc, seen = UnitEncoder(tokenizer), Counter()
        for rows in batches:
            for t in strings(rows.column("text")):
                seen.update(u for u in enc.units(t) or () if len(u) <= MAX_UNIT_CHARS)
        top = seen.most_common(keep)
        yield batch(unit=("string", [u for u, _ in top]), n=("int64", [n for _, n in top]))

    merged: Counter = Counter()
    for row in map_batches(sample, count, "unit string, n long").toLocalIterator():
        merged[row["unit"]] += row["n"]
        if len(merged) > 20 * table_units:
            merged = Counter(dict(merged.most_common(5 * table_units)))
    units = [u for u, _ in merged.most_common(table_units)]
    return {u: len(b) // 4 for u, b in zip(units, UnitEncoder(tokenizer).unit_ids(units), strict=True)}


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    limit: int = 2048,
    frequent: dict[str, int] | None = None,
) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > ``limit``), one row per input row.

    Counts are the library's own for the whole text, without begin, end or added
    special tokens; special strings inside a text count as the library counts
    them.  A null text is empty (0 bytes, 0 tokens).  Repeated rows and null ids
    stay as they are; an empty table gives no rows.
    """
    table = docs.sparkSession.sparkContext.broadcast(
        frequent_units(docs, tokenizer, text) if frequent is None else frequent
    )

    def count(batches):
        first = table.value
        enc = worker_state(("units", tokenizer, 150_000), lambda: UnitEncoder(tokenizer, 150_000))
        second = worker_state(("counts", tokenizer), dict)
        for rows in batches:
            texts = strings(rows.column("text"))
            counts: list[int] = []
            for a, b in slices(texts):
                split = [enc.units(t) for t in texts[a:b]]
                fresh = list(set().union(*(u for u in split if u is not None)).difference(first, second))
                second.update((x, len(ids) // 4) for x, ids in zip(fresh, enc.unit_ids(fresh), strict=True))
                for t, u in zip(texts[a:b], split, strict=True):
                    if u is None:
                        counts.append(len(enc._ids([t])[0]))
                    else:
                        hits = list(map(first.get, u))
                        n = sum(filter(None, hits))
                        if None in hits:
                            n += sum(second[x] for x, hit in zip(u, hits, strict=True) if hit is None)
                        counts.append(n)
                if len(second) > 400_000:
                    second.clear()
            yield batch(
                doc_id=rows.column("doc_id"),
                n_bytes=("int64", [len(t.encode()) for t in texts]),
                n_tokens=("int64", counts),
                over_limit=("bool_", [n > limit for n in counts]),
            )

    thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = thin.schema["doc_id"].dataType.simpleString()
    return map_batches(thin, count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
