"""Benchmark decontamination by winnowing.

Words are lower-cased; a window is ``window`` consecutive words of an item (a
shorter item is one window).  Of every window's k-grams the smallest hash is kept
as its fingerprint.  Two equal windows choose the same k-gram, so every shared
span of a window's length or more has a fingerprint on both sides.  Documents
look up the fingerprints of their windows, and each hit is extended to the whole
window by comparing words, so hashes only save work.

A benchmark of at most ``block_bytes`` of text (added up by Spark first) is broadcast
whole, and documents are read once without a shuffle.  A larger one never reaches the
driver: its windows and fingerprints are made in tasks and stored, the documents'
fingerprints are joined with them, and only documents that met one are cut into the
windows around it, which are joined by their bytes.  The benchmark's side of each join
is distinct and stored, so that a frequent fingerprint or window can be split.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from recoda.llm.common import batch, map_batches, stored, strings

# Separators become blanks and A-Z lower case; bytes of longer UTF-8 characters stay.
_WORD_BYTES = bytes(
    (c + 32 if 65 <= c <= 90 else c) if c >= 128 or 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 else 32
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lowered, as UTF-8."""
    return text.encode().translate(_WORD_BYTES).split() if text else []


def gram_hashes(ids, k: int):
    """A 64-bit hash of every k-gram of word numbers."""
    import numpy as np

    n = len(ids) - k + 1
    mixed = (ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(31)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x100000001B3) + mixed[j : j + n]
    return out ^ (out >> np.uint64(29))


def fingerprints(ids, starts, length: int):
    """Smallest k-gram hash of the windows of ``length`` words at ``starts``; k is half a window."""
    import numpy as np

    k = (length + 1) // 2
    grams = gram_hashes(ids, k)
    return np.lib.stride_tricks.sliding_window_view(grams, length - k + 1)[starts].min(axis=1)


def make_block(items: list[tuple[str, list[bytes]]], window: int) -> tuple[dict, dict]:
    """Word numbers of some items, and by window length: fingerprints, windows and the items that own them."""
    import numpy as np

    number: dict[bytes, int] = {}
    by_words: dict[tuple[int, ...], set[str]] = {}
    for item, words in items:
        ids = tuple(number.setdefault(w, len(number)) for w in words)
        if ids:
            by_words.setdefault(ids, set()).add(item)  # equal items once
    lengths: dict[int, list] = {}
    for ids, names in by_words.items():
        lengths.setdefault(min(len(ids), window), []).append((np.array(ids, np.int64), sorted(names)))
    sizes = {}
    for length, group in lengths.items():
        starts = [np.arange(len(ids) - length + 1) for ids, _ in group]
        prints = [fingerprints(ids, at, length) for (ids, _), at in zip(group, starts, strict=True)]
        rows = [np.lib.stride_tricks.sliding_window_view(ids, length) for ids, _ in group]
        owners = np.repeat(np.arange(len(group)), [len(at) for at in starts])
        windows, which = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
        owned = np.unique(np.stack([which.ravel(), owners], axis=1), axis=0)
        hashes = np.concatenate([gram_hashes(w, length) for w in windows])
        order = np.argsort(hashes, kind="stable")
        bounds = np.searchsorted(owned[:, 0], np.arange(len(windows) + 1))
        sizes[length] = (
            np.unique(np.concatenate(prints)), hashes[order], windows[order], order, bounds, owned[:, 1],
            [names for _, names in group],
        )
    return number, sizes


def search_block(block: tuple[dict, dict], words: list[bytes]):
    """Mask of the words inside occurrences of the block's windows, and the items they belong to."""
    import numpy as np

    number, sizes = block
    ids = np.fromiter((number.get(w, -1) for w in words), np.int64, len(words))
    hit, items = np.zeros(len(ids), bool), set()
    unknown = np.concatenate([[0], np.cumsum(ids < 0)])
    for length, (prints, hashes, windows, order, bounds, owners, names) in sizes.items():
        if len(ids) < length:
            continue
        starts = np.flatnonzero(unknown[length:] == unknown[:-length])  # windows of known words only
        if starts.size:
            found = fingerprints(ids, starts, length)
            at = np.minimum(np.searchsorted(prints, found), len(prints) - 1)
            starts = starts[prints[at] == found]
        if not starts.size:
            continue
        # a fingerprint met: compare the whole window around it, word by word
        own = np.lib.stride_tricks.sliding_window_view(ids, length)[starts]
        whole = gram_hashes(ids, length)[starts]
        at = np.searchsorted(hashes, whole)
        left = np.arange(len(starts))
        while left.size:  # one turn, unless different windows share a hash
            left = left[at[left] < len(hashes)]
            left = left[hashes[at[left]] == whole[left]]
            equal = (windows[at[left]] == own[left]).all(axis=1)
            for k in np.unique(order[at[left[equal]]]):
                for owner in owners[bounds[k] : bounds[k + 1]]:
                    items.update(names[owner])
            for j in range(length):
                hit[starts[left[equal]] + j] = True
            left = left[~equal]
            at[left] += 1
    return hit, items


def whole_block(items: DataFrame, window: int) -> tuple[dict, dict]:
    """All items (__item, __text) as one block; the caller has checked their size."""
    return make_block([(r["__item"], words_of(r["__text"])) for r in items.collect()], window)


def word_hashes(words: list[bytes]):
    import numpy as np
    import xxhash

    known = {w: xxhash.xxh3_64_intdigest(w) for w in set(words)}
    return np.fromiter((known[w] for w in words), np.uint64, len(words))


def _all_starts(ids, length: int):
    import numpy as np

    return np.arange(len(ids) - length + 1)


def _cut_windows(texts, wanted, rows_at_once: int = 20_000):
    """Batches of (position of the text, first word, length, fingerprint, window's words); ``wanted``: see callers."""
    import numpy as np

    made: list[tuple] = []
    for at, t in enumerate(texts):
        words = words_of(t)
        ids = word_hashes(words)
        for length, prints in wanted(at, len(words)):
            if not 0 < length <= len(words):
                continue
            found = fingerprints(ids, _all_starts(ids, length), length).view(np.int64)
            starts = np.arange(len(found)) if prints is None else np.flatnonzero(np.isin(found, prints))
            for k in starts.tolist():
                made.append((at, k, length, int(found[k]), b" ".join(words[k : k + length])))
                if len(made) >= rows_at_once:
                    yield made
                    made = []
    yield made


def benchmark_windows(items: DataFrame, window: int) -> DataFrame:
    """(item, length, print, window), stored: the windows of the items (__item, __text)."""

    def cut(batches):
        for rows in batches:
            names, texts = rows.column("__item").to_pylist(), strings(rows.column("__text"))
            for made in _cut_windows(texts, lambda _, n: [(min(n, window), None)]):
                yield batch(
                    item=("string", [names[w[0]] for w in made]),
                    length=("int32", [w[2] for w in made]),
                    print=("int64", [w[3] for w in made]),
                    window=("binary", [w[4] for w in made]),
                )

    return stored(map_batches(items, cut, "item string, length int, print long, window binary"), "benchmark-windows")


def document_prints(held: DataFrame, lengths: list[int]) -> DataFrame:
    """(__row, n_words, prints (length, print)), stored: the distinct fingerprints of each document's windows."""

    def find(batches):
        import numpy as np
        import pyarrow as pa

        for rows in batches:
            counts, sizes, kinds, prints = [], [0], [], []
            for t in strings(rows.column("__text")):
                words = words_of(t)
                ids = word_hashes(words)
                counts.append(len(words))
                own = [(n, np.unique(fingerprints(ids, _all_starts(ids, n), n))) for n in lengths if n <= len(words)]
                kinds += [np.full(len(found), n, np.int32) for n, found in own]
                prints += [found.view(np.int64) for _, found in own]
                sizes.append(sizes[-1] + sum(len(found) for _, found in own))
            flat = [np.concatenate([np.empty(0, kind), *parts]) for kind, parts in ((np.int32, kinds), (np.int64, prints))]
            pairs = pa.StructArray.from_arrays([pa.array(f) for f in flat], ["length", "print"])
            yield batch(
                __row=rows.column("__row"),
                n_words=("int64", counts),
                prints=pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pairs),
            )

    schema = "__row long, n_words long, prints array<struct<length: int, print: long>>"
    return stored(map_batches(held.select("__row", "__text"), find, schema), "document-prints")


def joined_hits(held: DataFrame, prints: DataFrame, windows: DataFrame) -> DataFrame:
    """(__row, first, end, window), stored: every occurrence of a benchmark window in the documents (__row, __text)."""
    known = stored(windows.select("length", "print").distinct(), "benchmark-prints")
    met = prints.select("__row", F.explode("prints").alias("p")).select("__row", "p.*").join(known, ["length", "print"])
    met = met.groupBy(F.col("__row").alias("__of")).agg(F.collect_list(F.struct("length", "print")).alias("met"))
    found = held.select("__row", "__text").join(met, F.col("__row") == F.col("__of")).drop("__of")

    def cut(batches):
        for rows in batches:
            ids, met = rows.column("__row").to_pylist(), rows.column("met").to_pylist()

            def of_document(at, _):
                by_length: dict[int, list[int]] = {}
                for m in met[at]:
                    by_length.setdefault(m["length"], []).append(m["print"])
                return by_length.items()

            for made in _cut_windows(strings(rows.column("__text")), of_document):
                yield batch(
                    __row=("int64", [ids[w[0]] for w in made]),
                    first=("int64", [w[1] for w in made]),
                    end=("int64", [w[1] + w[2] for w in made]),
                    window=("binary", [w[4] for w in made]),
                )

    cuts = map_batches(found, cut, "__row long, first long, end long, window binary")
    whole = stored(windows.select("window").distinct(), "benchmark-distinct")
    return stored(cuts.join(whole, "window").select("__row", "first", "end", "window"), "hits")


def _joined(docs: DataFrame, items: DataFrame, window: int, doc_id: str, text: str, keep: bool) -> DataFrame:
    """``find_contamination`` by joins alone, for a benchmark of any size."""
    windows = benchmark_windows(items, window)
    # at most ``window`` numbers
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())
    names = docs.columns if keep else ["doc_id"]
    own = [F.col(c) for c in names] if keep else [F.col(doc_id).alias("doc_id")]
    # the documents' own columns in one struct, so that none clashes
    held = docs.select(
        F.monotonically_increasing_id().alias("__row"), F.col(text).alias("__text"), F.struct(*own).alias("__own")
    )
    held = stored(held, "documents")
    prints = document_prints(held, lengths)
    hits = joined_hits(held, prints, windows)
    own = held.select("__row", *[F.col("__own").getField(c).alias(c) for c in names])
    if keep:
        bad = hits.select(F.col("__row").alias("__of")).distinct().withColumn("__contaminated", F.lit(True))
        judged = own.join(bad, F.col("__row") == F.col("__of"), "left")
        return judged.select(*names, F.coalesce("__contaminated", F.lit(False)).alias("__contaminated"))
    # a document's windows in order: a span ends where the next window begins after all ends so far
    order = Window.partitionBy("__row").orderBy("first", "end").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.coalesce(F.col("first") > F.max("end").over(order), F.lit(True))
    spans = hits.select("__row", "first", "end").distinct().select("*", starts.cast("long").alias("starts"))
    upto = Window.partitionBy("__row").orderBy("first", "end").rowsBetween(Window.unboundedPreceding, 0)
    spans = spans.select("*", F.sum("starts").over(upto).alias("span")).groupBy("__row", "span")
    spans = spans.agg(F.min("first").alias("first"), F.max("end").alias("end")).groupBy(F.col("__row").alias("__of"))
    spans = spans.agg(
        F.array_sort(F.collect_list(F.struct("first", "end"))).alias("spans"), F.sum(F.col("end") - F.col("first")).alias("n_hit")
    )
    owners = stored(windows.select("window", "item").distinct(), "benchmark-owners")
    found = hits.select("__row", "window").distinct().join(owners, "window").select("__row", "item").distinct()
    found = found.groupBy(F.col("__row").alias("__by")).agg(F.array_sort(F.collect_list("item")).alias("items"))
    counts = prints.select(F.col("__row").alias("__at"), "n_words")
    every = own.join(counts, F.col("__row") == F.col("__at"))
    every = every.join(spans, F.col("__row") == F.col("__of"), "left").join(found, F.col("__row") == F.col("__by"), "left")
    no_spans, no_items = F.array().cast("array<struct<first: bigint, end: bigint>>"), F.array().cast("array<string>")
    n_hit, items_found = F.coalesce("n_hit", F.lit(0)), F.coalesce("items", no_items)
    return every.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items_found).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_found, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        F.coalesce("spans", no_spans).alias("spans"), items_found.alias("items"),
    )


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = 2_000_000,
    keep: bool = False,
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans, items per document.

    ``spans`` are the merged hit ranges (first word, end), ``items`` the sorted
    item ids.  A null text has no words; items of null or wordless text match
    nothing; a null item id stands as an empty string.  Repeated items and
    documents count in their own rows; ids that occur twice in ``benchmark`` are
    one item.  An empty benchmark leaves every document clean.  With ``keep``,
    the rows of ``docs`` follow unchanged, with the column ``__contaminated``.
    """
    spark = docs.sparkSession
    item = F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("__item")
    bench = benchmark.select(item, F.col(item_text).alias("__text")).filter("__text IS NOT NULL")
    size = bench.agg(F.sum(F.octet_length("__text") + F.octet_length("__item"))).first()[0] or 0
    if size > block_bytes:
        return _joined(docs, bench, window, doc_id, text, keep)
    block = spark.sparkContext.broadcast(whole_block(bench, window))
    columns = docs.columns if keep else ["doc_id"]

    def find(batches):
        import numpy as np
        import pyarrow as pa

        kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        for rows in batches:
            n_words, n_hit, spans, items = [], [], [], []
            for t in strings(rows.column("__text")):
                words = words_of(t)
                hit, found = search_block(block.value, words)
                edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
                n_words.append(len(words))
                n_hit.append(int(hit.sum()))
                spans.append([{"first": a, "end": e} for a, e in edges.reshape(-1, 2).tolist()])
                items.append(sorted(found))
            kept = {c: rows.column(c) for c in columns}
            if keep:
                yield batch(**kept, __contaminated=("bool_", [n > 0 for n in n_hit]))
                continue
            yield batch(
                **kept,
                n_words=("int64", n_words),
                n_hit=("int64", n_hit),
                n_items=("int64", [len(i) for i in items]),
                items_sha256=("string", [hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]),
                contaminated=("bool_", [n > 0 for n in n_hit]),
                spans=pa.array(spans, kind),
                items=pa.array(items, pa.list_(pa.string())),
            )

    if keep:
        thin = docs.select("*", F.col(text).alias("__text"))
        schema = StructType([*docs.schema.fields, StructField("__contaminated", BooleanType())])
    else:
        thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"))
        kind = thin.schema["doc_id"].dataType.simpleString()
        schema = (
            f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
            "spans array<struct<first: long, end: long>>, items array<string>"
        )
    return map_batches(thin, find, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, **names) -> DataFrame:
    """The rows of ``docs`` without a hit, unchanged."""
    judged = find_contamination(docs, benchmark, window, keep=True, **names)
    return judged.filter(~F.col("__contaminated")).drop("__contaminated")
