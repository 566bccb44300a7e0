"""Line dedup: globally repeated multi-line chunks, with content-defined boundaries.

A text's lines are hashed; a rolling hash covers each line and the one before.
A chunk ends where the rolling hash is a local minimum, or around a line of over
``long_words`` words, which is a chunk of its own: it is a paragraph set on one
line.  Boundaries so depend on the few lines around them only, and a passage
copied into another document is cut alike there, whatever precedes it.  A local
minimum is never next to another, nor beside a text's first or last line, so other
chunks have two lines or more (but for lines caught between long ones).

Chunks miss a passage without two cuts of its own, and lines caught between long
ones.  So more runs of lines are compared, in the same way: the whole text, and for
every line with words the shortest run of over ``long_words`` words that starts
there and the one that ends there.  Such a run depends on its own lines only.  A
passage of over ``long_words`` words on whole lines is covered by the runs inside
it (where the rest of it is too short for a run that starts there, the run that
ends at its last line reaches back over it), so every later occurrence of it is
removed whole, whatever surrounds it.

Chunks and runs are compared by a 64-bit hash first (thin rows, aggregated before
they move).  Those with a repeated hash are grouped by SHA-256 and, for chunks, by
their bytes as well: chunks of one SHA-256 are removed only if all their bytes
agree.  Runs overlap, so that their bytes would be many times the text: they count
as equal by SHA-256.  Of equal runs of lines, where a chunk holds at least two lines
with words or one long line, the first by (document, place) stays and the lines of
every other one go, within a document too.

Native DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recoda.llm.common import stored

# Fixed values of the rolling hash: h' = (h(previous line) * BASE + h(line)) mod MODULUS.
BASE, MODULUS = 1_000_003, 2_147_483_647
LONG_WORDS = 50
WORD_GAP = "[ \t\n\x0b\f\r]+"


def line_hash(line: Column) -> Column:
    """32-bit hash of a line: the first eight hex digits of its MD5."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")


def word_count(line: Column) -> Column:
    """Words between ASCII white space."""
    trimmed = F.regexp_replace(F.regexp_replace(line, "^" + WORD_GAP, ""), WORD_GAP + "$", "")
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, WORD_GAP)))


def place(start: Column, size: Column) -> Column:
    """First line and line count as one number (numbers make hashed array operations possible)."""
    return F.shiftleft(start.cast("long"), 32) + size.cast("long")


def lines_of(lines: str, at: Column) -> Column:
    size = at.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    return F.slice(lines, F.shiftright(at, 32).cast("int") + 1, size)


def passages(marks: str, lines: str, long_words: int) -> Column:
    """Places of the whole text and of the shortest runs of over ``long_words`` words from and up to each line.

    ``marks``: the lines with words (at, w).  A run holds at most ``long_words`` + 1 of them.
    """
    most = long_words + 1

    def reach(run: Column) -> Column:
        """(words, line) where the run has over ``long_words`` words, or its end."""
        return F.aggregate(
            run,
            F.struct(F.lit(0).alias("words"), F.lit(0).alias("at")),
            lambda a, y: F.when(a["words"] > long_words, a).otherwise(
                F.struct((a["words"] + y["w"]).alias("words"), y["at"].alias("at"))
            ),
        )

    def ahead(x: Column, i: Column) -> Column:
        end = reach(F.slice(marks, i + 1, F.lit(most)))
        return F.struct(x["at"].alias("start"), end["at"].alias("end"), end["words"].alias("words"))

    def back(x: Column, i: Column) -> Column:
        first = F.greatest(i + 1 - long_words, F.lit(1))
        start = reach(F.reverse(F.slice(marks, first, i + 2 - first)))
        return F.struct(start["at"].alias("start"), x["at"].alias("end"), start["words"].alias("words"))

    def runs(of) -> Column:
        found = F.filter(F.transform(marks, of), lambda r: r["words"] > long_words)
        return F.transform(found, lambda r: place(r["start"], r["end"] - r["start"] + 1))

    whole = F.when(F.size(marks) > 0, F.array(place(F.lit(0), F.size(lines)))).otherwise(F.array().cast("array<bigint>"))
    return F.concat(whole, runs(ahead), runs(back))


def chunked(docs: DataFrame, doc_id: str, text: str, long_words: int) -> DataFrame:
    """``docs`` stored with __row, __id, __n_lines, __n_chunks and __runs (place, hash, chunk): chunks and passages."""
    lines = docs.select(
        "*", F.col(doc_id).alias("__id"), F.monotonically_increasing_id().alias("__row"),
        F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1).alias("__lines"),
    )
    marked = lines.select(
        "*",
        F.transform("__lines", lambda x: F.struct(line_hash(x).alias("h"), word_count(x).alias("w"))).alias("__marks"),
    )
    # every array a lambda reads is named in an earlier step and read twice or more, so that Catalyst
    # computes it once per document and never inside the lambda; single elements are read with get()
    rolled = marked.select(
        "*",
        F.transform(
            "__marks",
            lambda m, i: F.pmod(
                F.coalesce(F.get("__marks", i - 1)["h"], F.lit(0)) * F.lit(BASE) + m["h"], F.lit(MODULUS)
            ),
        ).alias("__roll"),
    )

    n = F.size("__roll")

    def starts_here(i: Column) -> Column:
        """Whether line i (1 .. n-1) starts a chunk: what ends before it, or long lines on either side."""
        before, at, after = (F.get("__roll", i - k) for k in (2, 1, 0))
        minimum = (i >= 2) & (i < n - 1) & (at < before) & (at <= after)
        long_line = (F.get("__marks", i - 1)["w"] > long_words) | (F.get("__marks", i)["w"] > long_words)
        return minimum | long_line

    cuts = F.filter(F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>")), starts_here)
    bounded = rolled.select("*", F.concat(F.array(F.lit(0)), cuts, F.array(n)).alias("__cuts"))

    def chunk(start: Column, i: Column) -> Column:
        size = F.get("__cuts", i + 1) - start
        part = F.slice("__lines", start + 1, size)
        marks = F.slice("__marks", start + 1, size)
        eligible = (F.size(F.filter(marks, lambda m: m["w"] > 0)) >= 2) | F.exists(marks, lambda m: m["w"] > long_words)
        return F.struct(place(start, size).alias("place"), hash_of(part).alias("hash"), eligible.alias("chunk"))

    def hash_of(part: Column) -> Column:
        return F.xxhash64(F.array_join(part, "\n"))

    starts = F.slice("__cuts", 1, F.size("__cuts") - 1)
    with_words = F.filter(
        F.transform("__marks", lambda m, i: F.struct(i.alias("at"), m["w"].alias("w"))), lambda m: m["w"] > 0
    )
    out = bounded.select(
        "*", F.size("__lines").cast("long").alias("__n_lines"), F.size(starts).cast("long").alias("__n_chunks"),
        F.transform(starts, chunk).alias("__chunks"), with_words.alias("__worded"),
    )
    out = out.select("*", passages("__worded", "__lines", long_words).alias("__passages"))
    eligible = F.filter("__chunks", lambda c: c["chunk"])
    more = F.array_except("__passages", F.transform(eligible, lambda c: c["place"]))  # distinct, and no chunk twice

    def passage(p: Column) -> Column:
        return F.struct(p.alias("place"), hash_of(lines_of("__lines", p)).alias("hash"), F.lit(False).alias("chunk"))

    out = out.select("*", F.concat(eligible, F.transform(more, passage)).alias("__runs"))
    return stored(out.drop("__marks", "__roll", "__cuts", "__lines", "__chunks", "__worded", "__passages"), "chunked", lean=True)


def repeated_runs(held: DataFrame, text: str) -> DataFrame:
    """(__row, place, chunk): runs of lines to remove."""
    runs = held.select("__row", F.explode("__runs").alias("c")).select("__row", "c.*")
    # stored, so that the join deals both sides anew and a hash of very many documents can be split
    twice = stored(runs.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash"), "twice", lean=True)
    # the candidates of a document side by side, to fetch their texts with one join
    candidates = runs.join(twice, "hash").groupBy(F.col("__row").alias("__of"))
    candidates = candidates.agg(F.collect_list(F.struct("place", "chunk")).alias("of"))
    body = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)
    found = held.select("__id", "__row", F.col(text)).join(candidates, F.col("__row") == F.col("__of"))

    def cut(r: Column) -> Column:
        return F.struct(r["place"].alias("place"), r["chunk"].alias("chunk"), joined_lines(r["place"]).alias("body"))

    def joined_lines(p: Column) -> Column:
        return F.array_join(lines_of("lines", p), "\n")

    cuts = F.transform("of", cut)
    texts = (
        found.select("__id", "__row", "of", body.alias("lines"))
        .select("__id", "__row", F.explode(F.when(F.size("lines") > 0, cuts)).alias("c"))
        .select(
            "__id", "__row", "c.place", "c.chunk", F.unhex(F.sha2(F.col("c.body").cast("binary"), 256)).alias("sha"),
            F.when(F.col("c.chunk"), F.col("c.body")).alias("body"),
        )
    )
    texts = stored(texts, "run-texts", lean=True)
    # aggregated before it moves; a chunk's bytes move once, and only their number goes on
    order = F.struct(F.col("__id").isNull(), F.col("__id"), F.col("__row").alias("row"), F.col("place").alias("place"))
    same = texts.groupBy("sha", "body").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    classes = same.groupBy(F.col("sha").alias("of_sha")).agg(
        F.min("first").alias("first"), F.sum("n").alias("n"), F.count("body").alias("bodies")
    )
    classes = stored(classes.filter("n > 1 AND bodies <= 1").select("of_sha", "first"), "run-classes", lean=True)
    later = (F.col("__row") != F.col("first.row")) | (F.col("place") != F.col("first.place"))
    joined = texts.drop("body").join(classes, F.col("sha") == F.col("of_sha"))
    return joined.filter(later).select("__row", "place", "chunk")


def _cleaned(docs: DataFrame, doc_id: str, text: str, long_words: int) -> DataFrame:
    """``docs`` with __n_lines, __n_chunks, __gone (chunks removed), __removed (their and the passages' lines) and __clean."""
    held = chunked(docs, doc_id, text, long_words)
    gone = repeated_runs(held, text).groupBy(F.col("__row").alias("__of"))
    gone = gone.agg(F.collect_list("place").alias("__places"), F.count_if("chunk").alias("__gone"))
    joined = held.drop("__runs").join(gone, F.col("__row") == F.col("__of"), "left").drop("__of")
    split = joined.select("*", F.split(F.col(text), "\n", -1).alias("__lines"))
    mask = F.lit((1 << 32) - 1)

    def numbers(p: Column) -> Column:
        first = F.shiftright(p, 32)
        return F.sequence(first, first + p.bitwiseAND(mask) - 1)

    # line numbers, as the removed runs overlap (array_except is hashed)
    removed = F.array_distinct(F.flatten(F.transform("__places", numbers)))
    every = F.sequence(F.lit(0).cast("long"), F.col("__n_lines") - 1)
    numbered = split.select("*", removed.alias("__removed"))
    numbered = numbered.select("*", F.when(F.col("__places").isNotNull(), F.array_except(every, "__removed")).alias("__kept"))
    left = numbered.select("*", F.transform("__kept", lambda i: F.get("__lines", i.cast("int"))).alias("__left"))
    clean = F.when(F.exists("__left", lambda x: word_count(x) > 0), F.array_join("__left", "\n")).otherwise("")
    return left.withColumn("__clean", F.when(F.col("__places").isNull(), F.col(text)).otherwise(clean))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", long_words: int = LONG_WORDS) -> DataFrame:
    """doc_id, n_lines, n_chunks, n_removed_chunks, n_removed_lines, text (without repeated chunks and passages).

    One row per input row.  A null text stays null and counts one empty line.
    Repeated rows are documents of their own: the first keeps its lines (null ids
    come last; rows of one id by their place in the input).  Every line removed
    stays at an earlier place.  A text equal to an earlier one, or left without
    words, becomes empty.  An empty table gives no rows.
    """
    thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    cleaned = _cleaned(thin, "doc_id", "text", long_words)
    return cleaned.select(
        "doc_id",
        F.col("__n_lines").alias("n_lines"),
        F.col("__n_chunks").alias("n_chunks"),
        F.coalesce(F.col("__gone"), F.lit(0)).cast("long").alias("n_removed_chunks"),
        F.when(F.col("__removed").isNull(), 0).otherwise(F.size("__removed")).cast("long").alias("n_removed_lines"),
        F.col("__clean").alias("text"),
    )


def strip_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", long_words: int = LONG_WORDS) -> DataFrame:
    """The rows of ``docs``, all of them, with their texts as in ``dedup_lines`` and every other column unchanged."""
    cleaned = _cleaned(docs, doc_id, text, long_words)
    return cleaned.select(*[F.col("__clean").alias(c) if c == text else F.col(c) for c in docs.columns])
