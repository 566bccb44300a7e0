"""Language identification by a multilingual mixture model.

A text's character 1- to 3-grams (letters in lower case, everything else one blank)
are hashed into buckets; a language is a distribution over buckets, counted over
*all* labelled documents that may be learned from.  Of each document,
expectation-maximisation estimates the languages' proportions from the n-grams'
likelihoods.  The set of languages is then selected by penalised likelihood:
starting from the best single language, the next one by proportion joins while the
log-likelihood rises by more than the penalty of one more proportion (half the log
of the number of n-grams, as in the Bayesian criterion; n-grams of three orders
overlap, so their log-likelihood counts a third).  The language with the largest
proportion in the set is the prediction.

Tasks count into a table of languages x buckets and pass on its non-zero cells, which
Spark adds up.  The table is broadcast; its size is bounded by ``MAX_CELLS``: with
many languages there are fewer buckets.  Documents are scored where they lie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recoda.llm.common import batch, map_batches, stored, worker_state

ORDERS = 3
MAX_BUCKETS, MAX_CELLS, MAX_LANGUAGES = 2**16, 2**23, 4096
SMOOTHING = 0.5  # added to every bucket's count
PIECE = 1 << 20  # characters taken at once, so that a very long text needs no more memory
STEPS, SETTLED = 40, 1e-4
_CODES = 0x33480  # letters lie below
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def held_out(doc_id: Column) -> Column:
    """Whether a document may not be learned from (a null id counts as an empty one: held out)."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 5 == 0


def _letters():
    """Code point to its lower-case letter; 0 for what is no letter."""
    import numpy as np

    fold = np.zeros(_CODES + 1, np.uint32)
    for code in range(_CODES):
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            fold[code] = ord(low) if len(low) == 1 else code
    return fold


def grams(text: str, buckets: int, fold):
    """Yield arrays of the n-grams' buckets, piece by piece; nothing for a text without letters."""
    import numpy as np

    shift = np.uint64(64 - buckets.bit_length() + 1)
    before, letters = np.zeros(1, np.uint64), False  # the last characters of the piece before
    for start in range(0, len(text), PIECE):
        codes = np.frombuffer(text[start : start + PIECE].encode("utf-32-le", "surrogatepass"), "<u4")
        z = fold[np.minimum(codes, _CODES)].astype(np.uint64)
        letters = letters or bool(z.any())
        z = np.concatenate([before, z])
        if start + PIECE >= len(text):
            z = np.append(z, np.uint64(0))
        known = len(before)
        z = np.concatenate([z[:known], z[known:][(z[known:] > 0) | (z[known - 1 : -1] > 0)]])
        if letters:
            found = []
            rolled = np.zeros(len(z), np.uint64)
            for n in range(1, ORDERS + 1):
                rolled = (rolled[: len(z) - n + 1] if n == 1 else rolled[:-1]) * np.uint64(_MULTIPLIERS[1]) + z[n - 1 :]
                mixed = (rolled + np.uint64(n)) * np.uint64(_MULTIPLIERS[0])
                mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(_MULTIPLIERS[2])
                # n-grams that end in this piece, single blanks left out
                fresh = np.arange(len(z) - n + 1) + n > known
                if n == 1:
                    fresh &= z > 0
                found.append((mixed[fresh] >> shift).astype(np.int64))
            yield np.concatenate(found)
        before = z[-(ORDERS - 1) :]


def mixture(table, weights):
    """Proportions of the languages (columns) that explain the n-grams (rows), and their log-likelihood."""
    import numpy as np

    n = weights.sum()
    share = np.full(table.shape[1], 1 / table.shape[1])
    for _ in range(STEPS):
        after = share * ((weights / (table @ share)) @ table) / n
        moved = np.abs(after - share).max()
        share = after / after.sum()
        if moved < SETTLED:
            break
    return share, float(weights @ np.log(table @ share))


def select_languages(found, weights, table, logs):
    """Numbers of the selected languages, the largest proportion first, and their proportions."""
    import numpy as np

    single = weights @ logs[found]
    best = int(np.argmax(single))
    chosen, shares, reached = [best], np.ones(1), float(single[best])
    if table.shape[1] == 1:
        return chosen, shares
    rows = table[found]
    penalty = ORDERS * 0.5 * np.log(max(weights.sum(), 2))
    every, most = mixture(rows, weights)
    if most - reached <= penalty:  # no set explains the text better than all languages do
        return chosen, shares
    order = np.argsort(-every, kind="stable")
    for k in range(2, len(order) + 1):
        picked = order[:k]
        share, likelihood = mixture(rows[:, picked], weights)
        if likelihood - reached <= penalty:
            break
        by_share = np.argsort(-share, kind="stable")
        chosen, shares, reached = picked[by_share].tolist(), share[by_share], likelihood
    return chosen, shares


def bucket_count(languages: int) -> int:
    """A power of two; ``languages`` times it stays within ``MAX_CELLS``."""
    return min(MAX_BUCKETS, 1 << (max(1, MAX_CELLS // languages).bit_length() - 1))


def learn_languages(docs: DataFrame, doc_id: str, text: str, lang: str):
    """The learned languages, in order, and their likelihoods per bucket, relative to the bucket's likeliest."""
    import numpy as np

    labelled = docs.filter(~held_out(F.col(doc_id)) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    names = sorted(r[0] for r in labelled.select(F.col(lang).cast("string")).distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: {lang!r} does not look like a language")
    if not names:
        return [], np.zeros((1, 0))
    buckets, number = bucket_count(len(names)), {name: i for i, name in enumerate(names)}

    def count(batches):
        fold = worker_state(("letters",), _letters)
        cells = np.zeros((len(names), buckets), np.int64)
        for rows in batches:
            for t, name in zip(rows.column("text").to_pylist(), rows.column("lang").to_pylist(), strict=True):
                for found in grams(t, buckets, fold):
                    cells[number[name]] += np.bincount(found, minlength=buckets)
        language, bucket = np.nonzero(cells)
        yield batch(language=language.astype("int32"), bucket=bucket.astype("int32"), n=cells[language, bucket])

    thin = labelled.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    cells = map_batches(thin, count, "language int, bucket int, n long")
    summed = stored(cells.groupBy("language", "bucket").agg(F.sum("n").alias("n")), "language-counts")
    counts = np.zeros((buckets, len(names)))
    for row in summed.toLocalIterator():  # at most MAX_CELLS cells
        counts[row["bucket"], row["language"]] = row["n"]
    smooth = (counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * buckets)
    return names, smooth / smooth.max(axis=1, keepdims=True)


def identify_languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, languages, shares: one row per input row.

    ``languages`` are the selected ones, ``shares`` their proportions, largest first;
    ``lang_pred`` is the first.  ``score`` is its proportion, drawn towards an even
    split by one n-gram per language, so that a short text scores low.  A null text
    or one without letters is ``und`` with score 0 and no languages, and so is
    every text when nothing can be learned.  Labels are learned from rows that are
    not held out and have a text and a language; a null id is held out.  Repeated
    rows count, and are predicted, each on its own; an empty table gives no rows.
    """
    import numpy as np

    names, likelihood = learn_languages(docs, doc_id, text, lang)
    shipped = docs.sparkSession.sparkContext.broadcast(likelihood.astype(np.float32))
    buckets = len(likelihood)

    def predict(batches):
        import pyarrow as pa

        fold = worker_state(("letters",), _letters)
        table = shipped.value.astype(np.float64)
        logs = np.log(table)
        for rows in batches:
            preds, scores, languages, proportions = [], [], [], []
            for t in rows.column("text").to_pylist():
                chosen, shares, n = [], (), 0
                if names and t:
                    found, weights = _gathered(t, buckets, fold)
                    if len(found):
                        n = int(weights.sum())
                        chosen, shares = select_languages(found, weights, table, logs)
                preds.append(names[chosen[0]] if chosen else "und")
                scores.append((n * float(shares[0]) + 1) / (n + len(names)) if chosen else 0.0)
                languages.append([names[i] for i in chosen])
                proportions.append([float(s) for s in shares])
            yield batch(
                doc_id=rows.column("doc_id"), held_out=rows.column("held_out"), lang_pred=("string", preds),
                score=("float64", scores), languages=pa.array(languages, pa.list_(pa.string())),
                shares=pa.array(proportions, pa.list_(pa.float64())),
            )

    thin = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("text"))
    kind = thin.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, lang_pred string, score double, languages array<string>, shares array<double>"
    return map_batches(thin, predict, schema)


def _gathered(text: str, buckets: int, fold):
    """The distinct buckets of a text's n-grams and their counts."""
    import numpy as np

    counts = np.zeros(buckets, np.int64)
    for part in grams(text, buckets, fold):
        counts += np.bincount(part, minlength=buckets)
    found = np.flatnonzero(counts)
    return found, counts[found].astype(np.float64)
