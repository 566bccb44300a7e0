"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct hashed character n-grams of the lower-cased
whole text.  Training: for every feature the smoothed log ratio of its share among
toxic and clean training rows (``r``); then logistic regression on the features
scaled by ``r``, so a text's logit is ``bias + sum(weight * r)`` over its distinct
features, and the product is all that scoring needs: one vector of ``2 ** bits``
floats, broadcast (4 MB).

The classifier is fitted on a bounded sample of the labelled rows (``max_rows``,
chosen by a hash of the id; all of them when there are fewer).  Their features are
made in parallel; the fit runs in one task, whose input that bound limits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recoda.llm.common import batch, map_batches, strings, worker_state

BITS = 20
SIZES = (5, 6)


def ngram_features(text: str, mark):
    """Distinct buckets of the text's n-grams; ``mark`` is a scratch vector of 2**BITS int32."""
    import numpy as np

    chars = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    parts = []
    for n in SIZES:
        if len(chars) >= n:
            h = np.zeros(len(chars) - n + 1, np.uint64)
            for j in range(n):
                h = h * np.uint64(0x100000001B3) + chars[j : j + len(h)] + np.uint64(n)
            h *= np.uint64(0x9E3779B97F4A7C15)
            parts.append((h >> np.uint64(64 - BITS)).astype(np.int64))
    if not parts:
        return np.empty(0, np.int64)
    buckets = np.concatenate(parts)
    places = np.arange(len(buckets), dtype=np.int32)
    mark[buckets] = places  # the last writer of a bucket stands for it
    return buckets[mark[buckets] == places]


def fit_weights(
    features, labels, min_rows: int = 3, min_ratio: float = 1.0, min_z: float = 2.5, smooth: float = 0.5,
    penalty: float = 0.02, steps: int = 30,
):
    """(weights by bucket, bias): log-count ratios times the logistic weights on them.

    Buckets in fewer than ``min_rows`` training rows, with a smaller absolute log
    ratio than ``min_ratio``, or with one less than ``min_z`` standard errors from
    zero say too little and get no weight.  With rows of
    one class only (or none) the bias alone scores.
    """
    import numpy as np

    y = np.asarray(labels, np.float64)
    n = 1 << BITS
    if not 0 < y.sum() < len(y):
        share = (y.sum() + 0.5) / (len(y) + 1)
        return np.zeros(n, np.float32), float(np.log(share / (1 - share)))
    flat = np.concatenate(features)
    row = np.repeat(np.arange(len(y), dtype=np.int32), [len(f) for f in features])
    seen, p = np.bincount(flat, minlength=n), np.bincount(flat[y[row] > 0], minlength=n)
    q = seen - p
    ratio = np.log((p + smooth) / (y.sum() + 2 * smooth)) - np.log((q + smooth) / ((1 - y).sum() + 2 * smooth))
    error = np.sqrt(1 / (p + smooth) + 1 / (q + smooth))
    ratio[(seen < min_rows) | (np.abs(ratio) < min_ratio) | (np.abs(ratio) < min_z * error)] = 0
    used = np.flatnonzero(ratio[flat])
    columns, flat = np.unique(flat[used], return_inverse=True)
    row, scale = row[used], ratio[columns]
    weight, bias = np.zeros(len(columns)), float(np.log(y.mean() / (1 - y.mean())))
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())  # both classes weigh the same
    first, second = np.zeros(len(columns) + 1), np.zeros(len(columns) + 1)
    for t in range(1, steps + 1):  # Adam on the full batch
        z = bias + np.bincount(row, (weight * scale)[flat], len(y))
        err = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        grad = np.append(scale * np.bincount(flat, err[row], len(columns)) + penalty * weight / len(y), err.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        move = 0.02 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-9)
        weight, bias = weight - move[:-1], bias - float(move[-1])
    out = np.zeros(n, np.float32)
    out[columns] = weight * scale
    return out, bias


def train(rows: DataFrame, max_rows: int = 6_000, text: str = "text", label: str = "label", key: str = "key"):
    """Fit on ``rows`` (key, text, label 0/1): (weights, bias).

    At most about ``max_rows`` rows are used, picked by a hash of ``key`` over all
    rows; null texts count as empty, rows without a label or key are left out.
    """
    import numpy as np

    rows = rows.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(label).cast("int").alias("label"))
    rows = rows.filter("label IN (0, 1) AND key IS NOT NULL")
    share = min(1.0, max_rows / max(1, rows.count()))
    picked = rows.filter(F.pmod(F.xxhash64("key", F.lit("train")), F.lit(1 << 30)) < int(share * (1 << 30)))

    def features(batches):
        import pyarrow as pa

        mark = worker_state(("marks",), lambda: np.zeros(1 << BITS, np.int32))
        for part in batches:
            made = [ngram_features(t, mark).astype(np.int32) for t in strings(part.column("text"))]
            yield batch(label=part.column("label"), features=pa.array(made, pa.list_(pa.int32())))

    def fit(batches):
        y, x = [], []
        for part in batches:
            y += part.column("label").to_pylist()
            lists = part.column("features")
            flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            x += np.split(flat, (ends[1:-1] - ends[0])) if len(lists) else []
        weights, bias = fit_weights(x, y)
        yield batch(weights=("binary", [weights.tobytes()]), bias=("float64", [bias]))

    made = map_batches(picked, features, "label int, features array<int>")
    # bounded by max_rows: one task fits
    row = map_batches(made.repartition(1), fit, "weights binary, bias double").first()
    if row is None:
        return np.zeros(1 << BITS, np.float32), 0.0
    return np.frombuffer(row["weights"], np.float32), row["bias"]


def score_texts(docs: DataFrame, model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score (0..1) of every whole text; a null text is empty."""
    import numpy as np

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        weights, bias = shared.value
        mark = worker_state(("marks",), lambda: np.zeros(1 << BITS, np.int32))
        for rows in batches:
            z = [bias + float(weights[ngram_features(t, mark)].sum(dtype=np.float64)) for t in strings(rows.column("text"))]
            scores = 1 / (1 + np.exp(-np.clip(np.array(z, np.float64), -500, 500)))
            yield batch(doc_id=rows.column("doc_id"), score=scores)

    thin = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_batches(thin, score, f"doc_id {thin.schema['doc_id'].dataType.simpleString()}, score double")


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, max_rows: int = 6_000) -> DataFrame:
    """doc_id, held_out, score, predicted of every document of ``docs``.

    Documents whose crc32 of the id as text is 0 modulo ``folds`` are held out of
    training.  Labels meet texts by doc_id; several label rows of a document are
    several training rows, null labels none.  Repeated documents are scored in
    their own rows; a null id is held out (nothing places it).  Without training
    rows every score is 0.5; an empty table gives no rows.
    """
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))
    rows = labels.select("doc_id", F.col("toxic").alias("label")).filter(fold != 0)
    rows = rows.join(docs.select("doc_id", "text"), "doc_id").select(F.col("doc_id").alias("key"), "text", "label")
    scored = score_texts(docs, train(rows, max_rows))
    return scored.select(
        "doc_id", F.coalesce(fold == 0, F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
