"""The mixture model against a plain version, and its accuracy on documents it did not see."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from recoda.llm import jobs, language

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, score string, held_out int, languages int"


def gram_counts(text):
    """Bucket counts of a text's letter n-grams, character by character."""
    folded = " "
    for c in text:
        low = c.lower()
        folded += (low if len(low) == 1 else c) if c.isalpha() else ("" if folded[-1] == " " else " ")
    folded += "" if folded[-1] == " " else " "
    codes = [0 if c == " " else ord(c) for c in folded]
    out, mask = Counter(), 2**64 - 1
    for n in (1, 2, 3):
        for i in range(len(codes) - n + 1):
            part, h = codes[i : i + n], 0
            if part == [0]:
                continue
            for c in part:
                h = (h * 0xC2B2AE3D27D4EB4F + c) & mask
            h = (h + n) * 0x9E3779B97F4A7C15 & mask
            h = (h ^ (h >> 29)) * 0x165667B19E3779F9 & mask
            out[h >> 48] += 1
    return out if any(codes) else Counter()


def plain_fit(rows):
    counts = {}
    for doc_id, text, lang in rows:
        if zlib.crc32(str(doc_id).encode()) % 5 and doc_id is not None and lang is not None and text is not None:
            counts.setdefault(lang, Counter()).update(gram_counts(text))
    return {k: (c, sum(c.values()) + 0.5 * 2**16) for k, c in counts.items()}


def plain_mixture(grams, model, names):
    def p(name, b):
        counts, total = model[name]
        return (counts[b] + 0.5) / total

    share = {name: 1 / len(names) for name in names}
    n = sum(grams.values())
    for _ in range(40):
        after = dict.fromkeys(names, 0.0)
        for b, c in grams.items():
            like = {name: share[name] * p(name, b) for name in names}
            whole = sum(like.values())
            for name in names:
                after[name] += c * like[name] / whole / n
        moved = max(abs(after[x] - share[x]) for x in names)
        share = after
        if moved < 1e-4:
            break
    return share, sum(c * math.log(sum(share[x] * p(x, b) for x in names)) for b, c in grams.items())


def plain_predict(text, model):
    grams = gram_counts(text or "")
    if not grams or not model:
        return []
    names = sorted(model)
    single = {x: plain_mixture(grams, model, [x])[1] for x in names}
    best = max(names, key=lambda x: single[x])
    chosen, reached = [best], single[best]
    penalty = 1.5 * math.log(max(sum(grams.values()), 2))
    every, _ = plain_mixture(grams, model, names)
    order = sorted(names, key=lambda x: -every[x])
    for k in range(2, len(names) + 1):
        share, likelihood = plain_mixture(grams, model, order[:k])
        if likelihood - reached <= penalty:
            break
        chosen, reached = sorted(order[:k], key=lambda x: -share[x]), likelihood
    return chosen


@pytest.mark.parametrize("size", [7, 1 << 20])
def test_grams_equal_the_plain_ones(size, monkeypatch):
    monkeypatch.setattr(language, "PIECE", size)
    fold, rng = language._letters(), random.Random(1)
    texts = ["", "  12 ", "Ab", "Straße İo", "漢字 かな!", "a" * 30, "𝒜b \U0010ffff c"]
    texts += ["".join(rng.choices("aBÉ ?\n漢", k=rng.randint(1, 40))) for _ in range(200)]
    for text in texts:
        found = np.concatenate([np.empty(0, np.int64), *language.grams(text, 2**16, fold)])
        assert Counter(found.tolist()) == gram_counts(text), text
    long = "Ein langer Text, " * 20_000
    found, weights = language._gathered(long, 2**16, fold)
    assert dict(zip(found.tolist(), weights.tolist(), strict=True)) == gram_counts(long)


def test_equals_the_plain_model_and_handles_awkward_rows(spark):
    rng = random.Random(4)
    kinds = {"aa": "abra kad o", "bb": "xyl qu zet", "ccc": "漢字語学 ä"}
    make = lambda k, n: " ".join("".join(rng.choices(kinds[k], k=4)) for _ in range(n))
    rows = [(i, make(k, rng.randint(1, 30)), k) for i, k in enumerate(list(kinds) * 40)]
    rows += [(500 + i, make("aa", 40) + " " + make("bb", 30), None) for i in range(6)]
    rows += [(600, None, "aa"), (601, "", None), (602, "12 !?", "bb"), (None, make("bb", 9), "bb"), rows[0], rows[0], (603, "q", None)]
    df = spark.createDataFrame([(*r, "s", "x", 1, 2) for r in rows], SCHEMA).repartition(3)
    out = language.identify_languages(df).collect()
    model = plain_fit(rows)
    want = Counter((d, tuple(plain_predict(t, model))) for d, t, _ in rows)
    assert Counter((r["doc_id"], tuple(r["languages"])) for r in out) == want
    for r in out:
        assert r["lang_pred"] == (r["languages"] + ["und"])[0] and 0 <= r["score"] <= 1
        assert r["held_out"] == (zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 5 == 0)
        assert abs(sum(r["shares"]) - bool(r["languages"])) < 1e-6
    mixed = [r for r in out if r["doc_id"] is not None and 500 <= r["doc_id"] < 506]
    assert all(r["languages"][:2] == ["aa", "bb"] and r["shares"][1] > 0.3 for r in mixed)


def test_nothing_to_learn(spark):
    assert language.identify_languages(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([(1, "text", None, "", "", 1, 1)], SCHEMA)
    assert language.identify_languages(one).first()["lang_pred"] == "und"


def test_buckets_shrink_as_languages_grow():
    for n in (1, 4, 200, 4096):
        assert n * language.bucket_count(n) <= language.MAX_CELLS and language.bucket_count(n) >= 2048


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    out = [r for r in jobs.q_language(spark, SF).collect() if r["held_out"]]
    assert len(out) > 100
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in out) / len(out) > 0.98
