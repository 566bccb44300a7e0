"""Operators of recoda.llm against brute-force versions and on awkward inputs."""

import hashlib
import io
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recoda.llm import (
    bpe,
    decontaminate,
    jobs,
    line_dedup,
    packing,
    quality,
    sharding,
    simhash,
    token_counts,
    token_files,
    tokens,
    toxicity,
    url_filter,
)

SF = "/root/testdata/sf0.001"
WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "The quick brown fox's tail.\nIt's 42 o'clock,\tand  they'll\r\n  run.",
    "",
    None,
    " \n\t ",
    "ÄÖÜ ﬁn CAFE\u0301 İstanbul ΣΑΣ naïve\u00a0space\u2003wide\u3000end \x1c sep\x1fx",
    "<|endoftext|> inside <|startoftext|> and <|endoftext|>",
    "emoji 👩‍🚀 and 漢字かな, ١٢٣ ²³½",
    "a" * 3000 + " " + "b c " * 4000,
    "same words again " * 40,
    "same words again " * 40,
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, fp string, size int, row_no int"


@pytest.fixture(scope="module")
def awkward(spark):
    """Null and repeated ids and rows, null, empty and long texts, columns with the operators' own names."""
    rows = [(i, t, None, None if i % 3 else "s", None, 1, "x", 2, 3) for i, t in enumerate(TEXTS)]
    rows += [(None, "no id", "en", "s", 5, None, None, None, None), rows[0], rows[0], (2**60 + 1, "big id", None, "t", 1, 1, "", 1, 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def local(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}


def ids(path, text):
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def crc(values):
    return zlib.crc32(np.array(values, "<u4").tobytes())


# tokens


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_units_give_the_library_ids(path):
    enc = tokens.UnitEncoder(path, max_units=5)
    rng = random.Random(5)
    odd = ["a", "B", "'s", "'", " ", "  ", "\n", "\t", "\u00a0", "\u2028", "\u0301", "é", "1", "!", "\x1c", "漢", "İ", "Σ", "\u200d"]
    texts = [t or "" for t in TEXTS] + ["".join(rng.choices(odd, k=rng.randint(0, 25))) for _ in range(1500)]
    tok = Tokenizer.from_file(path)
    want = [np.array(e.ids, "<u4").tobytes() for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert enc.kind != "whole"
    assert enc.encode(texts) == want
    assert enc.encode(texts) == want  # after the cache was cleared


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encoder_gives_the_library_ids(path):
    """Code points (all below U+3000) in several places, odd mixtures and the awkward texts, against the library itself."""
    enc = bpe.Encoder(path)
    assert enc.fast is not None
    points = [chr(c) for c in [*range(0x3000), *range(0x3000, 0x110000, 37)] if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b 1{c}2 {c} {c}X" for c in points]
    rng = random.Random(6)
    odd = ["a", "B", "'s", "'LL", "'", " ", "  ", "\n", "\t", "\u00a0", "\u2028", "\u0301", "e\u0301", "é", "1", "²", "_", "\x1c"]
    odd += ["漢", "İ", "ΑΣ", "\u200d", "don't", "\u2019", "\x00", "ſ", "\u212a", "\u212b", "<|endoftext|>", "👩"]
    texts += ["".join(rng.choices(odd, k=rng.randint(0, 25))) for _ in range(5000)] + [t or "" for t in TEXTS]
    tok = Tokenizer.from_file(path)
    for i in range(0, len(texts), 20_000):
        part = texts[i : i + 20_000]
        want = [np.array(e.ids, "<u4").tobytes() for e in tok.encode_batch(part, add_special_tokens=False)]
        wrong = [t for t, a, b in zip(part, enc.encode(part), want, strict=True) if a != b]
        assert not wrong, wrong[:3]


def test_token_counts(awkward, nothing, docs, local):
    tok = Tokenizer.from_file(WORD)
    for df in (awkward, docs):
        want = Counter(
            (r["doc_id"], len((r["text"] or "").encode()), len(tok.encode(r["text"] or "", add_special_tokens=False).ids))
            for r in df.collect()
        )
        out = token_counts.count_tokens(df, WORD, limit=500).collect()
        assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in out) == want
        assert all(r["over_limit"] == (r["n_tokens"] > 500) for r in out)
    assert token_counts.count_tokens(docs, WORD, frequent={}).exceptAll(token_counts.count_tokens(docs, WORD)).count() == 0
    assert token_counts.count_tokens(nothing, WORD).collect() == []


# sharding


@pytest.mark.parametrize("n", [1, 2, 3, 40, 41, 1000, 70000])
def test_feistel_is_a_bijection_with_an_inverse(n):
    numbers = np.arange(n)
    p = sharding.feistel(numbers, n, 7)
    assert sorted(p.tolist()) == numbers.tolist()
    assert (sharding.feistel(p, n, 7, inverse=True) == numbers).all()
    if n >= 1000:
        assert (p != sharding.feistel(numbers, n, 8)).mean() > 0.9
        assert abs(np.corrcoef(numbers, p)[0, 1]) < 0.1


def test_sharding(awkward, nothing, docs):
    for df in (awkward, docs):
        out = sharding.shard_rows(df, 40, 3).collect()
        want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in df.collect())
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
        slots = defaultdict(list)
        for r in out:
            slots[r["shard"]].append(r["slot"])
            p = int(sharding.feistel([r["row_no"]], len(out), 3)[0])
            assert (r["shard"], r["slot"], r["law"], r["grown_shard"]) == (p % 40, p // 40, "rows", None)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        counts = [len(slots.get(k, [])) for k in range(40)]
        assert max(counts) - min(counts) <= 1
        again = sharding.shard_rows(df.repartition(5), 40, 3).collect()
        assert Counter(again) == Counter(out)
    assert sharding.shard_rows(nothing).collect() == []


def test_written_shards_hold_every_text_in_slot_order(spark, docs, tmp_path):
    sharding.write_shards(docs, str(tmp_path / "s"), 4, 1)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.select("doc_id", "text").exceptAll(docs.select("doc_id", "text")).count() == 0
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 4


# packing


def check_packing(rows, texts, capacity):
    seqs = defaultdict(list)
    for r in rows:
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    total = 0
    for doc_id, text in texts.items():
        full = ids(BYTE, text) + [2]
        total += len(full)
        want = [(k, s, n, crc(full[s : s + n])) for k, (s, n) in enumerate(packing.cut_points(len(full), capacity))]
        assert sorted(by_doc[doc_id]) == want
    assert set(by_doc) == set(texts)
    return len(seqs), -(-total // capacity)


def test_packing(docs, local):
    n, bound = check_packing(packing.pack_documents(docs, BYTE, 1024, 2).collect(), local, 1024)
    assert n <= bound + max(2, bound // 50)
    # several groups, far smaller sequences
    check_packing(packing.pack_documents(docs, BYTE, 100, 2, group_pieces=50).collect(), local, 100)


def test_packing_awkward(awkward, nothing):
    out = packing.pack_documents(awkward, BYTE, 64, 2).collect()
    per_doc = Counter()
    for r in awkward.collect():
        per_doc[r["doc_id"]] += len(ids(BYTE, r["text"] or "")) + 1
    got = Counter()
    for r in out:
        got[r["doc_id"]] += r["length"]
    assert got == per_doc
    assert packing.pack_documents(nothing, BYTE).collect() == []


def test_cut_points():
    assert packing.cut_points(1024, 1024) == [(0, 1024)]
    assert packing.cut_points(1025, 1024) == [(0, 1), (1, 1024)]
    assert packing.cut_points(2048, 1024) == [(0, 1024), (1024, 1024)]


def test_sum_of_squares_rule():
    """Each choice against the rule spelled out: the smallest sum of squares among open bins with room."""
    rng = random.Random(2)
    for _ in range(40):
        cap = rng.randint(3, 30)
        sizes = [rng.randint(1, cap) for _ in range(80)]
        bins, offsets = packing.sum_of_squares(sizes, cap)
        free, gaps = {}, Counter()
        for size, b, offset in zip(sizes, bins.tolist(), offsets.tolist(), strict=True):
            room = {g for g in free.values() if g >= size}

            def after(g, gaps=gaps, size=size, cap=cap):
                c = Counter(gaps)
                if g < cap:
                    c[g] -= 1
                if g - size:
                    c[g - size] += 1
                return sum(v * v for v in c.values())

            best = min(room, key=lambda g: (after(g), g)) if room else cap
            assert free.get(b, cap) == best and offset == cap - best and (b in free) == bool(room)
            if best < cap:
                gaps[best] -= 1
            free[b] = best - size
            if free[b]:
                gaps[free[b]] += 1
            else:
                free[b] = 0


def test_sequences_hold_the_documents_ids(docs, local):
    packed = packing.pack_documents(docs, BYTE, 256, 2)
    out = {r["sequence_id"]: r["ids"] for r in packing.sequence_ids(docs, packed, BYTE).collect()}
    assert all(len(v) <= 256 for v in out.values())
    for r in packed.collect():
        assert crc(out[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]) == r["ids_crc32"]


# token files


def test_token_files_round_trip(spark, docs, local, tmp_path):
    manifest = token_files.write_token_files(docs, WORD, str(tmp_path / "t"), frame_ids=3000)
    back = token_files.read_token_files(spark, manifest).collect()
    at = 0
    assert len(back) == len(local)
    for r in sorted(back, key=lambda r: r["doc_id"]):
        want = ids(WORD, local[r["doc_id"]]) + [2]
        assert (r["ids"], r["start"], r["n_tokens"], r["ids_crc32"]) == (want, at, len(want), crc(want))
        at += len(want)
    chosen = sorted(local)[10:13]
    some = token_files.read_token_files(spark, manifest, chosen).collect()
    assert sorted((r["doc_id"], r["ids_crc32"]) for r in some) == sorted(
        (r["doc_id"], r["ids_crc32"]) for r in back if r["doc_id"] in chosen
    )


def test_token_file_is_public_zstandard_and_reads_only_what_is_asked():
    out = io.BytesIO()
    w = token_files.Writer(out, 2, 10)
    texts = [[1, 2, 3], [], [7] * 25, [9] * 4, [65535] * 8]
    for i, t in enumerate(texts):
        w.add(None if i == 1 else i, np.array(t, "<u2").tobytes())
    w.close()
    import zstandard

    plain = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(out.getvalue())
    assert np.frombuffer(plain, "<u2").tolist() == sum(texts, [])
    r = token_files.Reader(out)
    assert r.ids == [0, None, 2, 3, 4]
    assert r.document(4).tolist() == texts[4] and r.frames_read == 1
    assert [r.document(k).tolist() for k in range(5)] == texts
    broken = bytearray(out.getvalue())
    broken[int(r.starts[1]) - 1] ^= 1
    with pytest.raises(Exception, match="checksum|Checksum|corrupt|decompress"):
        token_files.Reader(io.BytesIO(bytes(broken))).document(0)


def test_token_files_awkward(awkward, nothing):
    out = token_files.token_digests(awkward, WORD).collect()
    want = Counter((r["doc_id"], crc(ids(WORD, r["text"] or "") + [2])) for r in awkward.collect())
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in out) == want
    rows = sorted(out, key=lambda r: r["start"])
    assert [r["doc_id"] or -1 for r in rows] == sorted(r["doc_id"] or -1 for r in rows)[:1] + [r["doc_id"] or -1 for r in rows][1:]
    assert [r["start"] for r in rows] == np.cumsum([0] + [r["n_tokens"] for r in rows])[:-1].tolist()
    assert token_files.token_digests(nothing, WORD).collect() == []


# quality


def brute_quality(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    grams = defaultdict(list)
    for i in range(len(words) - 2):
        grams[tuple(words[i : i + 3])].append(i)
    hit = {p + k for at in grams.values() if len(at) > 1 for p in at for k in range(3)}
    lines, dups = set(), 0
    for line in (text or "").split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dups += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dups, len(hit)


def test_quality_counts(awkward, nothing, docs):
    for df in (awkward, docs):
        want = Counter((r["doc_id"], *brute_quality(r["text"])) for r in df.collect())
        out = quality.judge_quality(df).collect()
        assert Counter((r["doc_id"], *[r[c] for c in quality.COUNTS]) for r in out) == want
        for r in out:
            assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
            assert not (r["base_failed"] and r["kept"])
    assert quality.judge_quality(nothing).collect() == []
    assert quality.filter_quality(nothing).collect() == []


def test_boilerplate_is_counted_per_host_and_removed(spark):
    rng = random.Random(1)
    prose = lambda n: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    rows = [(i, f"Home | Page {i}\n{prose(60)}\n{prose(30)}", "big") for i in range(40)]
    rows += [(100 + i, f"Home | Page {i}\n{prose(60)}", "small") for i in range(5)]
    rows += [(200, "Home | Page 7\n" + prose(50), "big")]
    rows += [(300 + i, "Copied line here\n" + " ".join(f"c{k}" for k in range(60)), "big") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    limits = quality.LineLimits(min_docs=10, max_lost_share=0.05)
    out = {r["doc_id"]: r for r in quality.judge_quality(df, limits).collect()}
    assert all(out[i]["n_boilerplate_words"] == 4 and out[i]["kept"] for i in range(40))
    assert all(out[100 + i]["n_boilerplate_words"] == 0 for i in range(5))  # another host, under its limit
    assert not out[200]["kept"] and not out[200]["base_failed"]  # depleted
    assert all(out[300 + i]["n_boilerplate_words"] == 0 for i in range(30))  # copies are one document
    kept = {r["doc_id"]: r["text"] for r in quality.filter_quality(df, limits).collect()}
    assert set(kept) == set(out) - {200}
    assert "Home" not in kept[3] and kept[3] == rows[3][1].split("\n", 1)[1]
    assert kept[100] == rows[40][1]


def test_filter_quality_keeps_repeated_rows_and_other_columns(spark):
    good = " ".join(f"w{k}" for k in range(60))
    df = spark.createDataFrame([(1, good, "a", 7), (1, good, "a", 7), (1, good, None, 8), (2, "bad", "a", 9)],
                               "doc_id long, text string, source string, n_words long")
    assert Counter(quality.filter_quality(df).collect()) == Counter(df.filter("doc_id = 1").collect())


def test_filtered_lines_have_one_verdict_in_small_and_hot_hosts(spark):
    docs = spark.range(100_500).selectExpr(
        "id AS doc_id", "IF(id < 500, 'small', 'hot') AS source",
        "concat(IF(id < 100 OR id >= 100400, 'Home and contact\n', ''), concat_ws(' ', transform(sequence(1, 52), x -> translate(concat(id, 'w', x), '0123456789', 'abcdefghij')))) AS text",
    )
    out = quality.filter_quality(docs)
    assert out.count() == 100_500
    assert out.filter("text LIKE 'Home%'").count() == 0


def test_filtered_long_lines_are_boilerplate_but_near_copies_stay(spark):
    rng = random.Random(3)
    prose = lambda n: " ".join("".join(rng.choices("abcdefgh", k=8)) for _ in range(n))
    notice, licence = prose(30), prose(120)
    rows = [(i, f"{prose(80)}\n{notice}\n{prose(10)}") for i in range(30)]
    rows += [(100 + i, f"{licence}\n{prose(60)}") for i in range(30)]  # most of their words: depleted
    family = [prose(60), prose(70), prose(50)]
    rows += [(200 + i, "\n".join([*family, prose(40)])) for i in range(30)]
    rows += [(300 + i, f"{prose(90)}\n{family[0]}") for i in range(10)]  # with the family: 11 texts
    df = spark.createDataFrame([(*r, "host") for r in rows], "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["text"] for r in quality.filter_quality(df).collect()}
    texts = dict(rows)
    for i in range(30):
        assert kept[i] == texts[i].replace(notice + "\n", "")
        assert 100 + i not in kept
        assert kept[200 + i].split("\n") == texts[200 + i].split("\n")[1:]
    assert all(kept[300 + i] == texts[300 + i].split("\n")[0] for i in range(10))
    out = {r["doc_id"]: r for r in quality.judge_quality(df).collect()}
    assert [out[i]["n_boilerplate_words"] for i in (0, 100, 200, 300)] == [30, 120, 60, 60]
    assert not out[100]["kept"] and not out[100]["base_failed"]  # depleted by the default limits


# line dedup


def test_line_dedup_cuts_repeated_passages(spark):
    rng = random.Random(4)
    line = lambda: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(6))
    own = {i: [line() for _ in range(12)] for i in range(6)}
    passage, paragraph = [line() for _ in range(20)], " ".join(line() for _ in range(10))
    texts = {0: own[0] + passage, 1: own[1][:5] + passage + own[1][5:], 2: own[2], 3: own[3] + [paragraph],
             4: own[4][:3] + [paragraph] + own[4][3:], 5: own[5], 6: own[5]}
    df = spark.createDataFrame([(i, "\n".join(t)) for i, t in texts.items()] + [(7, None), (8, "")], "doc_id long, text string")
    out = {r["doc_id"]: r for r in line_dedup.dedup_lines(df).collect()}
    for i in (0, 2, 3, 5):
        assert out[i]["text"] == "\n".join(texts[i]) and out[i]["n_removed_lines"] == 0
    assert out[1]["text"].split("\n") == own[1]  # the passage goes whole, nothing of its own is lost
    assert out[1]["n_removed_lines"] == 20 and out[4]["n_removed_chunks"] == 1
    assert out[4]["text"] == "\n".join(own[4])
    assert out[6]["text"] == "" and out[6]["n_removed_lines"] == 12
    assert out[7]["text"] is None and out[8]["text"] == ""


def test_stripped_exact_copies_of_any_layout_end_empty(spark):
    rng = random.Random(11)
    line = lambda n: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    layouts = [[60, 8, 70, 3, 90], [60, 5], [5, 60], [4], [9, 0, 12], [0, 60, 0, 7, 0, 0, 80, 0], [7] * 30]
    layouts += [[rng.choice([0, 1, 5, 20, 49, 50, 51, 120]) for _ in range(rng.randint(1, 12))] for _ in range(25)]
    texts = ["\n".join(line(n) for n in layout) for layout in layouts]
    rows = [(k * len(texts) + i, t) for k in range(3) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = {r["doc_id"]: r["text"] for r in line_dedup.strip_repeated_lines(df).collect()}
    for i, t in rows:
        assert out[i] == (t if i < len(texts) else "" if t.strip() else t)


def test_stripped_passages_of_few_lines_go_whole(spark):
    rng = random.Random(12)
    line = lambda n: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    rows, want = [], {}
    shapes = [[26, 26], [50, 1], [1, 50], [40, 20, 5], [5, 20, 40], [17] * 3, [13] * 4, [11] * 5, [9] * 6, [30, 0, 30], [50, 50, 3]]
    for n, shape in enumerate(shapes):
        passage = [line(w) for w in shape]
        for k in range(6):
            size = lambda: rng.choice([3, 6, 30, 80])
            before, after = [line(size()) for _ in range(rng.randint(0, 5))], [line(size()) for _ in range(rng.randint(1, 5))]
            rows.append((n * 10 + k, "\n".join(before + passage + after)))
            want[n * 10 + k] = rows[-1][1].split("\n") if k == 0 else before + after
    rows.append((1000, "\n".join([line(8), *[line(25)] * 2, line(8)])))  # 50 words: no passage, and one of its own
    want[1000] = rows[-1][1].split("\n")
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = {r["doc_id"]: r["text"].split("\n") for r in line_dedup.strip_repeated_lines(df).collect()}
    blank = lambda lines: [x for x in lines if x]
    assert {i: blank(x) for i, x in out.items()} == {i: blank(x) for i, x in want.items()}
    plan = line_dedup.strip_repeated_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_line_dedup_awkward(awkward, nothing, docs):
    out = line_dedup.dedup_lines(awkward).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r["doc_id"] for r in awkward.collect())
    # the repeated row keeps one copy of its two or more lines
    assert sorted(r["text"] for r in out if r["doc_id"] == 0)[:2] == ["", ""]
    assert sum(r["text"] == TEXTS[0] for r in out) == 1
    assert line_dedup.dedup_lines(nothing).collect() == []
    whole = line_dedup.strip_repeated_lines(awkward)
    assert whole.columns == awkward.columns and whole.count() == awkward.count()


def test_line_dedup_stays_native(docs):
    plan = line_dedup.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# decontamination


def brute_hits(text, items, window):
    pattern = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
    lower = lambda t: re.findall(pattern, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    words, hit, found = lower(text), set(), set()
    for item, body in items:
        own = lower(body)
        n = min(len(own), window)
        if n:
            for w in {tuple(own[i : i + n]) for i in range(len(own) - n + 1)}:
                for i in range(len(words) - n + 1):
                    if tuple(words[i : i + n]) == w:
                        hit.update(range(i, i + n))
                        found.add(str(item) if item is not None else "")
    return len(words), hit, sorted(found)


def test_decontamination(spark, awkward, nothing):
    rng = random.Random(9)
    vocabulary = ["a", "b", "c", "É", "x1"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 5, 9, 10, 11, 25])))) for i in range(25) if i != 3]
    items += [(7, "a b Q z é"), (None, "q,q;q"), (30, None), (31, "  ,"), (items[0][0], items[0][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [" ".join(rng.choices([*vocabulary, "zz"], k=rng.randint(0, 80))) for _ in range(60)]
    texts += [f"zz {items[k][1]}, zz. {items[(k * 7) % 20][1].upper()}" for k in range(20)] + ["Q-Q-Q", None, "q q"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {i: brute_hits(t, items, 10) for i, t in enumerate(texts)}
    for block_bytes in (2_000_000, 60):
        out = decontaminate.find_contamination(df, bench, 10, block_bytes=block_bytes).collect()
        assert len(out) == len(texts)
        for r in out:
            n, hit, found = want[r["doc_id"]]
            spans = {k for s in r["spans"] for k in range(s["first"], s["end"])}
            assert (r["n_words"], spans, r["n_hit"], r["items"]) == (n, hit, len(hit), found)
            assert r["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()
            assert (r["n_items"], r["contaminated"]) == (len(found), bool(hit))
    kept = decontaminate.drop_contaminated(df, bench)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, w in want.items() if not w[1]}
    joined = decontaminate.drop_contaminated(df, bench, block_bytes=60)
    assert Counter(joined.collect()) == Counter(kept.collect())
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_contamination(awkward, none).filter("contaminated").count() == 0
    assert decontaminate.drop_contaminated(awkward, none).exceptAll(awkward).count() == 0
    assert decontaminate.find_contamination(nothing, bench).collect() == []
    assert decontaminate.find_contamination(nothing, bench, block_bytes=60).collect() == []
    by_size = [Counter(map(str, decontaminate.find_contamination(awkward, bench, block_bytes=b).collect())) for b in (10**6, 60)]
    assert by_size[0] == by_size[1]
    rows = [Counter(decontaminate.drop_contaminated(awkward, bench, block_bytes=b).collect()) for b in (10**6, 60)]
    assert rows[0] == rows[1]


def test_a_benchmark_over_the_bound_never_reaches_the_driver(spark, docs, monkeypatch):
    """A third of the documents hold one window; items outnumber the bound many times; nothing of them is collected."""
    sf = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = sf.selectExpr("CAST(item_id AS STRING) AS item_id", "text").unionByName(docs.selectExpr("concat('d', doc_id) AS item_id", "text"))
    monkeypatch.setattr(decontaminate, "whole_block", None)
    hot = docs.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" one two three four five six seven eight nine ten"))).otherwise(F.col("text")))
    items = items.unionByName(spark.createDataFrame([("hot", "one two three four five six seven eight nine ten")], items.schema))
    out = decontaminate.find_contamination(hot, items, 10, block_bytes=1000)
    own = out.filter("doc_id % 3 = 0 AND NOT array_contains(items, 'hot')")
    assert own.count() == 0
    rows = {r["doc_id"]: r for r in out.collect()}
    for r in docs.collect():
        if rows[r["doc_id"]]["n_words"]:
            assert f"d{r['doc_id']}" in rows[r["doc_id"]]["items"]  # every document holds itself


# toxicity


def test_toxicity_learns_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    out = toxicity.score_toxicity(docs, labels)
    rows = out.join(labels, "doc_id").filter("held_out").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert len(toxic) > 50 and sum(toxic) / len(toxic) > 0.7 and sum(clean) / len(clean) < 0.03
    scores = sorted((r["score"], r["toxic"]) for r in rows)
    below = seen = 0  # pairs ranked right (AUC)
    for _, label in scores:
        below += seen if label else 0
        seen += not label
    assert below / (len(toxic) * len(clean)) > 0.9


def test_toxicity_awkward(spark, awkward, nothing):
    labels = spark.createDataFrame([(0, 1, 1), (0, 1, 0), (1, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    none = labels.limit(0)
    for lab in (labels, none):
        out = toxicity.score_toxicity(awkward, lab).collect()
        assert Counter(r["doc_id"] for r in out) == Counter(r["doc_id"] for r in awkward.collect())
        for r in out:
            assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
            assert r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    assert toxicity.score_toxicity(nothing, labels).collect() == []


# simhash


def brute_simhash(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(codes, max_bits):
    """codes: [(doc_id, code)] -> component ids in the same order."""
    group = list(range(len(codes)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i][1] ^ codes[j][1]).bit_count() <= max_bits:
                group[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(codes):
        least[find(i)].append(doc_id)
    return [min((d for d in least[find(i)] if d is not None), default=None) for i in range(len(codes))]


def test_simhash(docs, awkward, nothing):
    for df in (docs, awkward):
        rows = [(r["doc_id"], brute_simhash(r["text"])) for r in df.collect()]
        want = Counter((d, f"{c:016x}", k) for (d, c), k in zip(rows, brute_components(rows, 4), strict=True))
        assert Counter(map(tuple, simhash.simhash_components(df).collect())) == want
        kept = simhash.drop_near_copies(df)
        assert kept.columns == df.columns
        classes = Counter(brute_components([(i, c) for i, (_, c) in enumerate(rows)], 4))
        assert kept.count() == len(classes)
    assert simhash.simhash_components(nothing).collect() == []
    assert simhash.drop_near_copies(nothing).collect() == []


def test_links_of_hot_routes_and_chains(spark):
    """One family of codes a few bits apart (blocks), random codes, and a long chain."""
    rng = random.Random(8)
    base = rng.getrandbits(64)
    codes = {base ^ sum(1 << b for b in rng.sample(range(30), rng.randint(0, 9))) for _ in range(900)}
    codes |= {rng.getrandbits(64) for _ in range(300)}
    chain = rng.getrandbits(64)
    for k in range(40):
        chain ^= sum(1 << b for b in rng.sample(range(64), 4))
        codes.add(chain)
    codes = sorted(codes)
    want = brute_components([(i, c) for i, c in enumerate(codes)], 4)
    signed = spark.createDataFrame([(simhash._signed(c),) for c in codes], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.connected_components(simhash.fingerprint_links(signed, 4, block=60)).collect()}
    got = [roots.get(simhash._signed(c), simhash._signed(c)) for c in codes]
    assert len(set(zip(want, got, strict=True))) == len(set(want)) == len(set(got))


def test_routes_bring_every_linked_pair_together():
    rng = random.Random(6)
    for n in (10, 10**7, 10**10, 10**13):
        masks = simhash.routing(n, 4)
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a ^ sum(1 << k for k in rng.sample(range(64), 4))
            assert any(a & m == b & m for m in masks)


def test_gray_tree_search_equals_all_pairs():
    rng = np.random.default_rng(3)
    for t in range(25):
        n = int(rng.integers(1, 400))
        codes = rng.integers(0, 2**63, size=max(1, n // 20), dtype=np.uint64)[rng.integers(0, max(1, n // 20), n)]
        for _ in range(int(rng.integers(0, 9))):
            codes = codes ^ (np.uint64(1) << rng.integers(0, 24 if t % 2 else 64, n).astype(np.uint64))
        groups = rng.integers(0, 4, n).astype(np.uint64)
        groups, codes = np.unique(np.stack([groups, codes], 1), axis=0).T
        order = np.lexsort((simhash.gray_rank(codes), groups))
        codes, groups = codes[order], groups[order]
        forest = simhash.Forest(len(codes))
        i, j = np.nonzero((np.bitwise_count(codes[:, None] ^ codes) <= 4) & (groups[:, None] == groups))
        forest.link(i, j)
        for chunk in (50, 200_000):
            assert (simhash.link_codes(codes, groups, 4, chunk) == forest.root).all()


# url filter


def test_url_filter(spark):
    urls = {
        "http://a.org/x": ("a.org", "/x", "org/", "allow"),
        "http://A.Example.ORG/es/1?q#f": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "http://x.com/fr/porn": ("x.com", "/fr/porn", "com/fr/", "allow"),
        "http://x.com/FR/": ("x.com", "/FR/", None, "allow"),
        "http://x.org": ("x.org", "", None, "allow"),
        "http://x.net/Porn.html": ("x.net", "/Porn.html", None, "block"),
        "http://x.net/popcornporn/": ("x.net", "/popcornporn/", None, "allow"),
        "http://essex.net/sex": ("essex.net", "/sex", None, "allow"),
        "http://x.net/sex?casino": ("x.net", "/sex", None, "block"),
        "http://x.net/sex/sex": ("x.net", "/sex/sex", None, "allow"),
        "no scheme xxx": ("", "", None, "block"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    rows = [(None if i == 3 else i, u, "h", "x") for i, u in enumerate(urls)]
    df = spark.createDataFrame(rows + rows[:1], "page_id long, url string, html string, host string")
    out = Counter(tuple(r)[:5] for r in url_filter.judge_urls(df, jobs.URL_RULES).collect())
    assert out == Counter((r[0], *urls[r[1]]) for r in rows + rows[:1])
    assert url_filter.judge_urls(df.limit(0), jobs.URL_RULES).collect() == []


# the pipeline


def brute_filter(rows):
    """(id, text, host) of the documents the quality stage keeps, boilerplate lines cut out."""
    normal = lambda line: re.sub("[0-9]+", "0", re.sub("[ \t-\r]+", " ", line).strip(" ").lower())
    words = lambda line: len(re.findall("[^ \t-\r]+", line))
    holders = defaultdict(set)
    for host, text in {(host, text) for _, text, host in rows}:
        lines = {normal(x): words(x) for x in (text or "").split("\n") if words(x)}
        by_length = sorted(lines, key=lambda x: -len(x.encode()))
        for line, n in lines.items():
            others = [x for x in by_length if x != line]
            holders[host, line].add(("line", others[0]) if n > 25 and others else ("text", text))
    out = []
    for i, text, host in rows:
        n_words, _, _, _, n_repeat = brute_quality(text or "")
        lines = (text or "").split("\n")
        gone = [bool(words(x)) and len(holders[host, normal(x)]) > 10 for x in lines]
        lost = sum(words(x) for x, g in zip(lines, gone, strict=True) if g)
        if n_words >= 50 and 100 * n_repeat <= 50 * n_words and lost <= 0.5 * n_words:
            out.append((i, "\n".join(x for x, g in zip(lines, gone, strict=True) if not g) if any(gone) else text, host))
    return out


def brute_strip(rows):
    """(id, text) after the line dedup stage: chunks, whole texts and passages of over 50 words, later copies cut out."""
    words = lambda line: len(re.findall("[^ \t-\r]+", line))
    found, split = defaultdict(list), {}
    for row, (i, text) in enumerate(rows):
        lines = split[row] = text.split("\n")
        w, n = [words(x) for x in lines], len(lines)
        h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
        roll = [((h[k - 1] if k else 0) * 1_000_003 + h[k]) % 2_147_483_647 for k in range(n)]
        cuts = [0] + [
            k for k in range(1, n)
            if w[k - 1] > 50 or w[k] > 50 or (2 <= k < n - 1 and roll[k - 1] < roll[k - 2] and roll[k - 1] <= roll[k])
        ] + [n]
        places = {(a, b - a) for a, b in zip(cuts, cuts[1:]) if sum(x > 0 for x in w[a:b]) >= 2 or max(w[a:b]) > 50}
        if any(w):
            places.add((0, n))
        for k in (k for k in range(n) if w[k]):
            ahead = next((e for e in range(k, n) if sum(w[k : e + 1]) > 50), None)
            back = next((e for e in range(k, -1, -1) if sum(w[e : k + 1]) > 50), None)
            places |= {(k, ahead - k + 1)} if ahead is not None else set()
            places |= {(back, k - back + 1)} if back is not None else set()
        for a, size in places:
            found["\n".join(lines[a : a + size])].append((i, row, a, size))
    gone = defaultdict(set)
    for copies in found.values():
        for _, row, a, size in sorted(copies)[1:]:
            gone[row].update(range(a, a + size))
    out = []
    for row, (i, text) in enumerate(rows):
        left = [x for k, x in enumerate(split[row]) if k not in gone[row]]
        out.append((i, text if not gone[row] else "\n".join(left) if any(map(words, left)) else ""))
    return out


def test_pipeline_equals_its_stages_by_brute_force(spark):
    """run() against plain Python versions of the stages it is made of."""
    import corpus_pipeline

    documents = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    filtered = brute_filter(sorted(documents))
    assert 0 < len(filtered) < len(documents)
    texts = dict(brute_strip([(i, t) for i, t, _ in filtered]))
    codes = [(i, brute_simhash(t)) for i, t in sorted(texts.items())]
    firsts = {c for c in brute_components(codes, 4)}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {i: texts[i] for i in firsts if not brute_hits(texts[i], items, 10)[1]}
    out = corpus_pipeline.run(spark, SF).collect()
    n, bound = check_packing(out, left, 1024)
    assert n <= bound + max(2, bound // 50)


def test_stages_equal_brute_force_with_boilerplate_and_copies(spark, docs):
    """The quality and line dedup stages on many small documents with shared lines, passages, copies and blank lines."""
    import duckdb

    from recoda.llm import oracle

    rng = random.Random(9)
    vocabulary = [w for r in docs.select("text").take(3) for w in r["text"].split()][:400]
    line = lambda n: " ".join(rng.choices(vocabulary, k=n))
    shared, passages = [line(8), line(40), line(70)], [[line(20), "", line(25), line(15)], [line(60)], [line(9)] * 7]
    rows = []
    for i in range(80):
        parts = [line(rng.choice([3, 12, 30, 55])) for _ in range(rng.randint(2, 7))]
        parts[1:1] = rng.choice(passages) if i % 3 == 0 else []
        parts += rng.sample(shared, rng.randint(0, 3)) if i % 2 else []
        rows.append((i, "\n".join(parts), f"s{i % 2}"))
    rows += [(100 + i, rows[i][1], "s0") for i in range(5)] + [(200, "", "s0"), (201, "\n \n", "s1")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    want = brute_filter(rows)
    kept_rows = quality.filter_quality(df).collect()
    assert sorted((r["doc_id"], r["text"], r["source"]) for r in kept_rows) == sorted(want)
    assert 0 < len(want) < len(rows) and any(t != dict((r[0], r[1]) for r in rows)[i] for i, t, _ in want)
    stripped = line_dedup.strip_repeated_lines(df).collect()
    assert sorted((r["doc_id"], r["text"]) for r in stripped) == sorted(brute_strip([r[:2] for r in sorted(rows)]))
    # the queries of both operators follow the same rule, and so does their SQL
    queries = [(oracle.OP1_SQL, line_dedup.dedup_lines(df)), (oracle.OP6_SQL, quality.judge_quality(df))]
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    for sql, out in queries:
        want = con.sql(sql)
        assert Counter(out.select(*want.columns).collect()) == Counter(want.fetchall())
    judged = {r["doc_id"]: r["kept"] for r in queries[1][1].collect()}
    assert {i for i, kept in judged.items() if kept} == {r["doc_id"] for r in kept_rows}
    deduped = Counter((r["doc_id"], r["text"]) for r in queries[0][1].collect())
    assert deduped == Counter((r["doc_id"], r["text"]) for r in stripped)


def test_pipeline_stages_keep_the_columns(spark, awkward):
    import corpus_pipeline

    df = awkward
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, SF).columns == df.columns
        assert stage(spark, df.limit(0), SF).collect() == []


def test_registered():
    import __spark_entry__ as entry

    assert set(jobs.QUERIES) | {"pipeline"} <= set(entry.queries())
