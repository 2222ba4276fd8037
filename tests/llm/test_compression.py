import re
from collections import Counter

import numpy as np
import zstandard

from conftest import SF_SMALL
from poststream.llm import compression as C

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, bands=C.BANDS):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i: i + 3]) for i in range(len(words) - 2)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered |= {i, i + 1, i + 2}
    raw = text.encode()
    z = zstandard.ZstdCompressor(level=C.LEVEL)

    def ok(part):
        ratio = len(z.compress(part)) / len(part)
        low, high = [b[1:] for b in bands if b[0] <= len(part)][-1]
        return low <= ratio <= high
    odd = 0
    for size in (256, 1024, 4096):      # every length at every size; the last chunk by its new bytes
        whole = len(raw) // size
        if whole:
            bad = sum(size for k in range(whole) if not ok(raw[size * k: size * (k + 1)]))
            bad += (len(raw) % size) * (not ok(raw[-size:]))
            odd = max(odd, bad / len(raw))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    kept = not failed and ok(raw) and odd <= C.CHUNK_SHARE
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered),
            failed, kept)


def test_equals_brute_force(docs, rows):
    got = C.compression_bands(docs).collect()
    assert sorted(((r["doc_id"],) + tuple(r[c] for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"))
        for r in got), key=repr) == sorted(((r["doc_id"],) + brute(r["text"]) for r in rows), key=repr)


def noise_in_turns(n):
    """Base64 noise and repeated words in turns of 256 bytes, ``n`` bytes in all."""
    import base64
    import random
    rng = random.Random(8)
    noise = lambda: base64.b64encode(rng.randbytes(192)).decode()
    return "".join(noise() if k % 2 else ("same words here " * 16)[:256] for k in range(n // 256 + 1))[:n]


def test_one_chunk_rule_at_every_size(spark):
    good = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect() if r["text"]]
    texts = [noise_in_turns(n) for n in (2000, 8191, 8192, 40_000)] + [good[0][:n] for n in (8191, 8192)]
    long = " ".join(good)[:50_000]
    texts += [long[:40_000] + noise_in_turns(10_000), long[:4096] + noise_in_turns(4000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in C.compression_bands(frame).collect()}
    assert [got[i]["odd_chunks"] > C.CHUNK_SHARE for i in range(4)] == [True] * 4
    for i, t in enumerate(texts):
        assert got[i]["kept"] == brute(t)[-1], i


def test_limits_learned_from_labels(spark, labels):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    bands = C.fit_bands(docs, labels)
    assert [b[0] for b in bands] == [0, *C.CLASSES] and all(b[1] >= s for b, s in zip(bands, [0] + [0.15] * 7))
    got = C.compression_bands(docs, bands).where("not base_failed").join(labels, "doc_id").collect()
    bad = [r["kept"] for r in got if r["quality"] == 0]
    good = [r["kept"] for r in got if r["quality"] == 1]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.6 * len(bad)
    texts = {r["doc_id"]: r["text"] for r in docs.where("doc_id % 4 = 0").collect()}
    for r in C.compression_bands(docs.where("doc_id % 4 = 0"), bands).collect():
        assert r["kept"] == brute(texts[r["doc_id"]], bands)[-1]
    assert C.fit_bands(docs, labels.where("false"))[1:] == [
        (c, *[b[1:] for b in C.BANDS if b[0] <= c][-1]) for c in C.CLASSES]


def test_every_good_text_counts_for_the_limits(spark):
    """20,400 good texts: a few at the low end move the quantile, wherever their ids lie."""
    import zstandard
    same, plain = "abc " * 70, " ".join(f"{i * i % 9973:x}{i}" for i in range(70))[:280]
    for low in (range(0, 40), range(20_360, 20_400)):
        rows = spark.range(20_400).selectExpr(
            "id AS doc_id", f"IF(id BETWEEN {low[0]} AND {low[-1]}, '{same}', '{plain}') AS text")
        marks = spark.range(20_400).selectExpr("id AS doc_id", "1 AS quality")
        got = {b[0]: b[1] for b in C.fit_bands(rows, marks)}
        # 0.002 * 20,399 = 40.8: between the last low text's rank, 39, and 41
        ratio = len(zstandard.ZstdCompressor(level=C.LEVEL).compress(plain.encode())) / len(plain)
        assert abs(got[256] - ratio * C.MARGIN) < 1e-9
        got = {b[0]: b[1] for b in C.fit_bands(
            rows.unionByName(rows.where(f"doc_id = {low[0]}")).unionByName(rows.where(f"doc_id = {low[1]}")), marks)}
        ratio = len(zstandard.ZstdCompressor(level=C.LEVEL).compress(same.encode())) / len(same)
        assert abs(got[256] - ratio * C.MARGIN) < 1e-9


def test_low_quantiles_equal_sorting(spark):
    import random
    rng = random.Random(8)
    values = [(c, rng.choice([rng.random() * 2.5, 0.25, 0.25 + rng.random() / 5000]))
              for c in (256, 1024) for _ in range(1 if c == 256 else 1700)]
    got = C.low_quantiles(spark.createDataFrame(values, "least int, ratio double").repartition(3))
    for c in (256, 1024):
        mine = [v for k, v in values if k == c]
        assert got[c][0] == len(mine) and abs(got[c][1] - np.quantile(mine, C.LOW_QUANTILE)) < 1e-12
    assert C.low_quantiles(spark.createDataFrame([], "least int, ratio double")) == {}


def test_bands_reject_both_ends(spark):
    import base64
    import random
    rng = random.Random(3)
    noise = base64.b64encode(rng.randbytes(30_000)).decode()
    noise = " ".join(noise[i: i + 9] for i in range(0, len(noise), 9))
    prose = " ".join("".join(rng.choice(["an", "the", "re", "ti", "on", "es", "ha"]) for _ in range(
        rng.randint(1, 5))) for _ in range(4000))
    same = " ".join(f"w{i}" for i in range(60)) + " "
    frame = spark.createDataFrame([(1, noise), (2, prose), (3, prose[:9000] + same * 200)],
                                  "doc_id long, text string")
    kept = {r["doc_id"]: r["kept"] for r in C.compression_bands(frame).collect()}
    assert kept == {1: False, 2: True, 3: False}


def test_parts_of_every_text(spark):
    import base64
    import random
    rng = random.Random(5)
    noise = base64.b64encode(rng.randbytes(9_000)).decode()
    some = spark.read.parquet(f"{SF_SMALL}/documents.parquet") \
        .where("lang = 'en' and length(text) > 13000").select("doc_id", "text").collect()
    good = [r["text"] for r in some if brute(r["text"])[-1]][0]
    cases = [(good[:4096], noise[:4000]), (good[:2000], noise[:2000]), (good[:600], noise[:600]),
             (good[:8192], noise[:4095]), (good[:6000], noise[:3000]), (noise[:1500], good[:1500]),
             (good[:1300] + noise[:2600], good[1300:2600]), (good[:700], "same words here " * 44)]
    frame = spark.createDataFrame(
        [(i, " ".join(c)) for i, c in enumerate(cases)]
        + [(100 + i, good[:n]) for i, n in enumerate((700, 1100, 2300, 5000, 8191, 8200, 12287))],
        "doc_id long, text string")
    got = {r["doc_id"]: r for r in C.compression_bands(frame).collect()}
    for i in range(len(cases)):
        assert got[i]["odd_chunks"] > C.CHUNK_SHARE and not got[i]["kept"], i
    assert all(got[k]["odd_chunks"] == 0 and got[k]["kept"] for k in got if k >= 100)


def test_empty(no_docs):
    assert C.compression_bands(no_docs).count() == 0
