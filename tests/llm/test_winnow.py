import hashlib
import re
import struct

import regex
import xxhash
from pyspark.sql import functions as F

from poststream.llm import winnow as W

RUN = re.compile(r"[^\x20\x09-\x0D]+")
UNSPACED = regex.compile("[" + "".join(rf"\p{{{s}}}" for s in (
    "Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan")) + "]")


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def _hash(value, seed=42):
    raw = value.encode() if isinstance(value, str) else struct.pack("<q", value)
    return _signed(xxhash.xxh64_intdigest(raw, seed & (1 << 64) - 1))


def tokens(text):
    """Hashes of the tokens: pieces of 16 characters of a run, or 8 characters from
    each place of a run without blanks (over 48, or over 16 of an unspaced script)."""
    out = []
    for run in RUN.findall(text):
        if len(run) > 48 or len(run) > 16 and UNSPACED.search(run):
            chars = [_hash(c) for c in run]
            for i in range(len(run) - W.ROLL + 1):
                h = 42
                for c in chars[i: i + W.ROLL]:
                    h = _hash(c, h)
                out.append(h)
        else:
            out += [_hash(run[i: i + 16]) for i in range(0, len(run), 16)]
    return out


def brute(text):
    """(hash, position) chosen: least upper half of each window, rightmost."""
    words = tokens(text)
    if not words:
        return []
    grams = []
    for i in range(max(1, len(words) - W.K + 1)):
        h = 42
        for w in words[i: i + W.K]:
            h = _hash(w, h)
        grams.append(h)
    out = []
    for i in range(max(1, len(grams) - W.WINDOW + 1)):
        window = range(i, min(len(grams), i + W.WINDOW))
        at = min(window, key=lambda k: ((grams[k] >> 32) & 0xFFFFFFFF, -k))
        if (grams[at], at) not in out[-W.WINDOW:]:
            out.append((grams[at], at))
    return out


def _order(r):
    return (r["doc_id"] is not None, r["doc_id"] or 0, _hash(r["text"] or ""))


def test_winnow_equals_brute_force(docs, rows):
    got = W.with_winnow(docs.select("doc_id", "text"), "text", "own").select("text", "own").collect()
    assert any(len(tokens(r["text"] or "")) > 100_000 for r in got)   # rolled
    for r in got:
        if r["text"] is not None:
            assert [(e["hash"], e["position"]) for e in r["own"]] == brute(r["text"])


def test_pairs(docs, rows):
    got = W.fingerprint_pairs(docs).collect()
    assert len(got) == len(rows)
    down = sorted(rows, key=_order, reverse=True)
    want = []
    for r, nxt in zip(down, down[1:] + down[:1]):
        text, other = r["text"] or "", nxt["text"] or ""
        third = len(text) // 3
        edited = text[:len(text) - third] + other[:third]
        want.append((r["doc_id"], len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted([(g["doc_id"], g["n_chars"], g["edited_sha256"]) for g in got], key=repr) \
        == sorted(want, key=repr)
    sets = {}
    for r in rows:
        if r["text"]:
            sets[r["doc_id"]] = {h for h, _ in brute(r["text"])}
    for r, nxt in zip(down, down[1:]):
        a, b = sets.get(r["doc_id"]), sets.get(nxt["doc_id"])
        if a is None or b is None:
            continue
        near = [g["near_next"] for g in got if g["doc_id"] == r["doc_id"]]
        share = len(a & b) / len(a | b) if a | b else 1.0
        assert any(abs(n - share) < 1e-12 for n in near)
    own = {}
    for g in got:
        text = [r["text"] or "" for r in rows if r["doc_id"] == g["doc_id"]][0]
        assert own.setdefault(text, g["fingerprint"]) == g["fingerprint"]
        assert 0 <= g["near_edited"] <= 1 and 0 <= g["near_next"] <= 1


def test_many_ranges_find_the_same_neighbours(spark, docs, monkeypatch):
    one = {(r["doc_id"], r["edited_sha256"]) for r in W.fingerprint_pairs(docs).collect()}
    monkeypatch.setattr(W, "GROUP_ROWS", 9)
    many = {(r["doc_id"], r["edited_sha256"]) for r in W.fingerprint_pairs(docs).collect()}
    assert one == many


def test_match_guarantee(spark):
    shared = " ".join(f"s{i}" for i in range(W.K + W.WINDOW - 1))
    frame = spark.createDataFrame([(1, f"a b c {shared} d e"), (2, f"x {shared} y z w v u")],
                                  "doc_id long, text string")
    got = [{e["hash"] for e in r["own"]} for r in W.with_winnow(frame, "text", "own").collect()]
    assert got[0] & got[1]


def test_shifted_copies_of_unspaced_text(spark):
    import random
    rng = random.Random(4)
    han, thai = [chr(0x4E00 + k) for k in range(900)], [chr(0x0E01 + k) for k in range(40)]
    texts = ["".join(rng.choices(letters, k=3000)) for letters in (
        han, thai, "abcdefghijklmnopqrstuvwxyzABCDEFGH0123456789+/", han + ["\U0001F600", "\U00020000"])]
    cut = [texts[0][k: k + 40] for k in range(0, 3000, 40)]
    rows = [(i, shift, "x" * shift + t) for i, t in enumerate(texts) for shift in (0, 1, 7, 15, 16)]
    rows += [(9, 0, "\n".join(cut)), (9, 1, "\n".join("x" + line for line in cut))]
    frame = spark.createDataFrame(rows, "i int, shift int, text string")
    got = {(r["i"], r["shift"]): {e["hash"] for e in r["own"]}
           for r in W.with_winnow(frame, "text", "own").collect()}
    for (i, shift), hashes in got.items():
        least = 0.95 if i < 9 else 0.5
        assert len(hashes & got[i, 0]) > least * len(got[i, 0]), (i, shift)


def test_single_row_and_empty(spark, no_docs):
    assert W.fingerprint_pairs(no_docs).count() == 0
    one = spark.createDataFrame([(3, "abcdef")], "doc_id long, text string")
    row = W.fingerprint_pairs(one).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and row["near_next"] == 1.0
    assert W.fingerprint_pairs(one.select("doc_id", F.lit(None).cast("string").alias("text"))) \
        .first()["near_edited"] == 1.0
