import math
import re
from collections import Counter

import pyarrow as pa
import pytest

from poststream.llm import resample as R


def test_draws_k_and_prefers_good_text(spark, docs, rows, labels):
    got = R.resample(docs, labels, k=120).collect()
    assert len(got) == len(rows)
    kept = [r for r in got if r["kept"]]
    assert 120 <= len(kept) <= 121     # a repeated row may come along
    assert min(r["key"] for r in kept) >= max(r["key"] for r in got if not r["kept"])
    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    all_kept = {r["doc_id"] for r in R.resample(docs, labels).where("kept").collect()}
    def share(q):
        ids = [i for i, x in quality.items() if x == q]
        return sum(i in all_kept for i in ids) / len(ids)
    assert share(1) > share(0) + 0.4
    assert all(r["n_grams"] == 0 for r in got if r["doc_id"] in (9001, 9002, 9003))


def test_no_labels_draws_evenly_and_repeats(spark, docs, labels):
    none = labels.where("false")
    a = {r["doc_id"]: (r["key"], r["kept"]) for r in R.resample(docs, none, k=50).collect()}
    b = {r["doc_id"]: (r["key"], r["kept"]) for r in R.resample(docs.repartition(3), none, k=50).collect()}
    assert a == b
    assert all(r["log_weight"] == 0 for r in R.resample(docs, none, k=50).collect())


@pytest.mark.parametrize("k", [1, 2, 500, 19_999, 20_000, 20_001])
def test_kth_largest(spark, k):
    keys = spark.range(20_000).selectExpr("case when id % 3 = 0 then 1.5D else sin(id) * id * id end as key")
    values = sorted((1.5 if i % 3 == 0 else math.sin(i) * i * i for i in range(20_000)), reverse=True)
    got = R.kth_largest(keys, "key", k)
    assert got is None if k > 20_000 else got == pytest.approx(values[k - 1], abs=1e-9)


def test_ngrams_count():
    found, n = R.ngram_buckets(pa.array(["a b c", None, " ", "x", "A B C"]))
    assert n.tolist() == [5, 0, 0, 1, 5] and found[:5].tolist() == found[6:].tolist()


def plain_buckets(text):
    """Bucket of every 1- and 2-gram by the definition, one word at a time."""
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    step, mix, hashes = int(R.STEP), int(R.MIX), []
    for w in words:
        h = sum((c + 32 * (65 <= c <= 90) + 1) * step ** i for i, c in enumerate(w)) % 2 ** 64
        hashes.append((h ^ h >> 29) * mix % 2 ** 64)
    pairs = [(a * step + b) * mix % 2 ** 64 for a, b in zip(hashes, hashes[1:])]
    return [h >> 64 - R.BITS for h in hashes + pairs]


@pytest.mark.parametrize("tempered", [False, True])
def test_weights_and_keys_equal_a_plain_count(spark, labels, tempered):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(None, "Some Words here"), (7001, None)], docs.schema))
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1 and not r["toxic"]}
    grams = {r["doc_id"]: plain_buckets(r["text"]) for r in docs.collect()}
    raw, target = Counter(), Counter()
    for i, g in grams.items():
        raw.update(g)
        if i in good:
            target.update(g)
    n_raw, n_target = sum(raw.values()) + R.BUCKETS, sum(target.values()) + R.BUCKETS
    for r in R.resample(docs, labels, k=40, tempered=tempered).collect():
        g = grams[r["doc_id"]]
        want = sum(math.log((target[b] + 1) / n_target) - math.log((raw[b] + 1) / n_raw) for b in g)
        if tempered:
            want /= math.sqrt(max(1, len(g)))
        assert r["n_grams"] == len(g) and r["log_weight"] == pytest.approx(want, abs=1e-6)
        if g:
            assert -6 < r["key"] - r["log_weight"] < 40      # Gumbel noise


def test_empty(no_docs, labels):
    assert R.resample(no_docs, labels).count() == 0
