from collections import Counter

import numpy as np
import pytest

from poststream.llm import lines

BLANKS = " \t\n\x0b\x0c\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_docs=10, min_chars=1):
    keys = [[x.strip(BLANKS).translate(UPPER) for x in (t or "").split("\n")] for _, t in rows]
    docs = Counter(k for own in keys for k in set(own) if len(k) >= min_chars)
    out = []
    for (i, t), own in zip(rows, keys):
        stay = [x for x, k in zip((t or "").split("\n"), own) if docs[k] < min_docs]
        out.append((i, len(own), len(own) - len(stay), "\n".join(stay)))
    return sorted(out, key=str)


def made():
    rows = [(i, f"Own line {i}\n  SHARED by all \r\nthird of {i % 3}\n\n\xa0Nine\n{'É' if i % 2 else 'é'}tage")
            for i in range(60)]
    rows += [(None, "shared BY all\nnull id"), (None, "shared by all\nnull id"), (7, None), (8, ""),
             (9, "\n\n"), (9, " \t\n x"), (3, "x" * 300_000 + "\nshared by all"),
             (4, "\n".join(f"row {i % 1000}" for i in range(50_000)))]
    rows += [(100, "copied text\nshared by all\nsecond line")] * 40
    rows += [(200 + i, f"nine of them\nalone {i}") for i in range(9)]
    return rows


@pytest.mark.parametrize("hot_docs, shard_keys, min_docs, min_chars", [
    (1000, 4096, 10, 1), (50, 16, 10, 1), (1, 64, 41, 1), (1000, 8, 3, 6)])
def test_equals_plain_counts(spark, hot_docs, shard_keys, min_docs, min_chars):
    rows = made()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'x' as a", "'y' as drops", "'z' as shard").repartition(5)
    got = lines.drop_common_lines(docs, min_docs, min_chars, shard_keys, hot_docs)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows, min_docs, min_chars)


def test_documents_and_odd_rows(docs, rows):
    got = lines.drop_common_lines(docs)
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(
        [(r["doc_id"], r["text"]) for r in rows])


def test_sorted_join_gives_the_same(spark):
    """The way for verdicts too large to broadcast."""
    rows = made()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = lines.drop_common_lines(docs, hot_docs=10 ** 9).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted([tuple(r) for r in got], key=str) == brute(rows)


def test_shard_is_a_minimal_perfect_hash():
    rng = np.random.default_rng(3)
    for size in (0, 1, 2, 5000):
        a, b = rng.integers(-2 ** 63, 2 ** 63 - 1, (2, size))
        n = rng.integers(1, 70_000, size)
        shard = lines.Shard.build(a, b, n)
        assert len(shard.counts) == len(shard.prints) == size
        assert (shard.count(a, b) == n).all()
        other = rng.integers(-2 ** 63, 2 ** 63 - 1, (2, 5000))
        assert not shard.count(*other).any()
        assert shard.bits.nbytes * 8 <= 4 * max(size, 64)
    assert shard.counts.itemsize == 4 and lines.Shard.build(a, b, n % 200).counts.itemsize == 1


def test_no_documents(no_docs):
    assert lines.drop_common_lines(no_docs).count() == 0
