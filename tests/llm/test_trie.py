import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from poststream.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Every node with every number by definition."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    name = lambda t: hashlib.md5(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).hexdigest()
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: (t[0], t[1], t[2], name(t)))]
           for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = own.get(base, [])[:h] + ts[h:]
    members = defaultdict(list)
    for c, s in built.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = []

    def walk(p):
        below = [walk(q) for q in children[p]]
        leaves = sum(b[0] for b in below) or 1
        saved = sum(b[1] for b in below) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        ends = sorted(c for c in members[p] if len(built[c]) == len(p))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]),
                    len(children[p]), leaves, saved,
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
        return leaves, saved
    if members:
        walk(())
    return sorted(out, key=str)


def made(seed, convs=130, words=2):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.choice([1, 2, 3, 5, 8, 8, 9])):
            rows.append((c * rng.choice([1, 1, 7]), t, "user" if t % 2 == 0 else "assistant",
                         "ä" * rng.randint(0, words)))
    return rows


def odd():
    rows = [(None, 1, "user", "left out"), (-150, None, None, None), (-150, 3, "user", "x"),
            (-101, 1, "user", "y"), (301, 0, "user", ""), (301, 0, "user", ""), (302, 1, None, "z"),
            (303, 5, "user", "no base"), (400, None, "a", "1"), (400, 0, "b", "1"), (400, 0, "a", "2")]
    rows += [(400 + i, t, "user", f"same {t}") for i in range(1, 99) for t in range(7)]
    rows += [(700, t, "user", f"turn {t % 5}") for t in range(900)]
    rows += [(701, t, "user", f"turn {t % 5}") for t in range(850)]
    rows += [(702, 0, "user", "long " * 40_000)]
    return rows


def run(spark, rows, **how):
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as depth", "2 as key", "'x' as own")
    got = trie.prefix_trie(trie.rebuilt(frame.repartition(4)), **how)
    assert got.columns == trie.OUT
    return sorted([tuple(r) for r in got.collect()], key=str)


@pytest.mark.parametrize("segment_turns", [1, 40, 1 << 16])
def test_equals_definition(spark, segment_turns):
    for rows in (made(1), odd()):
        assert run(spark, rows, segment_turns=segment_turns) == brute(rows)


def test_hot_copies_over_many_segments(spark):
    rows = [(c, t, "user", f"hello {t}") for c in range(1000, 1900) for t in range(6)] + made(2, 40)
    assert run(spark, rows, segment_turns=64) == brute(rows)


def test_given_conversations(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert run(spark, rows, segment_turns=200) == brute(rows)


def test_no_conversations_and_only_null_ids(spark):
    assert run(spark, []) == [] and run(spark, [(None, 0, "user", "x")]) == []
    alone = [(1, 0, "user", "short")]     # its first turns come from an absent conversation
    assert run(spark, alone) == brute(alone)


def test_extents_by_range_minima():
    rng = np.random.default_rng(5)
    for n in (2, 3, 17, 200):
        lcp = rng.integers(0, 5, n - 1)
        table = trie.minima(lcp)
        row, depth = np.repeat(np.arange(n), 6), np.tile(np.arange(6), n)
        left, right = trie.leftmost(table, row, depth), trie.rightmost(table, row, depth)
        for i, d, a, b in zip(row, depth, left, right):
            assert (lcp[a:i] >= d).all() and (a == 0 or lcp[a - 1] < d)
            assert (lcp[i:b] >= d).all() and (b == n - 1 or lcp[b] < d)
