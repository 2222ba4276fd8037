import re

import numpy as np
import pytest
import xxhash

from poststream.llm import simhash as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    shingles = [" ".join(words[i: i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 \
        else [" ".join(words)] if words else []
    ones = np.zeros(64, int)
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        ones += [(h >> b) & 1 for b in range(64)]
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def classes(fps, ids, radius=4):
    fps = np.array(fps, np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    group = np.arange(len(fps))
    while True:
        new = np.array([group[near[i]].min() for i in range(len(fps))])
        if (new == group).all():
            break
        group = new
    least = {}
    for g, i in zip(group, ids):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return [least.get(g) for g in group]


def test_equals_brute_force(docs, rows):
    got = S.near_duplicates(docs).select("doc_id", S.hex16().alias("f"), "component_id").collect()
    fps = [brute(r["text"]) for r in rows]
    ids = [r["doc_id"] for r in rows]
    want = zip(ids, (f"{f:016x}" for f in fps), classes(fps, ids))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    kept_ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(kept_ids, key=repr) == sorted(set(classes(fps, ids)), key=repr)


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_forest_connects_what_brute_force_links(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate(
        [base] + [base ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) for _ in range(5)]
        + [base ^ np.uint64(0b10110111)]))
    left, right = fps[::2], fps[1::2]
    on_left = np.isin(fps, left)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    at = {int(v): i for i, v in enumerate(fps)}

    def groups(links):
        links = links | np.eye(len(fps), dtype=bool)
        g = np.arange(len(fps))
        while True:
            new = np.array([g[links[i]].min() for i in range(len(fps))])
            if (new == g).all():
                return g
            g = new
    for pairs, wanted in ((S.forest(fps, None, radius), near),
                          (S.forest(left, right, radius), near & (on_left[:, None] != on_left))):
        found = np.zeros_like(near)
        for a, b in pairs:
            found[at[int(a)], at[int(b)]] = found[at[int(b)], at[int(a)]] = True
        assert (groups(found) == groups(wanted)).all() and len(pairs) < len(fps)


def test_tile_plan_covers_every_near_pair_once():
    rng = np.random.default_rng(1)
    counts = {p: int(n) for p, n in enumerate(rng.integers(0, 300, 65)) if n}
    counts[32] = 5000
    plan = S.tile_plan(counts, 4, least=10)
    for p in counts:
        for q in counts:
            tiles_p = range(plan[p][0], plan[p][0] + plan[p][1])
            tiles_q = range(plan[q][0], plan[q][0] + plan[q][1])
            for a in tiles_p:
                for b in tiles_q:
                    a_meets = plan[p][2] <= b <= plan[p][3]
                    b_meets = plan[q][2] <= a <= plan[q][3]
                    assert a_meets == b_meets
                    assert a_meets or abs(p - q) > 4


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 240)]
    got = S.components(spark.createDataFrame(path + star + [(5, 5)], "a long, b long")).collect()
    group = {r["node"]: r["label"] for r in got}
    assert len({group[i] for i in range(100, 161)}) == 1
    assert len({group[i] for i in [7, *range(200, 240)]}) == 1 and group[7] != group[100]


def test_empty(no_docs):
    assert S.near_duplicates(no_docs).count() == 0 and S.keep_one(no_docs).count() == 0
