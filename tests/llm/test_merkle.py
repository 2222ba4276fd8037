import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from poststream.llm import merkle, sha
from poststream.session import scratch_path

LOW = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def row_leaf(r, text):
    fields = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def brute(rows):
    """Trees as plain lists; returns the wanted rows, sorted."""
    trees = {}
    for r in rows:
        trees.setdefault(r["lang"], []).append(r)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))

    def rise(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            last = levels[-1]
            levels.append([digest(*last[i: i + 8]) for i in range(0, len(last), 8)])
        return levels

    built = {}
    for lang in langs:
        own = sorted(trees[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0,
                                                 row_leaf(r, r["text"])))
        built[lang] = own, rise([row_leaf(r, r["text"]) for r in own])
    top = rise([built[x][1][-1][0] for x in langs])
    root = top[-1][0]
    out = []
    for k, lang in enumerate(langs):
        own, levels = built[lang]
        for pos, r in enumerate(own):
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text:
                text = text.encode().translate(LOW).decode()
            new, proof = row_leaf(r, text), []
            for at, tree in ((pos, levels), (k, top)):
                for nodes in tree[:-1]:
                    run = at - at % 8
                    left, right = nodes[run: at], nodes[at + 1: run + 8]
                    proof += left + right
                    new = digest(*left, new, *right)
                    at //= 8
            out.append((r["doc_id"], row_leaf(r, r["text"]), levels[-1][0], root, digest(*proof),
                        new, new == root))
    return sorted(out, key=str)


def test_sha_states_resume():
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 256, 32 * 9, dtype=np.uint8).tobytes()
    words = sha.from_bytes(raw)
    assert sha.to_bytes(words) == raw
    parents, states = merkle.grow(words)
    hexes = [raw[32 * i: 32 * i + 32].hex() for i in range(9)]
    assert sha.to_bytes(parents).hex() == digest(*hexes[:8]) + digest(hexes[8])
    # the state kept before slot 5, resumed with the children from there on
    state = states[:, 5:6]
    for i in (5, 6, 7):
        state = sha.step(state, sha.hex_block(words[:, i: i + 1]))
    assert sha.to_bytes(sha.finish(state, np.array([8], np.uint32))).hex() == digest(*hexes[:8])


@pytest.mark.parametrize("deep", [1, 4])
def test_equals_plain_tree(spark, docs, rows, deep):
    got = merkle.tamper_check(docs, scratch_path(spark, "merkle"), deep)   # 1: many passes
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


def test_many_languages_and_equal_rows(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    made = [(i % 7 if i % 3 else None, "s", f"l{i}" if i < 90 else None, i % 2, "Text" if i % 5 else None)
            for i in range(400)]
    docs = spark.createDataFrame(made, schema).repartition(6)
    rows = [dict(zip(("doc_id", "source", "lang", "n_chars", "text"), r)) for r in made]
    got = merkle.tamper_check(docs, scratch_path(spark, "merkle"))
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute(rows)


def test_fold_of_some_leaves(spark, docs):
    folder = scratch_path(spark, "merkle")
    merkle.build(docs, folder)
    leaves = spark.read.parquet(f"{folder}/leaves").where("doc_id = 9004 or doc_id = 9001")
    same = merkle.fold(spark, folder, leaves).collect()
    assert len(same) == 2 and all(r["folded_root"] == r["root"] for r in same)
    other = merkle.fold(spark, folder, leaves.withColumn("digest", F.unhex(F.sha2("digest", 256)))).collect()
    assert len({r["folded_root"] for r in other} | {same[0]["root"]}) == 3


def test_one_row_and_none(spark, docs, no_docs):
    assert merkle.tamper_check(no_docs, scratch_path(spark, "merkle")).count() == 0
    one = merkle.tamper_check(docs.where("doc_id = 9001"), scratch_path(spark, "merkle")).collect()
    assert one[0]["leaf"] == one[0]["subroot"] == one[0]["root"] == one[0]["folded_root"]
    assert one[0]["proof_sha256"] == digest("") and one[0]["verified"]
