import time
import zlib

import numpy as np
from tokenizers import Tokenizer

from poststream.llm import dac
from poststream.llm.tokens import tokenizer_path
from poststream.session import scratch_path


def test_levels_round_trip_and_random_access():
    rng = np.random.default_rng(0)
    for n, top in ((0, 1), (1, 3), (5000, 200), (5000, 1 << 16), (5000, 1 << 31)):
        ids = rng.integers(0, top, n, dtype=np.uint32)
        levels = dac.encode_levels(ids)
        assert (dac.ids_between(levels, 0, n) == ids).all() and len(levels) == 1 + max(
            0, (int(ids.max(initial=0)).bit_length() - 1) // 8)
        for place in rng.integers(0, max(1, n), min(n, 300)).tolist():
            assert dac.token_at(levels, place) == ids[place]
            end = int(rng.integers(place, n + 1))
            assert (dac.ids_between(levels, place, end) == ids[place:end]).all()


def test_ranges_at_the_edges_of_blocks():
    for n in (1, 511, 512, 513, 1024, 1536):
        for ids in (np.arange(n, dtype=np.uint32) * 97 + 255, np.full(n, 70_000, np.uint32)):
            levels = dac.encode_levels(ids)
            edges = sorted({min(n, e) for b in range(0, n + 512, 512) for e in (b, b + 1, max(0, b - 1))})
            for a in edges:
                for b in edges:
                    if a <= b:
                        assert (dac.ids_between(levels, a, b) == ids[a:b]).all(), (n, a, b)


def test_a_range_reads_no_other_bytes():
    ids = np.random.default_rng(1).integers(0, 1 << 20, 4000, dtype=np.uint32)
    levels = dac.encode_levels(ids)
    spoiled = [dict(level) for level in levels]
    a, b = 1000, 1200
    for level in spoiled:   # everything but the range is overwritten
        lo, hi = a, b
        a, b = dac.rank_at(level, a), dac.rank_at(level, b)
        level["chunks"] = b"\xff" * lo + level["chunks"][lo:hi] + b"\xff" * (len(level["chunks"]) - hi)
    assert (dac.ids_between(spoiled, 1000, 1200) == ids[1000:1200]).all()


def test_files_equal_plain_encode(spark, docs, rows, monkeypatch):
    name = tokenizer_path("word_bpe_49k.json")
    folder = scratch_path(spark, "dac-test")
    dac.write_ids(docs, folder, name)
    got = dac.read_documents(spark, folder).collect()
    tok = Tokenizer.from_file(name)
    ids = {}
    for r in rows:
        ids[r["doc_id"]] = tok.encode(r["text"] or "", add_special_tokens=False).ids + [1]
    at = 0
    order = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in order] == sorted(
        (r["doc_id"] for r in rows), key=lambda x: (x is not None, x))
    for r in order:
        want = np.array(ids[r["doc_id"]], np.uint32)
        assert (r["start"], r["n_tokens"]) == (at, len(want))
        assert zlib.crc32(r["ids"]) == zlib.crc32(want.tobytes())
        at += len(want)
    places = [(5, 0), (7, 3), (9004, 20_000), (9004, 10 ** 9), (9008, 0), (9008, 1)]
    wanted = spark.createDataFrame(places, "doc_id long, place long")
    found = {(r["doc_id"], r["place"]): r["token"] for r in dac.read_places(
        spark, folder, wanted).collect()}
    assert found == {(d, p): ids[d][p] for d, p in places if p < len(ids[d])}


def test_many_tiny_documents(spark):
    docs = spark.range(16_000).selectExpr("id as doc_id", "'' as text")
    folder = scratch_path(spark, "dac-tiny")
    dac.write_ids(docs, folder, tokenizer_path("word_bpe_49k.json"))
    wanted = spark.createDataFrame([(15_999, 0), (3, 0), (3, 1)], "doc_id long, place long")
    begin = time.time()
    got = dac.read_places(spark, folder, wanted).collect()
    assert sorted(tuple(r) for r in got) == [(3, 0, 1), (15_999, 0, 1)] and time.time() - begin < 8


def test_empty(spark, no_docs):
    folder = scratch_path(spark, "dac-empty")
    dac.write_ids(no_docs, folder, tokenizer_path("word_bpe_49k.json"))
    assert dac.read_documents(spark, folder).count() == 0
