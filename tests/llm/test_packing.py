import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from poststream.llm import packing as K
from poststream.llm.tokens import tokenizer_path


def test_cuts():
    for r in range(K.CAPACITY):
        parts = K.cuts(r)
        assert sum(parts) == r and all(p > 0 for p in parts)
        waste = sum((K.CAPACITY - (K.CAPACITY // p) * p) / (K.CAPACITY // p) for p in parts)
        assert waste <= max(1.0, r / K.SLACK_SHARE + 3)


def check(pieces, rows, tok):
    ids = defaultdict(list)
    for r in rows:
        ids[r["doc_id"]].append(np.array(
            tok.encode(r["text"] or "", add_special_tokens=False).ids + [1], np.uint32))
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        docs[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        want = ids[p["doc_id"]][0]
        assert p["doc_tokens"] == len(want)
        assert zlib.crc32(want[p["start"]: p["start"] + p["length"]].tobytes()) == p["ids_crc32"]
    assert set(docs) == set(ids)
    for key, own in docs.items():   # repeated rows: each token as often as the row
        times = np.zeros(own[0]["doc_tokens"], int)
        for p in own:
            times[p["start"]: p["start"] + p["length"]] += 1
        assert (times == len(ids[key])).all()
    pad = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= K.CAPACITY
        total += at
        pad += 0 if at & (at - 1) == 0 else K.CAPACITY - at
    assert total == sum(len(x) for v in ids.values() for x in v)
    return pad / (pad + total)


def test_packs_every_id_once(docs, rows):
    name = tokenizer_path("byte_bpe_50k.json")
    packed = K.pack(docs, name).withColumn("ids_crc32", F.crc32("ids")).drop("ids").collect()
    assert check(packed, rows, Tokenizer.from_file(name)) < 0.01


def test_empty(no_docs):
    assert K.pack(no_docs, tokenizer_path("byte_bpe_50k.json")).count() == 0
