import corpus_pipeline as C
from conftest import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as E
from llm.test_packing import check as check_packed
from llm.test_pii import brute as pii_of
from llm.test_simhash import brute as fingerprint, classes


def test_registered():
    names = E.queries()
    assert "pipeline" in names
    assert sorted(n.split("_")[0] for n in names if n.startswith("op")) == sorted(
        f"op{i}" for i in range(1, 14))
    assert "op1_mix_sources" in E.oracle_sql()


def test_stages_against_brute_force(spark, docs):
    from tokenizers import Tokenizer
    from poststream.llm.tokens import tokenizer_path
    table = docs.select("doc_id", "text", "lang", "source", "n_chars")
    state = table
    seen = {}
    for name, stage in C.STAGES:
        state = stage(spark, state, SF_SMALL)
        if name != "packing":
            assert state.columns == table.columns
        seen[name] = [r.asDict() for r in state.collect()]
        if name != "packing":
            state = spark.createDataFrame(state.collect(), table.schema).repartition(4)
    first = seen["language_id"]
    assert not {r["doc_id"] for r in first} & {9001, 9002, 9003, 9009}
    ids = [r["doc_id"] for r in first]
    group = classes([fingerprint(r["text"]) for r in first], ids)
    second = seen["near_dedup"]
    assert sorted((r["doc_id"] for r in second), key=repr) == sorted(set(group), key=repr)
    third = {r["doc_id"]: r for r in seen["personal_data"]}
    assert set(third) == {r["doc_id"] for r in second}
    for r in second:
        assert not pii_of(third[r["doc_id"]]["text"])
        if not pii_of(r["text"]) and "[" not in third[r["doc_id"]]["text"]:
            assert third[r["doc_id"]]["text"] == r["text"]
    words = lambda rs: sum(len(r["text"].split()) for r in rs)
    assert abs(words(seen["source_mix"]) / words(third.values()) - 1) < 0.2
    packed = [{**p, "ids_crc32": __import__("zlib").crc32(p["ids"])} for p in seen["packing"]]
    name = tokenizer_path("byte_bpe_50k.json")
    assert check_packed(packed, seen["source_mix"], Tokenizer.from_file(name)) < 0.01


def test_empty_tables_pass(spark, no_docs):
    state = no_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in C.STAGES:
        state = stage(spark, state, SF_SMALL)
        assert state.count() == 0


def test_run_over_the_small_tables(spark):
    out = C.run(spark, SF_SMALL)
    assert out.agg(F.sum("length")).first()[0] > 0
    assert {"doc_id", "sequence_id", "offset", "ids"} <= set(out.columns)
