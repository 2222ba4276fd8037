"""One registered query per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from poststream.llm import compression, dac, langid, licenses, lines, merkle, mixing, packing, \
    pii, resample, simhash, trie, winnow
from poststream.llm.tokens import tokenizer_path
from poststream.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return wrap


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@_query("op1_mix_sources", mixing.MIX_SQL)
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its source's target and the words the mix takes."""
    return mixing.mix(documents(spark, sf_dir)).select(
        "doc_id", "size", "source_size", "target", "taken")


@_query("op2_compression_bands")
def op2_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, base rule and the compression verdict of every document, by
    limits learned from the labels."""
    docs = documents(spark, sf_dir)
    bands = compression.fit_bands(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return compression.compression_bands(docs, bands).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "ratio", "odd_chunks")


@_query("op3_winnowing")
def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowing fingerprint of every document and of its edited text."""
    return winnow.fingerprint_pairs(documents(spark, sf_dir))


@_query("op4_simhash_components")
def op4_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(documents(spark, sf_dir)).select(
        "doc_id", simhash.hex16().alias("fingerprint"), "component_id")


@_query("op5_license_scan")
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licenses that each document names."""
    return licenses.scan(documents(spark, sf_dir))


@_query("op6_language_id")
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, with the held-out mark."""
    return langid.identify(documents(spark, sf_dir)).select(
        "doc_id", "held_out", "lang_pred", "score")


@_query("op7_personal_data")
def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base counts and all spans."""
    return pii.summary(documents(spark, sf_dir))


@_query("op8_addressable_tokens")
def op8_addressable_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids as read back from the written files."""
    folder = scratch_path(spark, "token-files")
    dac.write_ids(documents(spark, sf_dir), folder, tokenizer_path("word_bpe_49k.json"))
    return dac.read_documents(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@_query("op9_importance_resampling")
def op9_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance weight and draw of every document."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return resample.resample(documents(spark, sf_dir), labels)


@_query("op10_harmonic_packing")
def op10_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every tokenized document with its place in a sequence."""
    packed = packing.pack(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


@_query("op11_merkle_manifest", merkle.MERKLE_SQL)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and the root folded from its (tampered) leaf."""
    return merkle.tamper_check(documents(spark, sf_dir), scratch_path(spark, "manifest"))


@_query("op12_line_dedup", lines.LINES_SQL)
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten documents or more share."""
    return lines.drop_common_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@_query("op13_prefix_trie", trie.TRIE_SQL)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return trie.prefix_trie(trie.rebuilt(conversations))
