"""The training-data pipeline: five stages over ``documents``.

Each stage works on every row that its predecessor kept, its result is written
as Parquet and read again as the next one's input, so a lost executor or a
failed stage never repeats an earlier stage.  All stages but the last return
the columns of ``documents``.

1. language ID: texts without a letter or without a confident language go;
2. SimHash near-dedup: the document with the smallest id of each group stays;
3. personal data: spans become ``[KIND]``, ``n_chars`` follows;
4. mixing: each source gives its target number of words; documents are left
   out or repeated by the hash of their id;
5. packing: tokenized pieces in sequences of 2,048 tokens.

Empty tables pass through all stages; NULL texts leave in the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from poststream.llm import langid, mixing, packing, pii, simhash
from poststream.llm.tokens import tokenizer_path
from poststream.session import scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.in_known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("packing", pack),
]

# a trained model and a tokenizer are stages: tests compare with brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
