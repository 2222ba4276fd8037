"""Wire format: records as JSON messages, and back with a quarantine.

A message row looks like a Kafka row: ``key`` (the post id) and ``value``
(JSON text).  Decoding is PERMISSIVE: a bad message never stops a batch, it
goes to the quarantine side with its raw text and a reason.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"

# fixed values: the message fields the stream job reads in the original application
STREAM_FIELDS = ["id", "title", "created_utc", "selftext"]
# fixed values: all fields a record carries on the wire
RECORD_FIELDS = ["id", "title", "created_utc", "selftext", "subreddit", "url"]


def text_schema(fields: Sequence[str] = RECORD_FIELDS) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


STREAM_SCHEMA = text_schema(STREAM_FIELDS)
RECORD_SCHEMA = text_schema(RECORD_FIELDS)


def encode_json(df: DataFrame, key: str = "id", binary: bool = False,
                beside: Sequence[str] = ()) -> DataFrame:
    """``df[key, value]``: every column of the record as one JSON object, but those
    that stay ``beside`` it."""
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns if c not in beside]))
    if binary:
        value = value.cast("binary")
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"), *beside)


def tag_messages(df: DataFrame, schema: T.StructType = RECORD_SCHEMA, value: str = "value",
                 key: str | None = "key", require: str | None = "id") -> DataFrame:
    """Parse ``value`` (binary or text) once: ``_key``, ``_raw``, parsed
    struct ``_m`` and ``_reason`` (NULL for a good message).

    The parse sits in a one-element ``explode``: a filter on the parsed
    fields cannot be pushed below a generator, whereas below a plain
    projection Catalyst would inline ``from_json`` into the filter and parse
    every message twice.
    """
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    raw = F.col(value).cast("string")
    parse = F.from_json(raw, with_corrupt, {"mode": "PERMISSIVE",
                                            "columnNameOfCorruptRecord": CORRUPT})
    parsed = df.select(
        (F.col(key).cast("string") if key else F.lit(None).cast("string")).alias("_key"),
        raw.alias("_raw"),
        F.explode(F.array(parse)).alias("_m"))
    reason = (F.when(F.col("_raw").isNull(), F.lit("null message"))
              .when(F.col(f"_m.{CORRUPT}").isNotNull(), F.lit("malformed json")))
    if require:
        reason = reason.when(F.col(f"_m.{require}").isNull(), F.lit(f"missing {require}"))
    return parsed.withColumn("_reason", reason)


def split_tagged(tagged: DataFrame, schema: T.StructType = RECORD_SCHEMA
                 ) -> tuple[DataFrame, DataFrame]:
    """(good rows in the schema's columns, quarantine: key, value, reason)."""
    good = tagged.where(F.col("_reason").isNull()).select(
        *[F.col(f"_m.{f.name}").alias(f.name) for f in schema.fields])
    quarantine = tagged.where(F.col("_reason").isNotNull()).select(
        F.col("_key").alias("key"), F.col("_raw").alias("value"), F.col("_reason").alias("reason"))
    return good, quarantine


def decode_json(df: DataFrame, schema: T.StructType = RECORD_SCHEMA, value: str = "value",
                key: str | None = "key", require: str | None = "id"
                ) -> tuple[DataFrame, DataFrame]:
    """Parse ``value`` (binary or text) into the schema's columns.

    Returns ``(good, quarantine)``.  Quarantine holds messages that are NULL,
    not valid JSON, or lack the ``require`` field; columns ``key``, ``value``
    (raw text) and ``reason``.  When both sides are written, persist the
    result of ``tag_messages`` and call ``split_tagged`` so parsing runs once.
    """
    return split_tagged(tag_messages(df, schema, value, key, require), schema)
