"""Mix sources to target weights with hash-threshold histograms.

Each source gets a target number of words.  Whole multiples of the source are
taken as repeats of every document; for the rest, documents are ordered by a
60-bit hash of their id and text and a prefix is taken.  The end of the prefix is found
without sorting: words are summed by source and hash bucket (12 bits), the
bucket in which the budget is used up is found, and only that bucket is split
further (five levels of 12 bits reach single hash values).  A document is then
taken if its hash is at or below its source's threshold.

Prefixes are nested: a larger budget only adds documents.  The hash value that
crosses the budget is taken if that ends nearer to the target.  Rows of equal id and
text have equal hashes and are taken or left together; rows that share an id, or
have none, are told apart by their texts.  NULL is a source of its own
(last); NULL and empty texts have no words.  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poststream.llm.tables import stored

WORD = r"[^\x20\x09-\x0D]+"
DIGIT_BITS = 12
LEVELS = 5
HASH_BITS = DIGIT_BITS * LEVELS
MAX_REPEAT = 3
WEIGHTS = 3


def row_hash() -> Column:
    """60 bits of the MD5 of a row's id and text (15 hex digits), the same in any engine."""
    row = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                   F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(row), 1, HASH_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, hash) of every document."""
    return docs.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        row_hash().alias("hash"))


def targets(docs_sized: DataFrame, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, weight, target): sources by code point, NULL last,
    weigh 1, 2, 3, repeating; targets share the total and stop at ``max_repeat``
    times the source, the excess going to the others by weight.

    The level at which all targets fit is ``(total - capped) / open weight``,
    with the sources that fill up first taken as capped.  One row per source.
    """
    sizes = docs_sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.select(
        "source", "source_size",
        ((F.row_number().over(by_name) - 1) % WEIGHTS + 1).cast("long").alias("weight"))
    # fill order; ties by name
    fill = Window.orderBy((F.col("source_size") * max_repeat / F.col("weight")).asc(),
                          F.col("source").asc_nulls_last())
    before, whole = fill.rowsBetween(Window.unboundedPreceding, -1), \
        fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = weighed.select(
        "*",
        ((F.sum("source_size").over(whole)
          - F.coalesce(F.sum(F.col("source_size") * max_repeat).over(before), F.lit(0)))
         / (F.sum("weight").over(whole)
            - F.coalesce(F.sum("weight").over(before), F.lit(0)))).alias("level"))
    fits = F.col("level") * F.col("weight") <= F.col("source_size") * max_repeat
    level = F.coalesce(F.min(F.when(fits, F.struct(
        (F.col("source_size") * max_repeat / F.col("weight")).alias("ratio"),
        "level"))).over(Window.partitionBy())["level"], F.lit(0.0))
    return filled.withColumn("level", level).select(
        "source", "source_size", "weight",
        F.least(F.col("level") * F.col("weight"),
                (F.col("source_size") * max_repeat).cast("double")).alias("target"))


def thresholds(docs_sized: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, source_size, target, repeats, threshold) for goals with
    ``source, source_size, target``; documents with hash <= threshold are taken
    once more than ``repeats`` times."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))) \
        .otherwise(0).cast("long")
    path = stored(goals.select(
        "source", "source_size", "target", whole.alias("repeats"),
        (F.col("target") - whole * F.col("source_size")).alias("budget"),
        F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("taken")),
        "mix-goals")
    rows = docs_sized.select("source", "size", "hash").where("size > 0")
    for level in range(1, LEVELS + 1):
        shift = HASH_BITS - DIGIT_BITS * level
        here = F.shiftright("hash", shift)
        parts = rows.select(F.col("source").alias("s"), "size", "hash")
        if level > 1:  # only the bucket where the budget ends
            parts = parts.join(path.select("source", "prefix"), F.expr("s <=> source")) \
                .where(F.shiftright("hash", shift + DIGIT_BITS) == F.col("prefix"))
            rows = parts = stored(parts.select("s", "size", "hash"), "mix-bucket") \
                if level == 2 else parts.select("s", "size", "hash")
            rows = rows.withColumnRenamed("s", "source")
        histogram = parts.groupBy("s", here.alias("bucket")).agg(F.sum("size").alias("words"))
        running = Window.partitionBy("s").orderBy("bucket").rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        summed = histogram.withColumn("upto", F.sum("words").over(running))
        crossing = (summed.join(path.drop("words"), F.expr("s <=> source"))
                    .where(F.col("taken") + F.col("upto") >= F.col("budget"))
                    .groupBy("source", "source_size", "target", "repeats", "budget", "taken")
                    .agg(F.min(F.struct("bucket", "upto", "words")).alias("b")))
        path = stored(crossing.select(
            "source", "source_size", "target", "repeats", "budget",
            F.col("b.bucket").alias("prefix"),
            (F.col("taken") + F.col("b.upto") - F.col("b.words")).alias("taken"),
            F.col("b.words").alias("words")), f"mix-level{level}")
    nearer = 2 * F.col("taken") + F.col("words") < 2 * F.col("budget")
    return path.select("source", "source_size", "target", "repeats",
                       F.when(nearer, F.col("prefix")).otherwise(F.col("prefix") - 1)
                       .alias("threshold"))


def plan(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sized documents, one row per source with its target, whole repeats and
    threshold), both written below the checkpoint folder."""
    narrow = stored(sized(docs), "mix-sizes")
    goals = stored(targets(narrow), "mix-targets")
    limits = thresholds(narrow, goals).select(F.col("source").alias("s"), "repeats", "threshold")
    found = goals.join(limits, F.expr("source <=> s"), "left").select(
        F.col("source").alias("name"), "source_size", "target",
        F.coalesce("repeats", F.lit(0)).alias("repeats"), "threshold")
    return narrow, stored(found, "mix-plan")


def _times() -> Column:
    return F.col("repeats") + F.coalesce((F.col("hash") <= F.col("threshold")).cast("long"), F.lit(0))


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source, source_size, target, taken) of every document."""
    narrow, sources = plan(docs)
    # one row per source: broadcast if the written table is small, else a
    # sort-merge join in which a hot source is split
    return narrow.join(sources, F.expr("source <=> name")).select(
        "doc_id", "size", "source", "source_size", "target",
        (F.col("size") * _times()).alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it is taken."""
    _, sources = plan(docs)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "source",
                       row_hash().alias("hash"))
    return (rows.join(sources, F.expr("source <=> name"))
            .select("row", F.explode(F.array_repeat(F.lit(True), _times().cast("int"))).alias("copy"))
            .select("row.*"))


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS BIGINT) AS hash
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sizes),
filled AS (
  SELECT *, 3 * source_size / CAST(weight AS DOUBLE) AS ratio,
    CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS DOUBLE)
      / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level
  FROM weighed
  WINDOW before AS (ORDER BY 3 * source_size / CAST(weight AS DOUBLE), source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
the_level AS (
  SELECT coalesce(arg_min(level, ratio), 0.0) AS lv FROM filled
  WHERE level * weight <= 3 * source_size),
goals AS (
  SELECT source, source_size, least(lv * weight, CAST(3 * source_size AS DOUBLE)) AS target
  FROM filled, the_level),
whole AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END
    AS repeats FROM goals),
ranked AS (
  SELECT s.doc_id, s.size, s.source, w.source_size, w.target, w.repeats,
         w.target - w.repeats * w.source_size AS budget,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash RANGE UNBOUNDED PRECEDING) AS upto,
         sum(s.size) OVER (PARTITION BY s.source, s.hash) AS same
  FROM sized s JOIN whole w ON s.source IS NOT DISTINCT FROM w.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (repeats + CASE WHEN 2 * upto - same < 2 * budget THEN 1 ELSE 0 END) AS BIGINT)
         AS taken
FROM ranked
"""
