"""The ``posts`` view over the driver's tables and the fixture parameters.

``documents`` carries text, source and a 4-way label, ``events`` the time;
every ``doc_id`` has an equal ``event_id``.  The same view is written once as
a DataFrame and once as a DuckDB CTE so both engines start from equal rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored

# Fixture parameters (chosen for the driver's tables).
LEXICON = ["the", "of the", "of", "and", "license", "apache", "mit", "data", "share",
           "###", "+1", "le", "la", "der", "und", "el", "los", "c++", ".net"]
KEYWORDS = ["license", "data", "share"]
AS_OF = datetime(2024, 1, 3, 0, 0, 0)
DAYS = 1
SOURCES = ["src0", "src1", "src2", "src3", "src4"]
NEWEST_LIMIT = 10
SLICE = (0.25, 0.75)
OPENING_SLICE = (-0.00155, 1.00062)
TREND_EVERY = "1 hour"
OPTION_PREFIX = "e"
ROUTE_PATTERN = "src1.**"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document side of the view: doc_id, id, title, selftext, subreddit,
    category, and the whole document ``text`` (title and body joined by the
    first line break; matching it equals matching ``title + " " + body``).
    Per-document work (skill extraction) is done on this side, before the
    join, so the join's shuffle carries its small results and not the texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    title = F.substring_index(F.col("text"), "\n", 1)
    return docs.select(
        "doc_id",
        F.col("doc_id").cast("string").alias("id"),
        title.alias("title"),
        F.expr("substr(text, length(substring_index(text, '\n', 1)) + 2)").alias("selftext"),
        F.col("source").alias("subreddit"),
        F.col("lang").alias("category"),
        "text",
    )


def with_time(df: DataFrame, spark: SparkSession, sf_dir: str, labels: bool = False) -> DataFrame:
    """Join the event side: created_utc (UTC timestamp), created_epoch, kind.  With
    ``labels`` also ``labelled``, asked of the narrow event side, so that no text is
    shuffled once more for it."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    if labels:
        marks = table(spark, sf_dir, "labels").select(
            F.col("doc_id").cast("string").alias("_id"), F.lit(True).alias("labelled")).distinct()
        events = stored(events.join(marks, F.col("event_id").cast("string") == F.col("_id"), "left")
                        .withColumn("labelled", F.coalesce("labelled", F.lit(False))).drop("_id"), "labelled-events")
    created = F.col("ts").cast("timestamp")
    joined = df.join(events, df.doc_id == events.event_id, "inner")
    return joined.select(
        *[c for c in df.columns if c != "doc_id"],
        created.alias("created_utc"),
        F.floor(F.unix_micros(created) / F.lit(1_000_000)).cast("long").alias("created_epoch"),
        F.col("event_type").alias("kind"),
        *(["labelled"] if labels else []),
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, title, selftext, subreddit, category: posts without their times, for
    work that needs none, so that no text is shuffled to meet its event."""
    return doc_posts(spark, sf_dir).drop("doc_id", "text")


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, created_utc, created_epoch of every event."""
    created = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"), created.alias("created_utc"),
        F.floor(F.unix_micros(created) / F.lit(1_000_000)).cast("long").alias("created_epoch"))


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, subreddit, created_utc and kind of posts: the narrow side."""
    return with_time(doc_posts(spark, sf_dir).select("doc_id", "id", "subreddit"), spark, sf_dir)


def posts(spark: SparkSession, sf_dir: str, labels: bool = False) -> DataFrame:
    """id, title, selftext, subreddit, category, created_utc, created_epoch, kind
    (and ``labelled``)."""
    return with_time(doc_posts(spark, sf_dir).drop("text"), spark, sf_dir, labels)


EVENT_TIMES_CTE = """times AS (
  SELECT CAST(event_id AS VARCHAR) AS id, ts AS created_utc,
         CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS created_epoch FROM events)"""

POSTS_CTE = """posts AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS id,
         string_split(d.text, chr(10))[1] AS title,
         substr(d.text, length(string_split(d.text, chr(10))[1]) + 2) AS selftext,
         d.source AS subreddit,
         d.lang AS category,
         e.ts AS created_utc,
         CAST(floor(epoch_us(e.ts) / 1000000) AS BIGINT) AS created_epoch,
         e.event_type AS kind
  FROM documents d JOIN events e ON d.doc_id = e.event_id)"""


def duck_skill_pattern(terms: list[str]) -> str:
    """The lexicon regex for DuckDB (RE2 has no lookbehind).

    Each term gets its own edges: ``\\b`` next to a word character, ``\\B``
    next to a non-word one; same longest-first order as the Spark pattern.
    """
    uniq = sorted({t for t in terms if t}, key=lambda t: (-len(t), t))
    meta = set("\\.^$|?*+()[]{}")

    def esc(t: str) -> str:
        return "".join("\\" + ch if ch in meta else ch for ch in t)

    def edge(ch: str) -> str:
        return r"\b" if (ch.isascii() and (ch.isalnum() or ch == "_")) else r"\B"

    return "(?:" + "|".join(edge(t[0]) + esc(t) + edge(t[-1]) for t in uniq) + ")"


def duck_clean(expr: str) -> str:
    return (f"trim(regexp_replace(regexp_replace(lower({expr}), '[^a-z0-9+#./\\-\\s]', ' ', 'g'),"
            f" '\\s+', ' ', 'g'))")


def duck_skills(expr: str, terms: list[str] | None = None) -> str:
    pattern = duck_skill_pattern(terms or LEXICON).replace("'", "''")
    return f"regexp_extract_all({duck_clean(expr)}, '{pattern}', 0)"
