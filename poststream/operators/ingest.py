"""Ingest: which posts get sent.

The original loop handles one post at a time; here the same decisions are one
DataFrame plan: configured sources -> newest n per source -> age -> not seen
before -> keyword relevance -> record shape.  Filters on source and time sit
directly above the scan so Parquet pushes them down.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..defaults import (BODY_CHARS, DAYS_BACK, FIRST_RUN_LIMIT, JOB_KEYWORDS, TAG_PREFIX,
                        TAG_SUFFIX)
from ..functions.text import is_relevant, iso_timestamp, job_text, truncate_body
from ..session import stored
from ..sources import ledger as lg
from ..sources.wire import RECORD_FIELDS
from .topn import top_n_per_group

RECORD_COLUMNS = list(RECORD_FIELDS)


def select_sources(df: DataFrame, names: Sequence[str], col: str = "subreddit") -> DataFrame:
    """Only posts of the configured sources."""
    return df.where(F.col(col).isin(list(names)))


def union_sources(dfs: Sequence[DataFrame]) -> DataFrame:
    """All sources as one DataFrame (by column name; missing columns NULL)."""
    if not dfs:
        raise ValueError("no sources")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def newest_per_source(df: DataFrame, n: int, source: str = "subreddit",
                      ts: str = "created_utc", key: str = "id") -> DataFrame:
    """The ``n`` newest posts of every source (ties: id ascending)."""
    return top_n_per_group(df, [source], [F.col(ts).desc(), F.col(key).asc()], n,
                           salt_on=[key])


def _as_ts(value: datetime | str | Column) -> Column:
    if isinstance(value, Column):
        return value
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp")


def recent(df: DataFrame, as_of: datetime | str | Column, days: int = DAYS_BACK,
           ts: str = "created_utc") -> DataFrame:
    """Keep posts created at or after ``as_of - days``; the boundary stays."""
    limit = _as_ts(as_of) - F.make_dt_interval(F.lit(days))
    return df.where(F.col(ts) >= limit)


def unseen(df: DataFrame, ledger: DataFrame | str, key: str = "id",
           ledger_key: str | None = None) -> DataFrame:
    """Drop posts whose id is in the ledger: a table, or the path of a ledger by
    buckets, whose filters then spare most of its reading (``sources.ledger``).

    A plain anti join on the ledger's rows: repeats in the ledger change
    nothing, and with no aggregate between the shuffle and the join AQE can
    split a hot id on the post side.  Spark sizes the join itself.
    """
    if isinstance(ledger, str):
        return lg.unseen(df, ledger, key)
    ids = ledger.select(F.col(ledger_key or key).cast("string").alias(key))
    return df.join(ids, key, "left_anti")


def relevant(df: DataFrame, keywords: Sequence[str] = JOB_KEYWORDS, title: str = "title",
             body: str = "selftext") -> DataFrame:
    """Posts whose lower-cased title + body contains a keyword."""
    return df.where(is_relevant(job_text(title, body), keywords))


# --------------------------------------------------------------- routing ----

def _escape_tag(ch: str) -> str:
    return ch if ch.isalnum() or ch == "_" else "\\" + ch


def _tag_body(p: str) -> str:
    out: list[str] = []
    i = 0
    while i < len(p):
        if p.startswith(".**", i) and i + 3 == len(p):
            out.append(r"(?:\..*)?")
            i += 3
        elif p.startswith(".**.", i):
            out.append(r"\.(?:.*\.)?")
            i += 4
        elif p.startswith("**.", i) and i == 0:
            out.append(r"(?:.*\.)?")
            i += 3
        elif p.startswith("**", i):
            out.append(".*")
            i += 2
        elif p[i] == "*":
            out.append(r"[^.]*")
            i += 1
        elif p[i] == "{":
            depth, j = 1, i + 1
            while j < len(p) and depth:
                depth += {"{": 1, "}": -1}.get(p[j], 0)
                j += 1
            inner, parts, level, start = p[i + 1:j - 1], [], 0, 0
            for k, ch in enumerate(inner):
                level += {"{": 1, "}": -1}.get(ch, 0)
                if ch == "," and level == 0:
                    parts.append(inner[start:k])
                    start = k + 1
            parts.append(inner[start:])
            out.append("(?:" + "|".join(_tag_body(x) for x in parts) + ")")
            i = j
        else:
            out.append(_escape_tag(p[i]))
            i += 1
    return "".join(out)


def tag_regex(pattern: str) -> str:
    """Regex for a tag match pattern: ``*`` is one tag part, ``**`` zero or
    more parts (``a.**`` also matches ``a``), ``{x,y}`` either; patterns
    separated by blanks are alternatives."""
    return "^(?:" + "|".join(_tag_body(p) for p in pattern.split()) + ")$"


def with_tag(df: DataFrame, tag: str = f"{TAG_PREFIX}.{TAG_SUFFIX}", col: str = "tag"
             ) -> DataFrame:
    """Label records with the transport tag they are emitted under."""
    return df.withColumn(col, F.lit(tag))


def route(df: DataFrame, pattern: str = f"{TAG_PREFIX}.**", tag: str = "tag") -> DataFrame:
    """Records whose tag matches the match pattern."""
    return df.where(F.col(tag).rlike(tag_regex(pattern)))


# ---------------------------------------------------------------- shaping ----

def shape_record(df: DataFrame, source: str = "subreddit", keep: Sequence[str] = (),
                 body_chars: int | None = BODY_CHARS) -> DataFrame:
    """The six wire fields, all text: id, title, created_utc (ISO-8601 UTC),
    selftext (first ``body_chars`` characters; None keeps the whole body),
    subreddit, url (plus ``keep``)."""
    url = F.col("url").cast("string") if "url" in df.columns else F.lit(None).cast("string")
    body = F.col("selftext") if body_chars is None else truncate_body("selftext", body_chars)
    return df.select(
        F.col("id").cast("string").alias("id"),
        F.col("title").cast("string").alias("title"),
        iso_timestamp("created_utc").alias("created_utc"),
        body.cast("string").alias("selftext"),
        F.col(source).cast("string").alias("subreddit"),
        url.alias("url"),
        *[F.col(c) for c in keep],
    )


def sent_counts(df: DataFrame, source: str = "subreddit") -> DataFrame:
    """Posts sent per source in one run."""
    return df.groupBy(source).agg(F.count(F.lit(1)).alias("sent"))


def candidates(df: DataFrame, ledger: DataFrame | str, as_of: datetime | str | Column,
               sources: Sequence[str], limit: int = FIRST_RUN_LIMIT, days: int = DAYS_BACK,
               key: str = "id", source: str = "subreddit", ts: str = "created_utc") -> DataFrame:
    """(id, source, created) of the posts that pass newest-n, age and ledger.

    Decided on these narrow columns alone, so the per-source shuffles never
    carry texts; at most ``limit`` posts per source remain.  An id can still
    appear more than once (other sources, other versions).
    """
    narrow = select_sources(df, sources, source).select(key, source, ts)
    picked = recent(newest_per_source(narrow, limit, source, ts, key), as_of, days, ts)
    if isinstance(ledger, str):
        picked = stored(picked, "picked")     # asked twice: the filters, then the anti join
    return unseen(picked, ledger, key).dropDuplicates([key, source, ts])


def prepare(df: DataFrame, ledger: DataFrame | str, as_of: datetime | str | Column,
            sources: Sequence[str], keywords: Sequence[str] = JOB_KEYWORDS,
            limit: int = FIRST_RUN_LIMIT, days: int = DAYS_BACK, key: str = "id",
            source: str = "subreddit", ts: str = "created_utc",
            texts: DataFrame | None = None) -> DataFrame:
    """One ingest run, in the original order of decisions; an id is sent once.

    The surviving (id, source, created) rows are written once and joined back
    on all three, so a version that failed the age test cannot return with one
    that passed.  Of an id that is relevant in several rows the first is sent:
    sources in the given order, newest first, then by title and body.

    ``texts`` (id, source, title, selftext, ...) may give the texts apart from
    the times in ``df``; the bounded survivors then meet the text scan directly
    and no text is shuffled to find its time.
    """
    fresh = stored(candidates(df, ledger, as_of, sources, limit, days, key, source, ts))
    if texts is None:
        rows = select_sources(df, sources, source).join(fresh, [key, source, ts])
    else:
        rows = select_sources(texts, sources, source).join(fresh, [key, source])
    order = F.array_position(F.array(*[F.lit(s) for s in sources]), F.col(source))
    # at most ``limit`` rows per source take part
    once = Window.partitionBy(key).orderBy(order, F.col(ts).desc(), "title", "selftext")
    first = (relevant(rows, keywords).withColumn("_nth", F.row_number().over(once))
             .where("_nth = 1").drop("_nth"))
    return shape_record(first, source)
