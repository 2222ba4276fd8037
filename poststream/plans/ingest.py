"""Queries: ingest decisions, routing, record shape and the wire format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..defaults import FIRST_RUN_LIMIT
from ..functions.text import (epoch_to_utc, iso_timestamp, job_text, keyword_hits,
                              title_preview, truncate_body)
from ..operators import ingest as ig
from ..operators import terms as tm
from ..session import scratch_path
from ..sources import ledger as lg
from ..sources import wire
from ..sources.files import read_sources
from . import fixtures as fx
from .registry import query


def _ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids sent by earlier runs: the documents that already carry a label."""
    return fx.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"))


def _iso_sql(c: str) -> str:
    frac = f"epoch_us({c}) % 1000000"
    return (f"(strftime({c}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN {frac} <> 0 THEN '.' || "
            f"lpad(CAST({frac} AS VARCHAR), 6, '0') ELSE '' END || '+00:00')")


def _kw_sql(t: str) -> str:
    return "(" + " OR ".join(f"contains({t}, '{k}')" for k in fx.KEYWORDS) + ")"


_JOB_TEXT = "lower(coalesce(title, '') || ' ' || coalesce(selftext, ''))"
_SOURCES_SQL = ", ".join(f"'{s}'" for s in fx.SOURCES)
_AS_OF_SQL = f"TIMESTAMP '{fx.AS_OF.isoformat(sep=' ')}'"

BASE = f"WITH {fx.POSTS_CTE}"
TIMES = f"WITH {fx.EVENT_TIMES_CTE}"

SHAPED = f""",
shaped AS (SELECT id, title, {_iso_sql('created_utc')} AS created_utc,
                  substr(selftext, 1, 5000) AS selftext, subreddit,
                  CAST(NULL AS VARCHAR) AS url, kind FROM posts)"""

SENT = f""",
picked AS (SELECT * FROM posts WHERE subreddit IN ({_SOURCES_SQL})
           QUALIFY row_number() OVER (PARTITION BY subreddit
                                      ORDER BY created_utc DESC, id) <= {FIRST_RUN_LIMIT}),
fresh AS (SELECT * FROM picked
          WHERE created_utc >= {_AS_OF_SQL} - INTERVAL {fx.DAYS} DAY
            AND NOT EXISTS (SELECT 1 FROM labels l WHERE CAST(l.doc_id AS VARCHAR) = picked.id)),
rel AS (SELECT * FROM fresh WHERE {_kw_sql(_JOB_TEXT)}),
sent AS (SELECT id, title, {_iso_sql('created_utc')} AS created_utc,
                substr(selftext, 1, 5000) AS selftext, subreddit,
                CAST(NULL AS VARCHAR) AS url FROM rel)"""


def _sent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ig.prepare(fx.timed(spark, sf_dir), _ledger(spark, sf_dir), fx.AS_OF, fx.SOURCES,
                      keywords=fx.KEYWORDS, limit=FIRST_RUN_LIMIT, days=fx.DAYS,
                      texts=fx.texts(spark, sf_dir))


# ------------------------------------------------------------------ time ----

@query("epoch_to_utc", TIMES + """ SELECT id, make_timestamp(created_epoch * 1000000) AS created_ts
 FROM times""")
def q_epoch_to_utc(spark, sf_dir):
    return fx.event_times(spark, sf_dir).select(
        "id", epoch_to_utc("created_epoch").alias("created_ts"))


@query("iso_timestamp", TIMES + f""" SELECT id, {_iso_sql('created_utc')} AS created_iso,
 {_iso_sql('make_timestamp(created_epoch * 1000000)')} AS epoch_iso FROM times""")
def q_iso_timestamp(spark, sf_dir):
    return fx.event_times(spark, sf_dir).select(
        "id", iso_timestamp("created_utc").alias("created_iso"),
        iso_timestamp(epoch_to_utc("created_epoch")).alias("epoch_iso"))


@query("recent_posts", TIMES + f""" SELECT id, created_utc FROM times
 WHERE created_utc >= {_AS_OF_SQL} - INTERVAL {fx.DAYS} DAY""")
def q_recent_posts(spark, sf_dir):
    return ig.recent(fx.event_times(spark, sf_dir), fx.AS_OF, fx.DAYS).select("id", "created_utc")


# -------------------------------------------------------------- keywords ----

@query("relevant_posts", BASE + f" SELECT id FROM posts WHERE {_kw_sql(_JOB_TEXT)}")
def q_relevant_posts(spark, sf_dir):
    return ig.relevant(fx.texts(spark, sf_dir), fx.KEYWORDS).select("id")


_KW_LIST = "[" + ", ".join(f"'{k}'" for k in fx.KEYWORDS) + "]"


@query("keyword_hits", BASE + f""" SELECT id,
 list_filter({_KW_LIST}, lambda k: contains({_JOB_TEXT}, k)) AS hits FROM posts""")
def q_keyword_hits(spark, sf_dir):
    return fx.texts(spark, sf_dir).select(
        "id", keyword_hits(job_text("title", "selftext"), fx.KEYWORDS).alias("hits"))


@query("keyword_frequency", BASE + f""" SELECT keyword, count(*) AS posts FROM (
 SELECT unnest(list_filter({_KW_LIST}, lambda k: contains({_JOB_TEXT}, k))) AS keyword FROM posts)
 GROUP BY keyword""")
def q_keyword_frequency(spark, sf_dir):
    hits = fx.texts(spark, sf_dir).select(
        keyword_hits(job_text("title", "selftext"), fx.KEYWORDS).alias("hits"))
    return tm.occurrences(hits, "hits", name="keyword").withColumnRenamed("occurrences", "posts")


@query("truncate_body", BASE + " SELECT id, substr(selftext, 1, 5000) AS selftext FROM posts")
def q_truncate_body(spark, sf_dir):
    return fx.texts(spark, sf_dir).select("id", truncate_body("selftext").alias("selftext"))


@query("title_preview", BASE + " SELECT id, substr(title, 1, 60) AS preview FROM posts")
def q_title_preview(spark, sf_dir):
    return fx.texts(spark, sf_dir).select("id", title_preview("title").alias("preview"))


@query("shape_record", BASE + SHAPED
       + " SELECT id, title, created_utc, selftext, subreddit, url FROM shaped")
def q_shape_record(spark, sf_dir):
    return ig.shape_record(fx.posts(spark, sf_dir))


# ---------------------------------------------------- sources and routing ----

@query("route_by_tag", BASE + """ SELECT id, subreddit || '.' || kind AS tag FROM posts
 WHERE subreddit || '.' || kind = 'src1' OR starts_with(subreddit || '.' || kind, 'src1.')""")
def q_route_by_tag(spark, sf_dir):
    tagged = fx.posts(spark, sf_dir).select(
        "id", F.concat_ws(".", "subreddit", "kind").alias("tag"))
    return ig.route(tagged, fx.ROUTE_PATTERN)


@query("configured_sources", BASE + f""" SELECT id, subreddit FROM posts
 WHERE subreddit IN ({_SOURCES_SQL})""")
def q_configured_sources(spark, sf_dir):
    return ig.select_sources(fx.texts(spark, sf_dir), fx.SOURCES).select("id", "subreddit")


@query("union_sources", BASE + f""" SELECT id, subreddit,
 CASE WHEN subreddit <> 'src1' THEN created_utc END AS created_utc,
 CASE WHEN subreddit = 'src2' THEN kind END AS kind FROM posts
 WHERE subreddit IN ({_SOURCES_SQL}) AND subreddit <> 'src4'""")
def q_union_sources(spark, sf_dir):
    """A folder per source: one without times, one with a column more, one whose id
    is a number, and one (src4) that can't be read and is skipped."""
    root, p = scratch_path(spark, "sources"), fx.with_time(
        fx.doc_posts(spark, sf_dir).select("doc_id", "id", "subreddit"), spark, sf_dir).select(
        "id", "subreddit", "created_utc", "kind")
    p = ig.select_sources(p, fx.SOURCES)
    own = {"src1": ["id"], "src2": ["id", "created_utc", "kind"],
           "src3": [F.col("id").cast("long").alias("id"), "created_utc"]}
    rest = [n for n in fx.SOURCES if n not in own]
    ig.select_sources(p, rest).select("id", "created_utc", "subreddit").write.partitionBy("subreddit").parquet(root)
    for name, columns in own.items():
        ig.select_sources(p, [name]).select(*columns).write.parquet(f"{root}/subreddit={name}")
    spark.range(1).select(F.lit("not a Parquet file").alias("value")).write.mode("overwrite").text(
        f"{root}/subreddit=src4")
    frames, broken = read_sources(spark, root, fx.SOURCES)
    if set(broken) != {"src4"}:
        raise RuntimeError(f"expected src4 to be reported, got {broken}")
    return ig.union_sources(frames).select("id", "subreddit", "created_utc", "kind")


@query("newest_per_source", BASE + f""" SELECT id, subreddit, created_utc,
 CAST(row_number() OVER (PARTITION BY subreddit ORDER BY created_utc DESC, id) AS INTEGER) AS rank
 FROM posts QUALIFY rank <= {fx.NEWEST_LIMIT}""")
def q_newest_per_source(spark, sf_dir):
    from ..operators.topn import top_n_per_group
    return top_n_per_group(fx.posts(spark, sf_dir), ["subreddit"],
                           [F.col("created_utc").desc(), F.col("id").asc()], fx.NEWEST_LIMIT,
                           salt_on=["id"], rank_col="rank").select(
        "id", "subreddit", "created_utc", "rank")


@query("unseen_posts", BASE + """ SELECT id FROM posts p
 WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE CAST(l.doc_id AS VARCHAR) = p.id)""")
def q_unseen_posts(spark, sf_dir):
    return ig.unseen(fx.posts(spark, sf_dir), _ledger(spark, sf_dir)).select("id")


@query("unseen_posts_bucketed", BASE + """ SELECT id FROM posts p
 WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE CAST(l.doc_id AS VARCHAR) = p.id)""")
def q_unseen_posts_bucketed(spark, sf_dir):
    """The same with a ledger by buckets, grown in four runs: two folded one after
    the other, one folded with the next, one not folded yet."""
    path, sent = scratch_path(spark, "ledger"), _ledger(spark, sf_dir)
    for run in range(4):
        lg.append_run(sent.where(F.pmod(F.xxhash64("id", F.lit(run)), F.lit(3)) != 0)
                      if run % 2 else sent.where(F.pmod(F.xxhash64("id"), F.lit(2)) == run // 2), path)
        if run in (0, 2):
            lg.fold_ledger(spark, path)
    return ig.unseen(fx.doc_posts(spark, sf_dir).join(
        fx.event_times(spark, sf_dir), "id").select("id"), path).select("id")


@query("distinct_ids", BASE + " SELECT DISTINCT id, title, created_utc FROM posts")
def q_distinct_ids(spark, sf_dir):
    p = fx.posts(spark, sf_dir).select("id", "title", "created_utc")
    resent = p.join(_ledger(spark, sf_dir), "id", "left_semi")  # at-least-once repeats
    return p.unionByName(resent).dropDuplicates(["id"])


# ------------------------------------------------------------ ingest run ----

@query("ingest_batch", BASE + SENT + " SELECT * FROM sent")
def q_ingest_batch(spark, sf_dir):
    return _sent(spark, sf_dir)


@query("sent_per_source", BASE + SENT + " SELECT subreddit, count(*) AS sent FROM sent GROUP BY 1")
def q_sent_per_source(spark, sf_dir):
    return ig.sent_counts(_sent(spark, sf_dir))


@query("seen_ledger_append", BASE + SENT + """ SELECT DISTINCT id FROM (
 SELECT CAST(doc_id AS VARCHAR) AS id FROM labels UNION ALL SELECT id FROM sent)""")
def q_seen_ledger_append(spark, sf_dir):
    return lg.grow_ledger(_ledger(spark, sf_dir), _sent(spark, sf_dir))


def _polled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts as polled: those with a label come a second time, five days older
    and with another title; every third also lies in the next source."""
    p = fx.posts(spark, sf_dir).select("id", "title", "selftext", "subreddit", "created_utc")
    old = p.join(_ledger(spark, sf_dir), "id", "left_semi").withColumns({
        "title": F.concat("title", F.lit(" old")),
        "created_utc": F.col("created_utc") - F.expr("INTERVAL 5 DAYS")})
    number = F.regexp_extract("subreddit", "([0-9]+)$", 1).cast("int")
    other = p.where(F.col("id").cast("long") % 3 == 0).withColumn(
        "subreddit", F.concat(F.lit("src"), ((number + 1) % 20).cast("string")))
    return p.unionByName(old).unionByName(other).unionByName(other)


_POLLED_SQL = f""",
p AS (SELECT id, title, selftext, subreddit, created_utc FROM posts),
polled AS (
  SELECT * FROM p UNION ALL
  SELECT id, title || ' old', selftext, subreddit, created_utc - INTERVAL 5 DAY FROM p
  WHERE EXISTS (SELECT 1 FROM labels l WHERE CAST(l.doc_id AS VARCHAR) = p.id) UNION ALL
  SELECT id, title, selftext, 'src' || ((CAST(substr(subreddit, 4) AS INTEGER) + 1) % 20), created_utc
  FROM p, (VALUES (1), (2)) AS twice(n) WHERE CAST(id AS BIGINT) % 3 = 0),
sent_once AS (
  SELECT * FROM polled
  WHERE subreddit IN ({_SOURCES_SQL}) AND created_utc >= {_AS_OF_SQL} - INTERVAL {fx.DAYS} DAY
    AND CAST(id AS BIGINT) % 7 <> 0 AND {_kw_sql(_JOB_TEXT)}
  QUALIFY row_number() OVER (
    PARTITION BY id ORDER BY list_position([{_SOURCES_SQL}], subreddit), created_utc DESC, title) = 1)"""


@query("ingest_batch_repeats", BASE + _POLLED_SQL + f""" SELECT id, title,
 {_iso_sql('created_utc')} AS created_utc, subreddit FROM sent_once""")
def q_ingest_batch_repeats(spark, sf_dir):
    """A run over polled posts that repeat in a source, across sources and as
    old versions of fresh ids: each id is sent once, from the first source."""
    posts = _polled(spark, sf_dir)
    seen = posts.where(F.col("id").cast("long") % 7 == 0).select("id")
    return ig.prepare(posts, seen, fx.AS_OF, fx.SOURCES, keywords=fx.KEYWORDS, days=fx.DAYS).select(
        "id", "title", "created_utc", "subreddit")


# ------------------------------------------------------------------ wire ----

def bad_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire messages for every post; those of kind 'error' arrive cut in half
    (not JSON), those of kind 'view' without their id field."""
    shaped = ig.shape_record(fx.posts(spark, sf_dir), keep=("kind",), body_chars=None)
    full = F.to_json(F.struct(*[F.col(c) for c in wire.RECORD_FIELDS]))
    no_id = F.to_json(F.struct(*[F.col(c) for c in wire.RECORD_FIELDS if c != "id"]))
    value = (F.when(F.col("kind") == "error",
                    F.substr(full, F.lit(1), (F.length(full) / 2).cast("int")))
             .when(F.col("kind") == "view", no_id)
             .otherwise(full))
    return shaped.select(F.col("id").alias("key"), value.cast("binary").alias("value"))


@query("json_roundtrip", BASE + f""" SELECT id, title, {_iso_sql('created_utc')} AS created_utc,
 selftext FROM posts""")
def q_json_roundtrip(spark, sf_dir):
    """Whole bodies through the wire format and back."""
    msgs = wire.encode_json(ig.shape_record(fx.posts(spark, sf_dir), body_chars=None), binary=True)
    good, _ = wire.decode_json(msgs, wire.STREAM_SCHEMA)
    return good


@query("quarantine_bad_json", BASE + """ SELECT id AS key,
 CASE WHEN kind IN ('error', 'view') THEN 'quarantine' ELSE 'good' END AS status,
 CASE kind WHEN 'error' THEN 'malformed json' WHEN 'view' THEN 'missing id' END AS reason
 FROM posts""")
def q_quarantine_bad_json(spark, sf_dir):
    msgs = bad_messages(spark, sf_dir)
    good, bad = wire.decode_json(msgs, wire.RECORD_SCHEMA)
    return (good.select(F.col("id").alias("key"), F.lit("good").alias("status"),
                        F.lit(None).cast("string").alias("reason"))
            .unionByName(bad.select("key", F.lit("quarantine").alias("status"), "reason")))
