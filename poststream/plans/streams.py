"""Queries: Structured Streaming runs over message folders derived from the
tables.  Each query writes the messages (several files, one per micro-batch),
runs the stream to completion with ``availableNow`` into a folder below
``spark.checkpoint.dir`` and returns a batch read of that output, so stream
results compare with batch SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ingest as ig
from .. import jobs
from ..session import count_files, scratch_path, stored
from ..sources import wire
from ..sources.ledger import append_ledger
from ..streaming import metrics as mx
from ..streaming import stream as st
from . import fixtures as fx
from .classify import _fit
from ..operators.enrich import with_skills
from ..operators.model import load_model, save_model
from .dashboard import MATCHER, PRELUDE
from .ingest import bad_messages
from .ingest import BASE, SENT, _iso_sql, _sent
from .registry import query

BATCHES = 4        # micro-batches per run (files per trigger follow from the file count)


def _messages(spark: SparkSession, sf_dir: str, posts: DataFrame | None = None) -> DataFrame:
    """Whole posts as wire messages (bodies are not cut here, so every
    stream job works on whole texts)."""
    p = posts if posts is not None else fx.posts(spark, sf_dir)
    return wire.encode_json(ig.shape_record(p, body_chars=None), binary=True)


def _marked_topic(spark: SparkSession, sf_dir: str) -> str:
    """A topic of all posts, each message with ``labelled`` beside it (readers of
    messages don't see that): the labelled ones can be told and taken again from the
    topic, without joining and shuffling all texts a second time."""
    p = ig.shape_record(fx.posts(spark, sf_dir, labels=True), body_chars=None, keep=["labelled"])
    return _topic(spark, wire.encode_json(p, binary=True, beside=["labelled"]))


def _labelled_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The messages of a marked topic whose post has a label."""
    return spark.read.parquet(folder).where("labelled").select("key", "value")


def _topic(spark: SparkSession, messages: DataFrame, folder: str | None = None) -> str:
    """Append messages to a folder of files, one file per input partition
    (no shuffle: the write scales with the scan)."""
    folder = folder or scratch_path(spark, "topic")
    messages.write.mode("append").parquet(folder)
    return folder


def _files_per_trigger(spark: SparkSession, folder: str) -> int:
    """Files per micro-batch so that a run takes about ``BATCHES`` batches
    (a metadata listing, no data read)."""
    return max(1, -(-count_files(spark, folder) // BATCHES))


def _run(writer) -> None:
    q = writer.start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def _to_folder(df: DataFrame, name: str) -> tuple[str, object]:
    spark = df.sparkSession
    out, ckpt = scratch_path(spark, name), scratch_path(spark, name + "-ckpt")
    writer = (df.writeStream.format("parquet").option("path", out)
              .option("checkpointLocation", ckpt).outputMode("append")
              .trigger(availableNow=True))
    return out, writer


def _posts_stream(spark: SparkSession, folder: str) -> DataFrame:
    raw = st.read_posts_stream(spark, "parquet", path=folder,
                               max_files_per_trigger=_files_per_trigger(spark, folder))
    good, _ = st.parse_posts(raw)
    return good


@query("stream_posts_scan", BASE + f""" SELECT id, title, {_iso_sql('created_utc')} AS created_utc,
 selftext FROM posts""")
def q_stream_posts_scan(spark, sf_dir):
    folder = _topic(spark, _messages(spark, sf_dir))
    posts = _posts_stream(spark, folder).select("id", "title", "created_utc", "selftext")
    out, writer = _to_folder(posts, "scan")
    _run(writer)
    return spark.read.parquet(out)


@query("stream_enriched")
def q_stream_enriched(spark, sf_dir):
    _, model = _fit(spark, sf_dir)
    model_path = scratch_path(spark, "model")
    save_model(model, model_path)
    loaded = load_model(model_path)
    folder = _topic(spark, _messages(spark, sf_dir))
    docs = st.enrich_stream(_posts_stream(spark, folder), MATCHER, loaded)
    out, writer = _to_folder(docs, "enriched")
    _run(writer)
    return spark.read.parquet(out)


@query("stream_model_parity", BASE + " SELECT count(*) AS posts, CAST(0 AS BIGINT) AS differences"
       " FROM posts")
def q_stream_model_parity(spark, sf_dir):
    """Posts that the stream and a batch run over the same posts enriched, and
    how many of them differ in category or skills."""
    _, model = _fit(spark, sf_dir)
    batch = st.enrich_stream(fx.texts(spark, sf_dir).withColumn(
        "created_utc", F.lit(None).cast("string")), MATCHER, model).select(
        "id", F.struct("category", "skills_array").alias("batch"))
    stream = q_stream_enriched(spark, sf_dir).select(
        "id", F.struct("category", "skills_array").alias("stream"))
    return stream.join(batch, "id", "full").agg(
        F.count("stream").alias("posts"),
        F.count_if(~F.col("stream").eqNullSafe(F.col("batch"))).alias("differences"))


@query("stream_skills", PRELUDE + " SELECT id, skills_array, array_to_string(skills_array, ', ') "
       "AS skills FROM sk")
def q_stream_skills(spark, sf_dir):
    """The stream enrichment's text path (whole texts -> skills) without the
    model, so it compares with SQL; the full path is ``stream_enriched``."""
    folder = _topic(spark, _messages(spark, sf_dir))
    posts = with_skills(_posts_stream(spark, folder), MATCHER)
    out, writer = _to_folder(posts.select("id", "skills_array", "skills"), "skills")
    _run(writer)
    return spark.read.parquet(out)


@query("stream_quarantine", BASE + """ SELECT id AS key,
 CASE WHEN kind IN ('error', 'view') THEN 'quarantine' ELSE 'good' END AS status,
 CASE kind WHEN 'error' THEN 'malformed json' WHEN 'view' THEN 'missing id' END AS reason
 FROM posts""")
def q_stream_quarantine(spark, sf_dir):
    """Bad messages in a stream: each micro-batch parsed once, good rows and
    quarantined ones (with their reason) written side by side."""
    folder = _topic(spark, bad_messages(spark, sf_dir))
    raw = st.read_posts_stream(spark, "parquet", path=folder,
                               max_files_per_trigger=_files_per_trigger(spark, folder))
    good, bad = scratch_path(spark, "q-good"), scratch_path(spark, "q-bad")
    _run(raw.writeStream.foreachBatch(st.quarantine_writer(good, bad))
         .option("checkpointLocation", scratch_path(spark, "q-ckpt"))
         .trigger(availableNow=True))
    return (st.read_log(spark, good).select(F.col("id").alias("key"),
                                            F.lit("good").alias("status"),
                                            F.lit(None).cast("string").alias("reason"))
            .unionByName(st.read_log(spark, bad).select(
                "key", F.lit("quarantine").alias("status"), "reason")))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.posts(spark, sf_dir, labels=True).where("labelled").drop("labelled")


@query("stream_dedup", BASE + f""" SELECT id, title, {_iso_sql('created_utc')} AS created_utc
 FROM posts""")
def q_stream_dedup(spark, sf_dir):
    folder = _marked_topic(spark, sf_dir)
    _topic(spark, _labelled_messages(spark, folder), folder)  # re-sends
    unique = st.dedup_stream(_posts_stream(spark, folder), "id")
    out, writer = _to_folder(unique.select("id", "title", "created_utc"), "dedup")
    _run(writer)
    return spark.read.parquet(out)


@query("stream_dedup_batches", BASE + f""" SELECT id, title, {_iso_sql('created_utc')} AS created_utc
 FROM posts""")
def q_stream_dedup_batches(spark, sf_dir):
    """R3 without per-key state: each micro-batch is deduplicated by a batch
    aggregation and anti-joined with the ids of earlier batches."""
    folder = _marked_topic(spark, sf_dir)
    _topic(spark, _labelled_messages(spark, folder), folder)  # re-sends
    out, seen = scratch_path(spark, "dedup-out"), scratch_path(spark, "dedup-seen")
    writer = st.dedup_writer(out, seen, "id", keep=["id", "title", "created_utc"], order=["event_time"])
    _run(_posts_stream(spark, folder).writeStream.foreachBatch(writer)
         .option("checkpointLocation", scratch_path(spark, "dedup-ckpt"))
         .trigger(availableNow=True))
    return st.read_log(spark, out).drop("batch_id")


@query("stream_dedup_late", BASE + f""" SELECT id, title, {_iso_sql('created_utc')} AS created_utc
 FROM posts WHERE CAST(id AS BIGINT) % 7 <> 0""")
def q_stream_dedup_late(spark, sf_dir):
    """Newest posts first, then older ones that were never seen, in a later
    run on the same checkpoint; ids of the ledger stay out."""
    p = fx.posts(spark, sf_dir)
    newer = F.col("created_utc") >= F.lit(fx.AS_OF)
    ledger = scratch_path(spark, "late-ledger")
    append_ledger(p.where(F.col("id").cast("long") % 7 == 0), ledger)
    out, seen = scratch_path(spark, "late-out"), scratch_path(spark, "late-seen")
    ckpt = scratch_path(spark, "late-ckpt")
    writer = st.dedup_writer(out, seen, "id", keep=["id", "title", "created_utc"], ledger_path=ledger,
                             order=["event_time"])
    folder = None
    for part in (p.where(newer), p.where(~newer).unionByName(p.where(newer))):
        folder = _topic(spark, _messages(spark, sf_dir, part), folder)
        _run(_posts_stream(spark, folder).writeStream.foreachBatch(writer)
             .option("checkpointLocation", ckpt).trigger(availableNow=True))
    return st.read_log(spark, out).drop("batch_id")


@query("stream_dedup_bounded", BASE + f""" SELECT id, title, {_iso_sql('created_utc')} AS created_utc
 FROM posts WHERE CAST(id AS BIGINT) % 7 <> 0""")
def q_stream_dedup_bounded(spark, sf_dir):
    """``stream_dedup_late`` with a state that ends six hours behind the newest
    post: the older posts of the second run go around it to the ledger."""
    p = fx.posts(spark, sf_dir)
    newer = F.col("created_utc") >= F.lit(fx.AS_OF)
    ledger = scratch_path(spark, "bounded-ledger")
    append_ledger(p.where(F.col("id").cast("long") % 7 == 0), ledger)
    out, seen, ckpt = (scratch_path(spark, f"bounded-{n}") for n in ("out", "seen", "ckpt"))
    folder = None
    for part in (p.where(newer), p.where(~newer).unionByName(p.where(newer))):
        folder = _topic(spark, _messages(spark, sf_dir, part), folder)
        _run(st.bounded_dedup(_posts_stream(spark, folder), out, seen, ckpt, "6 hours",
                              keep=["id", "title", "created_utc"], ledger_path=ledger,
                              order=["event_time"], fold_every=3).trigger(availableNow=True))
    return st.read_log(spark, out).drop("batch_id")


@query("stream_trend", BASE + """ SELECT date_trunc('hour', created_utc) AS bucket, subreddit,
 count(*) AS posts FROM posts GROUP BY ALL""")
def q_stream_trend(spark, sf_dir):
    folder = _topic(spark, _messages(spark, sf_dir))
    counts = st.trend_counts(_posts_stream(spark, folder), "event_time", fx.TREND_EVERY,
                             by="subreddit")
    log, ckpt = scratch_path(spark, "trend-log"), scratch_path(spark, "trend-ckpt")
    _run(st.upsert_by_key(counts, log, ckpt, output_mode="update"))
    return st.read_keyed(spark, log, ["bucket", "subreddit"], order=("batch_id",))


@query("stream_sent_metrics", BASE + """ SELECT subreddit AS source, count(*) AS sent
 FROM posts GROUP BY 1""")
def q_stream_sent_metrics(spark, sf_dir):
    """Posts per source as the listener saw them go by, batch after batch."""
    folder = _topic(spark, _messages(spark, sf_dir))
    sources = [f"src{i}" for i in range(20)]
    path, out = scratch_path(spark, "metrics"), scratch_path(spark, "sent")
    listener = mx.SentMetrics(spark, path, sources)
    spark.streams.addListener(listener)
    try:
        q = (mx.observe_sources(_posts_stream(spark, folder), sources).select("id").writeStream
             .format("parquet").option("path", out)
             .option("checkpointLocation", scratch_path(spark, "sent-ckpt")).trigger(availableNow=True)
             .start())
        q.awaitTermination()
        if not listener.wait(q) or listener.errors:
            raise RuntimeError(f"metrics not written: {listener.errors}")
    finally:
        spark.streams.removeListener(listener)
    return mx.read_metrics(spark, path).groupBy("source").agg(F.sum("sent").alias("sent"))


@query("stream_publish", BASE + SENT + " SELECT id AS key, id, title, created_utc, selftext, subreddit FROM sent")
def q_stream_publish(spark, sf_dir):
    """The messages of ingest runs on their way to a topic (a folder here): half of
    them, a stop, the other half on the same checkpoint, and a run with nothing new."""
    messages, out, ckpt = (scratch_path(spark, f"publish-{n}") for n in ("log", "topic", "ckpt"))
    sent = stored(wire.encode_json(ig.route(ig.with_tag(_sent(spark, sf_dir))).drop("tag")), "sent")
    even = F.col("key").cast("long") % 2 == 0
    for half in (sent.where(even), sent.where(~even), None):
        if half is not None:
            half.write.mode("append").parquet(messages)
        jobs.publish(spark, messages, "parquet", {}, out, ckpt,
                     trigger={"availableNow": True}).awaitTermination()
    topic = spark.read.schema(st.TEXT_MESSAGES).parquet(out)
    parsed = F.from_json("value", wire.RECORD_SCHEMA).alias("m")
    return topic.select("key", parsed).select("key", "m.id", "m.title", "m.created_utc", "m.selftext",
                                              "m.subreddit")


@query("stream_restart", BASE + f""" SELECT id, title, {_iso_sql('created_utc')} AS created_utc
 FROM posts""")
def q_stream_restart(spark, sf_dir):
    """A batch function that fails half-way, its rows already written: the query
    starts again from its checkpoint, and the batch replaces what it had left."""
    folder = _topic(spark, _messages(spark, sf_dir))
    log, ckpt, failed = scratch_path(spark, "restart-log"), scratch_path(spark, "restart-ckpt"), []
    whole = st.batch_writer(log)

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            whole(batch.where(F.xxhash64("id") % 2 == 0), batch_id)
            raise RuntimeError("stopped half-way")
        whole(batch, batch_id)
    posts = _posts_stream(spark, folder).select("id", "title", "created_utc")
    st.run_until_stopped(lambda: posts.writeStream.foreachBatch(write).option("checkpointLocation", ckpt)
                         .trigger(availableNow=True).start(), retries=1, sleep=lambda s: None)
    return st.read_log(spark, log).drop("batch_id")


def _versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """First versions of all posts; edited second versions (title + ' v2',
    one minute later) of the labelled ones."""
    p = fx.posts(spark, sf_dir)
    edited = _labelled(spark, sf_dir).select(
        "id", F.concat(F.col("title"), F.lit(" v2")).alias("title"), "selftext", "subreddit",
        (F.col("created_utc") + F.expr("INTERVAL 1 MINUTE")).alias("created_utc"))
    return p, edited


def _edited_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The second versions of ``_versions``, made of the marked topic's messages."""
    first, _ = wire.decode_json(_labelled_messages(spark, folder))
    edited = first.select(
        "id", F.concat(F.col("title"), F.lit(" v2")).alias("title"), "selftext", "subreddit",
        (F.col("created_utc").cast("timestamp") + F.expr("INTERVAL 1 MINUTE")).alias("created_utc"))
    return wire.encode_json(ig.shape_record(edited, body_chars=None), binary=True)


UPSERT_SQL = BASE + f""",
lab AS (SELECT CAST(doc_id AS VARCHAR) AS id FROM labels),
cur AS (SELECT p.id,
               CASE WHEN lab.id IS NULL THEN p.title ELSE p.title || ' v2' END AS title,
               CASE WHEN lab.id IS NULL THEN p.created_utc
                    ELSE p.created_utc + INTERVAL 1 MINUTE END AS ts
        FROM posts p LEFT JOIN (SELECT DISTINCT id FROM lab) lab ON p.id = lab.id)
SELECT id, title, {_iso_sql('ts')} AS created_utc FROM cur"""

_DOC = ["id", "title", "created_utc", "selftext", "subreddit"]


@query("stream_upsert_latest", UPSERT_SQL)
def q_stream_upsert_latest(spark, sf_dir):
    folder = _marked_topic(spark, sf_dir)
    _topic(spark, _edited_messages(spark, folder), folder)
    log, ckpt = scratch_path(spark, "index-log"), scratch_path(spark, "index-ckpt")
    _run(st.upsert_by_key(_posts_stream(spark, folder).select(*_DOC), log, ckpt))
    return st.read_keyed(spark, log).select("id", "title", "created_utc")


@query("compact_latest", UPSERT_SQL)
def q_compact_latest(spark, sf_dir):
    """Two runs on one checkpoint (the second resumes where the first ended),
    a compaction after each."""
    folder = _marked_topic(spark, sf_dir)
    log, ckpt = scratch_path(spark, "index-log"), scratch_path(spark, "index-ckpt")
    _run(st.upsert_by_key(_posts_stream(spark, folder).select(*_DOC), log, ckpt))
    base1 = scratch_path(spark, "index-base")
    since = st.compact(spark, log, base1)
    _topic(spark, _edited_messages(spark, folder), folder)
    _run(st.upsert_by_key(_posts_stream(spark, folder).select(*_DOC), log, ckpt))
    base2 = scratch_path(spark, "index-base")
    st.compact(spark, log, base2, base=base1, since=since)
    return spark.read.parquet(base2).select("id", "title", "created_utc")


@query("latest_per_id", UPSERT_SQL)
def q_latest_per_id(spark, sf_dir):
    first, second = _versions(spark, sf_dir)
    shaped = ig.shape_record(first, body_chars=None).withColumn("batch_id", F.lit(0)).unionByName(
        ig.shape_record(second, body_chars=None).withColumn("batch_id", F.lit(1)))
    return st.latest_per_id(shaped.drop("url")).select("id", "title", "created_utc")
