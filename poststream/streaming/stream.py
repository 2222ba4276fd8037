"""Structured Streaming jobs.

Sources are Kafka topics (the original transport) or folders of Parquet/JSON
files; the Kafka connector jar is not bundled with PySpark, so its options are
built here and the file sources drive the tests.

The keyed document store is an append-only log of micro-batches: each batch
lands in its own ``batch_id=N`` folder, written with overwrite, so a replayed
batch after a crash rewrites the same folder (idempotent).  Readers take the
latest row per key, chosen on narrow columns (a partial limit per key on the
map side).  ``fold_log`` folds the log into a base by buckets of the key (or
``compact`` into a new flat folder), and ``retire`` removes folded batches once
readers use it.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..defaults import FLUSH_EVERY, TOPIC
from ..operators.enrich import category_override, enriched, with_skills
from ..operators.model import score
from ..session import delete_path, list_folders, path_exists, stored
from ..sources import buckets as bk
from ..sources import ledger as lg
from ..sources.ledger import read_ledger
from ..sources.wire import RECORD_SCHEMA, decode_json, encode_json, split_tagged, tag_messages

MESSAGE_SCHEMA = T.StructType([T.StructField("key", T.StringType()),
                               T.StructField("value", T.BinaryType())])
# as batch runs write them
TEXT_MESSAGES = T.StructType([T.StructField("key", T.StringType()),
                              T.StructField("value", T.StringType())])


# ----------------------------------------------------------------- sources ----

def kafka_source_options(bootstrap: str, topic: str = TOPIC, starting: str = "earliest",
                         max_per_trigger: int | None = None,
                         min_partitions: int | None = None) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``: earliest start (backfill),
    then increments capped per trigger; ``minPartitions`` spreads a topic
    with few partitions over more tasks."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting}
    if max_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    return opts


def read_posts_stream(spark: SparkSession, fmt: str = "kafka",
                      options: dict[str, str] | None = None, path: str | None = None,
                      schema: T.StructType = MESSAGE_SCHEMA,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Unbounded message rows (``key``, ``value``) from Kafka or a folder.

    ``fmt="text"`` reads JSON-lines files (one message per line, no key), as
    a log forwarder writes them; other file formats need the message schema.
    """
    reader = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        return reader.load()
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if fmt == "text":
        return reader.load(path).select(F.lit(None).cast("string").alias("key"), "value")
    return reader.schema(schema).load(path)


def parse_posts(messages: DataFrame, schema: T.StructType = RECORD_SCHEMA
                ) -> tuple[DataFrame, DataFrame]:
    """Messages -> (posts, quarantine); posts gain ``event_time`` parsed from
    the ISO ``created_utc`` text."""
    good, bad = decode_json(messages, schema)
    return good.withColumn("event_time", F.col("created_utc").cast("timestamp")), bad


# ------------------------------------------------------------- transforms ----

def enrich_stream(posts: DataFrame, skills, model) -> DataFrame:
    """Text -> skills -> model -> override -> index document (stateless; the
    same plan serves batch DataFrames).  ``skills``: a matcher, pattern or
    term list."""
    scored = score(with_skills(posts, skills), model) if model is not None else \
        with_skills(posts, skills).withColumn("predicted_category", F.lit(None).cast("string"))
    return enriched(category_override(scored))


def dedup_stream(posts: DataFrame, key: str = "id") -> DataFrame:
    """Each key once, however late its first message comes.

    There is no watermark: a key behind one would be dropped although it was
    never seen.  So the state holds one entry per key (in RocksDB, see
    ``session.DEFAULTS``); ``dedup_writer`` keeps the keys in a table instead,
    also knows the ledger of earlier jobs, and survives a hot key.
    """
    return posts.dropDuplicates([key])


def with_row_hash(df: DataFrame, only: Sequence[str] = ()) -> DataFrame:
    """``df`` with the hash ``_row`` of its whole rows, then cut to ``only`` these
    columns: a choice by the hash needs no wide rows any more."""
    hashed = df.withColumn("_row", F.xxhash64(*df.columns))
    return hashed.select(*dict.fromkeys([*only, "_row"])) if only else hashed


def first_per_id(df: DataFrame, key: str = "id", order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the least ``order`` tuple (NULL last), then the least hash
    of the row (``with_row_hash``, if it is not there yet), so equal candidates give
    one fixed answer.  A partial minimum on the map side cuts a hot key down; NULL is
    a key like others."""
    hashed = df if "_row" in df.columns else with_row_hash(df)
    names = [c for c in df.columns if c != "_row"]
    rank = F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))], F.col("_row"))
    one = F.min_by(F.struct(*names), rank).alias("_first")
    return hashed.groupBy(F.col(key).alias("_key")).agg(one).select("_first.*")


def dedup_writer(out_path: str, seen_path: str, key: str = "id",
                 keep: Sequence[str] | None = None, ledger_path: str | None = None,
                 order: Sequence[str] = (), fold_every: int = lg.FOLD_EVERY
                 ) -> Callable[[DataFrame, int], None]:
    """foreachBatch dedup that survives a hot key.

    Of a key's rows in a micro-batch the first by ``order`` stays
    (``first_per_id``: a partial minimum, so a post re-sent millions of times is
    cut down on the map side; of the columns only ``keep`` and those that decide are
    shuffled), unless an earlier batch has had it.  New rows go to
    ``out_path/batch_id=N`` and their ids, as run N, to the ledger by buckets at
    ``seen_path``; only runs below N count as seen, so a replayed batch N produces
    the same output again.  Its filters spare most of the reading, and every
    ``fold_every`` batches the earlier runs are folded.  Ids in the flat ledger at
    ``ledger_path``, read anew for each batch, count as seen too.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = with_row_hash(batch, [key, *order, *keep] if keep else ())
        _write_unseen(first_per_id(rows, key, order), batch_id, out_path, seen_path, key, keep,
                      ledger_path, fold_every)
    return write


def _write_unseen(first: DataFrame, batch_id: int, out_path: str, seen_path: str, key: str,
                  keep: Sequence[str] | None, ledger_path: str | None, fold_every: int) -> None:
    """Write the rows of ``first`` (one per key) that no earlier run has had."""
    spark = first.sparkSession
    if sum(n < batch_id for n in lg.runs(spark, seen_path)) >= fold_every:
        lg.fold_ledger(spark, seen_path, before=batch_id)
    if ledger_path:
        ledger = read_ledger(spark, ledger_path)
        first = first.join(ledger.select(F.col("id").alias(key)), key, "left_anti")
    rows = first.persist()
    fresh = lg.unseen(rows, seen_path, key, before=batch_id).persist()
    try:
        out = fresh.select(*keep) if keep else fresh
        out.write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")
        lg.append_run(fresh, seen_path, batch_id, key)
    finally:
        fresh.unpersist()
        rows.unpersist()


def bounded_dedup(posts: DataFrame, out_path: str, seen_path: str, checkpoint: str,
                  span: str = "7 days", key: str = "id", ts: str = "event_time",
                  keep: Sequence[str] | None = None, ledger_path: str | None = None,
                  order: Sequence[str] = (), fold_every: int = lg.FOLD_EVERY) -> DataStreamWriter:
    """Each key once, with a state that ends: a writer to be started.

    The keys alone pass ``dropDuplicatesWithinWatermark``, whose state forgets a key
    that lies ``span`` behind the newest post; a row that old would be dropped there
    unseen.  So whole rows take a way around the state: in each micro-batch those are
    taken whose key the state let through, or that are older than the newest time of
    all earlier batches less ``span`` (kept in ``seen_path/newest``), or have no time.
    What is taken is checked against the ledger by buckets at ``seen_path`` (and the
    flat one at ``ledger_path``): an unseen key is kept however late it comes, and a
    key whose state has ended does not come twice.  Of a key's rows in a batch the
    first by ``order`` stays."""
    rows = with_row_hash(posts, [key, ts, *order, *keep] if keep else ()).withColumn("_way", F.lit(1))
    keys = (posts.where(F.col(ts).isNotNull()).select(key, ts).withWatermark(ts, span)
            .dropDuplicatesWithinWatermark([key]).withColumn("_way", F.lit(0)))
    both = rows.unionByName(keys, allowMissingColumns=True)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = f"{seen_path}/newest"
        bound = F.lit(None).cast("timestamp")
        if any(n < batch_id for n in batches(spark, marks)):
            newest = read_log(spark, marks).where(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
            # no time in all earlier batches (an empty file, say): nothing is late yet
            bound = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {span}")
        held = batch.persist()
        try:
            own = held.where("_way = 1").drop("_way")
            passed = held.where("_way = 0").select(F.col(key).alias("_key")).distinct()
            late = F.coalesce(F.col(ts) <= bound, F.lit(False)) | F.col(ts).isNull()
            taken = own.where(late).unionByName(
                own.where(~late).join(passed, F.col(key).eqNullSafe(F.col("_key")), "left_semi"))
            _write_unseen(first_per_id(taken, key, order), batch_id, out_path, seen_path, key, keep,
                          ledger_path, fold_every)
            (own.agg(F.max(ts).alias("newest")).write.mode("overwrite")
             .parquet(f"{marks}/batch_id={batch_id}"))
        finally:
            held.unpersist()
    return (both.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .outputMode("append"))


def trend_counts(posts: DataFrame, ts: str = "event_time", every: str = "1 hour",
                 delay: str | None = None, by: str | None = None) -> DataFrame:
    """Running posts per tumbling window (and ``by``).

    Every post counts, however late: the state is one row per window and
    value, so it grows with the time covered, not with the posts.  With
    ``delay`` windows are closed that far behind the newest post and later
    posts are left out.
    """
    keys = [F.window(F.col(ts), every).alias("w")] + ([F.col(by)] if by else [])
    timed = posts.withWatermark(ts, delay) if delay else posts
    return (timed.groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("posts"))
            .select(F.col("w.start").alias("bucket"), *([by] if by else []), "posts"))


# ------------------------------------------------------------------- sinks ----

def publish_stream(df: DataFrame, fmt: str = "kafka", options: dict[str, str] | None = None,
                   every: str = FLUSH_EVERY, checkpoint: str | None = None,
                   key: str = "id", path: str | None = None) -> DataStreamWriter:
    """Records as JSON messages to a topic (or folder), flushed every
    ``every``.  The event time stays inside the payload."""
    return publish_messages(encode_json(df, key=key, binary=(fmt == "kafka")), fmt, options,
                            checkpoint, every, path)


def publish_messages(messages: DataFrame, fmt: str = "kafka",
                     options: dict[str, str] | None = None, checkpoint: str | None = None,
                     every: str = FLUSH_EVERY, path: str | None = None) -> DataStreamWriter:
    """Messages that are already encoded (``key``, ``value``) to a topic or folder."""
    writer = messages.writeStream.format(fmt)
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("topic", TOPIC)
    if checkpoint:
        opts["checkpointLocation"] = checkpoint
    if path:
        opts["path"] = path
    return writer.options(**opts).outputMode("append").trigger(processingTime=every)


def quarantine_writer(good_path: str, bad_path: str, schema: T.StructType = RECORD_SCHEMA
                      ) -> Callable[[DataFrame, int], None]:
    """foreachBatch function for raw messages: parse each micro-batch once
    (persisted while both sides are written), good rows to ``good_path``, bad
    ones with their reason to ``bad_path``, each under ``batch_id=N``.  A bad
    message never stops the stream."""
    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = tag_messages(batch, schema).persist()
        good, bad = split_tagged(parsed, schema)
        try:
            good.write.mode("overwrite").parquet(f"{good_path}/batch_id={batch_id}")
            bad.write.mode("overwrite").parquet(f"{bad_path}/batch_id={batch_id}")
        finally:
            parsed.unpersist()
    return write


def observe_sent(df: DataFrame, name: str = "sent") -> DataFrame:
    """Attach a 'posts sent' metric to a batch or streaming plan.  Streams
    report it per micro-batch in ``lastProgress.observedMetrics``; batch runs
    read it through ``pyspark.sql.Observation``."""
    return df.observe(name, F.count(F.lit(1)).alias("sent"))


def with_day(df: DataFrame, ts: str = "created_utc", col: str = "day") -> DataFrame:
    """Add the UTC creation day, the partition column of a day-partitioned
    store (a post's creation time does not change between versions)."""
    return df.withColumn(col, F.to_date(F.col(ts).cast("timestamp")))


def batch_writer(path: str, partitions: int | None = None,
                 partition_by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: the batch goes to ``path/batch_id=N``,
    overwriting that folder so a replay of batch N is idempotent.
    ``partition_by`` (e.g. ``["day"]``) splits each batch folder further, so
    readers filtering on it skip whole folders."""
    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch.repartition(partitions) if partitions else batch
        writer = out.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{path}/batch_id={batch_id}")
    return write


def index_options(resource: str, key: str = "id",
                  options: dict[str, str] | None = None) -> dict[str, str]:
    """Writer options of the document-index connector: the key becomes the
    document id, so a later version replaces an earlier one."""
    return {"es.resource": resource, "es.mapping.id": key, **(options or {})}


def upsert_by_key(df: DataFrame, path: str, checkpoint: str, output_mode: str = "append",
                  trigger: dict | None = None, name: str | None = None,
                  fmt: str | None = None, key: str = "id",
                  options: dict[str, str] | None = None,
                  partition_by: Sequence[str] = ()) -> DataStreamWriter:
    """Keyed store as a micro-batch log; read it with ``read_keyed``.

    With ``fmt`` (a document-index connector such as
    ``org.elasticsearch.spark.sql``) the rows pass straight to that sink with
    the key as document id (``es.mapping.id``) and ``path`` as the resource;
    the connector jar must be on the classpath.
    """
    if fmt:
        w = (df.writeStream.format(fmt).options(**index_options(path, key, options))
             .option("checkpointLocation", checkpoint).outputMode(output_mode))
        if name:
            w = w.queryName(name)
        return w.trigger(**(trigger or {"processingTime": FLUSH_EVERY}))
    w = (df.writeStream.foreachBatch(batch_writer(path, partition_by=partition_by))
         .option("checkpointLocation", checkpoint).outputMode(output_mode))
    if name:
        w = w.queryName(name)
    return w.trigger(**(trigger or {"availableNow": True}))


def latest_per_id(df: DataFrame, key: Sequence[str] | str = "id",
                  order: Sequence[str] = ("batch_id", "created_utc")) -> DataFrame:
    """Newest version per key: largest ``order`` tuple, then the largest hash
    of the row (so equal candidates give one fixed answer).

    The winner is chosen on the key, the order columns and the hash; whole rows
    cross one shuffle only, the join that brings the winners back.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    row = F.xxhash64(*[F.col(c) for c in rest]).alias("_row")
    newest = [F.col(c).desc_nulls_last() for c in order] + [F.col("_row").desc()]
    best = Window.partitionBy(*keys).orderBy(*newest)
    winner = (df.select(*keys, *order, row).withColumn("_nth", F.row_number().over(best))
              .where("_nth = 1")
              .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                      F.xxhash64(*keys).alias("_at"), F.col("_row").alias("_best")))
    # joined on two hashes, so that the rows lie as the last step needs them
    equal = reduce(and_, [F.coalesce(F.col(k) == F.col(f"_k{i}"),
                                     F.col(k).isNull() & F.col(f"_k{i}").isNull())
                          for i, k in enumerate(keys)])
    back = df.withColumns({"_row": row, "_key": F.xxhash64(*keys)}).join(
        winner, (F.col("_key") == F.col("_at")) & (F.col("_row") == F.col("_best")) & equal)
    # equal rows of a key: one of them
    one = Window.partitionBy("_key", "_row", *keys).orderBy("_row")
    return (back.withColumn("_nth", F.row_number().over(one)).where("_nth = 1")
            .select(*keys, *rest))


def batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batch folders of a log (a listing, no data read)."""
    names = [n.removeprefix("batch_id=") for n in list_folders(spark, path) if n.startswith("batch_id=")]
    return sorted(int(n) for n in names if n.isdigit())


def read_log(spark: SparkSession, path: str, since: int = -1,
             schema: T.StructType | None = None) -> DataFrame:
    """Micro-batch folders of a keyed log newer than ``since``, with their
    ``batch_id`` (the filter prunes whole folders).  A log without any folder
    (all folded and retired) is empty; it needs the ``schema`` of its rows."""
    if not batches(spark, path):
        if schema is None:
            raise ValueError(f"no batch in {path}, and no schema given")
        fields = [f for f in schema.fields if f.name != "batch_id"]
        return spark.createDataFrame([], T.StructType(fields + [T.StructField("batch_id", T.LongType())]))
    log = spark.read.option("basePath", path).parquet(f"{path}/batch_id=*") \
        .withColumn("batch_id", F.col("batch_id").cast("long"))
    return log.where(F.col("batch_id") > since) if since >= 0 else log


def same_key(keys: Sequence[str], left: str, right: str) -> Column:
    """Equal keys, NULL being one of them."""
    return reduce(and_, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def without(rows: DataFrame, newer: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` whose key is not in ``newer``."""
    return rows.alias("l").join(newer.select(*keys).alias("r"), same_key(keys, "l", "r"), "left_anti")


def _base(spark: SparkSession, base: str | None, since: int) -> tuple[DataFrame | None, int]:
    """Rows of a base and the last batch folded into them: a base by buckets
    (``fold_log``) knows that itself."""
    if not base or not path_exists(spark, base):
        return None, since
    now = bk.state(spark, base)
    if now is None:
        return spark.read.parquet(base), since
    return bk.read(spark, base).drop(bk.BUCKET), now.since


def read_keyed(spark: SparkSession, path: str, key: Sequence[str] | str = "id",
               order: Sequence[str] = ("batch_id", "created_utc"),
               base: str | None = None, since: int = -1) -> DataFrame:
    """Current documents: base rows whose key has no newer version, and the
    newest version of each key in the log batches after ``since``.  The base
    has each key once, so only the newer batches are ranked; while those are
    small the base isn't shuffled either."""
    keys = [key] if isinstance(key, str) else list(key)
    rows, since = _base(spark, base, since)
    if rows is None:
        return latest_per_id(read_log(spark, path, since), key, order).drop("batch_id")
    newer = latest_per_id(read_log(spark, path, since, rows.schema), keys, order).drop("batch_id")
    return without(rows, newer, keys).unionByName(newer)


def compact(spark: SparkSession, path: str, out: str, base: str | None = None,
            since: int = -1, key: Sequence[str] | str = "id",
            order: Sequence[str] = ("batch_id", "created_utc"),
            partition_by: Sequence[str] = ()) -> int:
    """Fold the log batches newer than ``since`` into a new base at ``out``:
    base rows whose key has no newer version, plus the newest of the newer
    versions.  The old base stays readable until readers switch.  Returns the
    last folded batch id (pass it as ``since`` next time).  ``fold_log`` keeps
    one base and rewrites only what has changed."""
    keys = [key] if isinstance(key, str) else list(key)
    rows, since = _base(spark, base, since)
    last = max([since, *batches(spark, path)])
    log = read_log(spark, path, since, rows.schema if rows is not None else None)
    folded = latest_per_id(log.where(F.col("batch_id") <= last), keys, order).drop("batch_id")
    if rows is not None:
        folded = without(rows, folded, keys).unionByName(folded)
    writer = folded.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(out)
    return int(last)


def fold_log(spark: SparkSession, path: str, base: str, key: Sequence[str] | str = "id",
             order: Sequence[str] = ("batch_id", "created_utc"), buckets: int = bk.BUCKETS) -> int:
    """Fold the new log batches into the one base at ``base``, laid out by the
    hash of the key: only the buckets that the new versions fall in are read and
    rewritten.  The base keeps the last folded batch beside its rows, so readers
    need no more than its path.  Returns that batch."""
    keys = [key] if isinstance(key, str) else list(key)
    bk.finish(spark, base)
    now = bk.state(spark, base)
    since, buckets = (now.since, now.buckets) if now else (bk.NEVER, buckets)
    last = max([since, *batches(spark, path)])
    if last == since:
        return since
    log = read_log(spark, path, since).where(F.col("batch_id") <= last)
    rows = latest_per_id(log, keys, order).drop("batch_id").withColumn(bk.BUCKET, bk.bucket_of(keys, buckets))
    if now:
        newer = stored(rows, "newer")
        old = bk.read(spark, base, bk.touched(newer))
        rows = without(old, newer, keys).unionByName(newer)
    bk.replace(spark, base, rows, last, buckets)
    return last


def retire(spark: SparkSession, path: str, upto: int) -> int:
    """Delete the log batches up to ``upto`` that a base has folded; call
    it after readers have switched to that base.  Returns their number."""
    return sum(delete_path(spark, f"{path}/batch_id={n}") for n in batches(spark, path) if n <= upto)


# --------------------------------------------------------------- lifecycle ----

def run_until_stopped(start: Callable[[], StreamingQuery], retries: int | None = None,
                      wait_seconds: float = 60.0,
                      sleep: Callable[[float], None] = time.sleep) -> int:
    """Start the query and restart it from its checkpoint after any failure,
    of the start too, waiting between attempts.  Returns the number of restarts; stops when the
    query ends normally or after ``retries`` restarts (None: never give up)."""
    restarts = 0
    while True:
        try:
            start().awaitTermination()
            return restarts
        except Exception:  # noqa: BLE001 - a failed start is retried as well
            if retries is not None and restarts >= retries:
                raise
            restarts += 1
            sleep(wait_seconds)

