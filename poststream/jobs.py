"""Runnable jobs composed from the library: train, classify a stream, ingest.

    python -m poststream.jobs train --training t.csv --model out/model
    python -m poststream.jobs classify --lexicon skills.csv --model out/model \
        --source-format kafka --bootstrap broker:9092 --index out/index \
        --checkpoint out/ckpt
    python -m poststream.jobs ingest --posts posts.parquet --ledger out/ledger \
        --out out/messages --as-of 2024-01-03T00:00:00
    python -m poststream.jobs publish --messages out/messages --bootstrap broker:9092
    python -m poststream.jobs compact --index out/index --base out/base
    python -m poststream.jobs retire --index out/index --base out/base
    python -m poststream.jobs panels --index out/index --base out/base --out out/panels
    python -m poststream.jobs loop --posts posts.parquet --ledger out/ledger \
        --out out/messages            # backfill, then increments every 60 s

Paths should be on shared storage; checkpoints default to a folder below
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import time
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .defaults import (DAYS_BACK, FIRST_RUN_LIMIT, JOB_KEYWORDS, JOB_SOURCES, LATER_RUN_LIMIT,
                       POLL_SECONDS, TOPIC)
from .operators import ingest as ig
from .operators import lexicon as lx
from .operators import model as ml
from .operators import terms
from .session import get_session, materialize, scratch_path, stored
from .sources import buckets as bk
from .sources import ledger as lg
from .sources import wire
from .sources.files import read_training
from .streaming import deltas as dl
from .streaming import stream as st


def train(spark: SparkSession, training_path: str, model_path: str, compat: bool = False,
          parallelism: int = 4) -> dict:
    """Fit the classifier: label index on the whole set, grid search with
    k folds on the training share, hold-out accuracy, save the best model."""
    data = materialize(ml.holdout(ml.drop_missing(read_training(spark, training_path))
                                  .withColumn("id", F.xxhash64("skills", "category")
                                              .cast("string"))))
    train_rows = data.where(F.col("split") == "train")
    pipeline = ml.build_classifier(ml.fit_label_indexer(data), compat=compat)
    cv = ml.tune(train_rows, pipeline, parallelism=parallelism)
    test_rows = data.where(F.col("split") == "test")
    accuracy = ml.accuracy(ml.score(test_rows, cv.bestModel)).first()[0]
    ml.save_model(cv.bestModel, model_path)
    return {"accuracy": accuracy, "grid": ml.tune_report(cv)}


def classify(spark: SparkSession, lexicon_path: str, model_path: str, index_path: str,
             checkpoint: str | None = None, source_format: str = "kafka",
             source_options: dict[str, str] | None = None, source_path: str | None = None,
             quarantine_path: str | None = None, trigger: dict | None = None,
             sink_format: str | None = None, sink_options: dict[str, str] | None = None,
             deltas_path: str | None = None, base_path: str | None = None) -> StreamingQuery:
    """Messages -> parse -> skills -> model -> category -> keyed index.

    One query: each micro-batch is parsed once (persisted), good messages
    are enriched into ``index_path/batch_id=N`` and bad ones, with their
    reason, into ``quarantine_path/batch_id=N``; both are overwritten on a
    replay, so a restart from the checkpoint is idempotent.  With
    ``sink_format`` the documents go to that document-index connector instead
    (``index_path`` is its resource; the id as document key makes a replay
    write the same documents).  With ``deltas_path`` each batch also stores its
    signed panel counts (``base_path``: the base that ``compact`` keeps)."""
    matcher = lx.lexicon_matcher(lx.read_lexicon_csv(spark, lexicon_path))
    model = ml.load_model(model_path)
    raw = st.read_posts_stream(spark, source_format, source_options, source_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = wire.tag_messages(batch).persist()
        try:
            good, bad = wire.split_tagged(tagged)
            docs = st.enrich_stream(good, matcher, model)
            if sink_format:
                (docs.write.format(sink_format).mode("append")
                 .options(**st.index_options(index_path, options=sink_options)).save())
            elif deltas_path:
                dl.delta_writer(index_path, deltas_path, base_path)(docs, batch_id)
            else:
                docs.write.mode("overwrite").parquet(f"{index_path}/batch_id={batch_id}")
            if quarantine_path:
                bad.write.mode("overwrite").parquet(f"{quarantine_path}/batch_id={batch_id}")
        finally:
            tagged.unpersist()

    return (raw.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint or scratch_path(spark, "classify-ckpt"))
            .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def ingest(spark: SparkSession, posts: DataFrame, ledger_path: str, out_path: str,
           as_of: str, sources: Sequence[str] = JOB_SOURCES,
           keywords: Sequence[str] = JOB_KEYWORDS, limit: int = FIRST_RUN_LIMIT,
           days: int = DAYS_BACK) -> int:
    """One ingest run: decide what to send, write the messages, then record
    the sent ids in the ledger by buckets (in that order: at least once), which is
    folded every few runs."""
    if len(lg.runs(spark, ledger_path)) >= lg.FOLD_EVERY:
        lg.fold_ledger(spark, ledger_path)
    sent = ig.prepare(posts, ledger_path, as_of, sources, keywords, limit, days)
    sent = materialize(sent)
    routed = ig.route(ig.with_tag(sent)).drop("tag")      # emitted as reddit.jobs.post
    wire.encode_json(routed).write.mode("append").parquet(out_path)
    lg.append_run(sent, ledger_path)
    return sent.count()


def publish(spark: SparkSession, messages_path: str, fmt: str = "kafka",
            options: dict[str, str] | None = None, out_path: str | None = None,
            checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Send the messages that ingest runs wrote, each once per checkpoint, to a
    topic (or another folder): the link from ``ingest`` to ``classify``."""
    raw = st.read_posts_stream(spark, "parquet", path=messages_path, schema=st.TEXT_MESSAGES)
    writer = st.publish_messages(raw, fmt, options, checkpoint or scratch_path(spark, "publish-ckpt"),
                                 path=out_path)
    return (writer.trigger(**trigger) if trigger else writer).start()


def compact(spark: SparkSession, index_path: str, base: str, buckets: int = bk.BUCKETS,
            deltas_path: str | None = None, sums_path: str | None = None) -> int:
    """Fold the index log into its base, rewriting the buckets that have
    changed, and the panel deltas into their sums.  The folded batches stay
    until ``retire``.  Returns the last folded batch."""
    last = st.fold_log(spark, index_path, base, buckets=buckets)
    if deltas_path and sums_path:
        dl.fold_deltas(spark, deltas_path, sums_path)
    return last


def retire(spark: SparkSession, index_path: str, base: str) -> int:
    """Delete the batches that the base holds; a step of its own, for when no
    reader that began before the last ``compact`` still runs."""
    now = bk.state(spark, base)
    return st.retire(spark, index_path, now.since) if now else 0


def panels(spark: SparkSession, index_path: str, out: str, base: str | None = None,
           deltas_path: str | None = None, sums_path: str | None = None) -> dict[str, int]:
    """Refresh all dashboard panels from the index; rows written per panel.
    With the panel deltas only rest buckets read the index."""
    index = st.read_keyed(spark, index_path, base=base)
    counts = stored(dl.read_counts(spark, deltas_path, sums_path)) if deltas_path else None
    rows = {}
    for name, df in terms.panels(index, counts=counts).items():
        df.write.mode("overwrite").json(f"{out}/{name}")
        rows[name] = spark.read.schema(df.schema).json(f"{out}/{name}").count()
    return rows


def ingest_loop(spark: SparkSession, read_posts: Callable[[], DataFrame], ledger_path: str,
                out_path: str, as_of: Callable[[], str] | None = None,
                sources: Sequence[str] = JOB_SOURCES, keywords: Sequence[str] = JOB_KEYWORDS,
                every_seconds: float = POLL_SECONDS, runs: int | None = None,
                sleep: Callable[[float], None] = time.sleep) -> list[int]:
    """Repeated ingest runs: a backfill first (``FIRST_RUN_LIMIT`` newest
    posts per source), then increments (``LATER_RUN_LIMIT``), a pause
    between runs, and a failed run is reported and retried after the pause
    instead of stopping the loop.  ``runs=None`` loops forever.  Returns the
    number of posts sent per successful run."""
    sent: list[int] = []
    first = True
    attempt = 0
    while runs is None or attempt < runs:
        attempt += 1
        try:
            stamp = as_of() if as_of else datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
            limit = FIRST_RUN_LIMIT if first else LATER_RUN_LIMIT
            sent.append(ingest(spark, read_posts(), ledger_path, out_path, stamp, sources,
                               keywords, limit))
            first = False
        except Exception as exc:  # noqa: BLE001 - a failed run must not end the loop
            print(f"ingest run failed, retrying after {every_seconds} s: {exc}")
        sleep(every_seconds)
    return sent


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="poststream.jobs")
    sub = p.add_subparsers(dest="cmd", required=True)
    t = sub.add_parser("train")
    t.add_argument("--training", required=True)
    t.add_argument("--model", required=True)
    t.add_argument("--compat", action="store_true")
    c = sub.add_parser("classify")
    c.add_argument("--lexicon", required=True)
    c.add_argument("--model", required=True)
    c.add_argument("--index", required=True)
    c.add_argument("--checkpoint")
    c.add_argument("--source-format", default="kafka")
    c.add_argument("--source-path")
    c.add_argument("--bootstrap")
    c.add_argument("--topic", default=TOPIC)
    c.add_argument("--quarantine")
    c.add_argument("--deltas", help="keep panel counts by batch here")
    c.add_argument("--base", help="the base that compact keeps")
    c.add_argument("--sink-format", help="document-index connector; default: Parquet log")
    c.add_argument("--sink-option", action="append", default=[], metavar="KEY=VALUE")
    c.add_argument("--max-per-trigger", type=int, help="offsets per micro-batch")
    c.add_argument("--min-partitions", type=int, help="tasks to spread the topic over")
    pb = sub.add_parser("publish")
    pb.add_argument("--messages", required=True)
    pb.add_argument("--format", default="kafka")
    pb.add_argument("--bootstrap")
    pb.add_argument("--topic", default=TOPIC)
    pb.add_argument("--out")
    pb.add_argument("--checkpoint")
    pn = sub.add_parser("panels")
    pn.add_argument("--index", required=True)
    pn.add_argument("--out", required=True)
    pn.add_argument("--base")
    pn.add_argument("--deltas", help="panel counts by batch, as classify writes them")
    pn.add_argument("--sums", help="the folded ones")
    cp = sub.add_parser("compact")
    cp.add_argument("--index", required=True)
    cp.add_argument("--base", required=True)
    cp.add_argument("--buckets", type=int, default=bk.BUCKETS, help="of a new base")
    cp.add_argument("--deltas")
    cp.add_argument("--sums")
    rt = sub.add_parser("retire")
    rt.add_argument("--index", required=True)
    rt.add_argument("--base", required=True)
    i = sub.add_parser("ingest")
    i.add_argument("--posts", required=True)
    i.add_argument("--ledger", required=True)
    i.add_argument("--out", required=True)
    i.add_argument("--as-of", required=True)
    i.add_argument("--limit", type=int, default=FIRST_RUN_LIMIT)
    lp = sub.add_parser("loop")
    lp.add_argument("--posts", required=True)
    lp.add_argument("--ledger", required=True)
    lp.add_argument("--out", required=True)
    lp.add_argument("--every", type=float, default=POLL_SECONDS)
    return p


def source_options(args: argparse.Namespace) -> dict[str, str]:
    """Reader options of the classify command."""
    if args.source_format != "kafka":
        return {}
    return st.kafka_source_options(args.bootstrap, args.topic, max_per_trigger=args.max_per_trigger,
                                   min_partitions=args.min_partitions)


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = get_session()
    if args.cmd == "train":
        print(json.dumps(train(spark, args.training, args.model, args.compat)))
    elif args.cmd == "classify":
        opts = source_options(args)
        sink = dict(x.split("=", 1) for x in args.sink_option)
        ckpt = args.checkpoint or scratch_path(spark, "classify-ckpt")
        st.run_until_stopped(lambda: classify(spark, args.lexicon, args.model, args.index, ckpt,
                                              args.source_format, opts, args.source_path,
                                              args.quarantine, sink_format=args.sink_format,
                                              sink_options=sink, deltas_path=args.deltas,
                                              base_path=args.base))
    elif args.cmd == "publish":
        opts = {"kafka.bootstrap.servers": args.bootstrap, "topic": args.topic} \
            if args.format == "kafka" else {}
        ckpt = args.checkpoint or scratch_path(spark, "publish-ckpt")
        st.run_until_stopped(lambda: publish(spark, args.messages, args.format, opts, args.out, ckpt))
    elif args.cmd == "panels":
        print(json.dumps(panels(spark, args.index, args.out, args.base, args.deltas, args.sums)))
    elif args.cmd == "compact":
        print(json.dumps({"folded": compact(spark, args.index, args.base, args.buckets, args.deltas,
                                            args.sums)}))
    elif args.cmd == "retire":
        print(json.dumps({"retired": retire(spark, args.index, args.base)}))
    elif args.cmd == "ingest":
        n = ingest(spark, spark.read.parquet(args.posts), args.ledger, args.out, args.as_of,
                   limit=args.limit)
        print(json.dumps({"sent": n}))
    else:
        ingest_loop(spark, lambda: spark.read.parquet(args.posts), args.ledger, args.out,
                    every_seconds=args.every)


if __name__ == "__main__":
    main()
