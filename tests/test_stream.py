import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from poststream.operators import ingest as ig
from poststream.session import scratch_path
from poststream.sources import wire
from poststream.sources.ledger import append_ledger
from poststream.streaming import stream as st


def _posts(spark, ids, title="t", minute=0):
    t0 = dt.datetime(2024, 1, 1, 0, minute)
    rows = [(str(i), f"{title}{i}", "body", "src", t0 + dt.timedelta(hours=i)) for i in ids]
    return spark.createDataFrame(
        rows, "id string, title string, selftext string, subreddit string, created_utc timestamp")


def _write(spark, df, folder):
    wire.encode_json(ig.shape_record(df), binary=True).coalesce(1) \
        .write.mode("append").parquet(folder)


def _stream(spark, folder):
    raw = st.read_posts_stream(spark, "parquet", path=folder, max_files_per_trigger=1)
    return st.parse_posts(raw)[0]


def test_restart_resumes_without_loss_or_duplicate(spark):
    folder = scratch_path(spark, "t-topic")
    log, ckpt = scratch_path(spark, "t-log"), scratch_path(spark, "t-ckpt")
    _write(spark, _posts(spark, range(5)), folder)
    cols = ["id", "title", "created_utc"]
    st.upsert_by_key(_stream(spark, folder).select(*cols), log, ckpt).start().awaitTermination()
    _write(spark, _posts(spark, range(3, 8), title="v2-", minute=1), folder)
    st.upsert_by_key(_stream(spark, folder).select(*cols), log, ckpt).start().awaitTermination()
    raw = st.read_log(spark, log)
    assert raw.count() == 10                       # every message once, none twice
    cur = {r.id: r.title for r in st.read_keyed(spark, log).collect()}
    assert cur == {"0": "t0", "1": "t1", "2": "t2", "3": "v2-3", "4": "v2-4", "5": "v2-5",
                   "6": "v2-6", "7": "v2-7"}


def test_batch_writer_is_idempotent(spark):
    log = scratch_path(spark, "t-idem")
    w = st.batch_writer(log)
    df = _posts(spark, range(3)).select("id", "title")
    w(df, 0)
    w(df, 0)                                        # replay of batch 0
    assert st.read_log(spark, log).count() == 3


def test_compact_folds_log(spark):
    log = scratch_path(spark, "t-compact")
    w = st.batch_writer(log)
    w(_posts(spark, range(3)).select("id", "title", "created_utc"), 0)
    base1 = scratch_path(spark, "t-base")
    since = st.compact(spark, log, base1)
    w(_posts(spark, [1], title="new").select("id", "title", "created_utc"), 1)
    base2 = scratch_path(spark, "t-base")
    st.compact(spark, log, base2, base=base1, since=since)
    got = {r.id: r.title for r in spark.read.parquet(base2).collect()}
    assert got == {"0": "t0", "1": "new1", "2": "t2"}
    assert {r.id: r.title for r in st.read_keyed(spark, log, base=base1, since=since).collect()} \
        == got


def test_stream_dedup_keeps_each_id_once(spark):
    folder = scratch_path(spark, "t-dedup")
    _write(spark, _posts(spark, range(6)), folder)
    _write(spark, _posts(spark, range(4)), folder)   # re-sent copies
    out = scratch_path(spark, "t-dedup-out")
    q = (st.dedup_stream(_stream(spark, folder))
         .select("id").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", scratch_path(spark, "t-dedup-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == ["0", "1", "2", "3", "4", "5"]


def test_late_unseen_posts_and_fresh_ledger(spark):
    out, seen = scratch_path(spark, "t-late-out"), scratch_path(spark, "t-late-seen")
    ledger = scratch_path(spark, "t-late-ledger")
    w = st.dedup_writer(out, seen, keep=["id"], ledger_path=ledger)
    w(_posts(spark, [900, 901]), 0)
    append_ledger(_posts(spark, [7]), ledger)       # after the stream has begun
    w(_posts(spark, [1, 7, 901]), 1)                # far older than batch 0, never seen
    assert sorted(r.id for r in st.read_log(spark, out).collect()) == ["1", "900", "901"]


def test_enrich_stream_without_model(spark):
    folder = scratch_path(spark, "t-enrich")
    _write(spark, _posts(spark, range(2)).withColumn("title", F.lit("Java dev")), folder)
    docs = st.enrich_stream(_stream(spark, folder), r"(?<!\w)(?:java)(?!\w)", None)
    out = scratch_path(spark, "t-enrich-out")
    (docs.writeStream.format("parquet").option("path", out)
     .option("checkpointLocation", scratch_path(spark, "t-enrich-ckpt"))
     .trigger(availableNow=True).start().awaitTermination())
    rows = spark.read.parquet(out).collect()
    assert [list(r.skills_array) for r in rows] == [["java"], ["java"]]


def test_publish_stream_to_files(spark):
    folder = scratch_path(spark, "t-pub-in")
    _write(spark, _posts(spark, range(3)), folder)
    out = scratch_path(spark, "t-pub-out")
    w = st.publish_stream(_stream(spark, folder).drop("event_time"), fmt="json", path=out,
                          checkpoint=scratch_path(spark, "t-pub-ckpt"))
    w.trigger(availableNow=True).start().awaitTermination()
    back = spark.read.json(out)
    assert sorted(back.columns) == ["key", "value"] and back.count() == 3


def test_kafka_options():
    o = st.kafka_source_options("broker:9092", max_per_trigger=50, min_partitions=16)
    assert o["subscribe"] == "redditjob" and o["startingOffsets"] == "earliest"
    assert o["maxOffsetsPerTrigger"] == "50" and o["minPartitions"] == "16"


class _FakeQuery:
    def __init__(self, fail):
        self.fail = fail

    def awaitTermination(self):
        if self.fail:
            raise _Boom()


class _Boom(StreamingQueryException):
    def __init__(self):
        Exception.__init__(self, "boom")


def test_run_until_stopped_restarts():
    plan = [True, True, False]
    waits = []
    n = st.run_until_stopped(lambda: _FakeQuery(plan.pop(0)), sleep=waits.append,
                             wait_seconds=60)
    assert n == 2 and waits == [60, 60]
    with pytest.raises(StreamingQueryException):
        st.run_until_stopped(lambda: _FakeQuery(True), retries=1, sleep=lambda s: None)


def test_run_until_stopped_retries_a_failing_start():
    calls = []

    def start():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("no broker yet")
        return _FakeQuery(False)
    assert st.run_until_stopped(start, retries=3, sleep=lambda s: None) == 2


def test_retire_removes_folded_batches(spark):
    log = scratch_path(spark, "t-retire")
    w = st.batch_writer(log)
    for n in range(3):
        w(_posts(spark, [n]).select("id", "title", "created_utc"), n)
    assert st.retire(spark, log, 1) == 2
    assert [r.id for r in st.read_log(spark, log).collect()] == ["2"]


def test_quarantine_writer_splits_each_batch(spark):
    msgs = spark.createDataFrame(
        [("1", '{"id":"1","title":"a"}'), ("2", "{bad"), ("3", '{"title":"x"}')],
        "key string, value string")
    good, bad = scratch_path(spark, "t-good"), scratch_path(spark, "t-bad")
    st.quarantine_writer(good, bad)(msgs, 0)
    assert [r.id for r in st.read_log(spark, good).collect()] == ["1"]
    assert sorted(r.reason for r in st.read_log(spark, bad).collect()) == \
        ["malformed json", "missing id"]


def test_observe_sent_in_batch_and_stream(spark):
    from pyspark.sql import Observation
    obs = Observation("sent")
    df = _posts(spark, range(4))
    df.observe(obs, F.count(F.lit(1)).alias("sent")).write.format("noop").mode("overwrite").save()
    assert obs.get["sent"] == 4
    folder = scratch_path(spark, "t-obs")
    _write(spark, _posts(spark, range(3)), folder)
    q = (st.observe_sent(_stream(spark, folder)).writeStream.format("noop")
         .option("checkpointLocation", scratch_path(spark, "t-obs-ckpt"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    seen = [p["observedMetrics"]["sent"]["sent"] for p in q.recentProgress
            if p.get("observedMetrics")]
    assert sum(seen) == 3


def test_dedup_writer_hot_key_and_replay(spark):
    out, seen = scratch_path(spark, "t-dw-out"), scratch_path(spark, "t-dw-seen")
    w = st.dedup_writer(out, seen, keep=["id", "title"])
    hot = spark.range(5000).select(F.lit("hot").alias("id"), F.lit("x").alias("title"))
    batch0 = hot.unionByName(_posts(spark, range(3)).select("id", "title"))
    w(batch0, 0)
    batch1 = _posts(spark, range(2, 5)).select("id", "title").unionByName(hot.limit(10))
    w(batch1, 1)
    w(batch1, 1)                                   # replay after a crash
    ids = sorted(r.id for r in st.read_log(spark, out).collect())
    assert ids == ["0", "1", "2", "3", "4", "hot"]


def test_json_lines_folder_stream(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    (folder / "a.json").write_text('{"id":"1","title":"x","created_utc":"2024-01-01T00:00:00+00:00"}\n'
                                  '{bad\n')
    raw = st.read_posts_stream(spark, "text", path=str(folder))
    good, bad = st.parse_posts(raw)
    out = scratch_path(spark, "t-lines")
    (good.writeStream.format("parquet").option("path", out)
     .option("checkpointLocation", scratch_path(spark, "t-lines-ckpt"))
     .trigger(availableNow=True).start().awaitTermination())
    rows = spark.read.parquet(out).collect()
    assert [r.id for r in rows] == ["1"]
    assert rows[0].event_time.year == 2024


def test_day_partitioned_log_prunes_folders(spark):
    import contextlib
    import io
    log = scratch_path(spark, "t-days")
    w = st.batch_writer(log, partition_by=["day"])
    w(st.with_day(_posts(spark, range(30)).select("id", "title", "created_utc")), 0)
    day_one = st.read_log(spark, log).where(F.col("day") == dt.date(2024, 1, 1))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        day_one.explain()
    assert "PartitionFilters: [isnotnull(day" in buf.getvalue()
    assert day_one.count() == 24
    base = scratch_path(spark, "t-days-base")
    st.compact(spark, log, base, partition_by=["day"])
    assert spark.read.parquet(base).where(F.col("day") == dt.date(2024, 1, 2)).count() == 6


def test_second_versions_come_from_the_marked_topic(spark):
    from poststream.plans import streams as q
    sf = "/root/testdata/sf0.001"
    folder = q._marked_topic(spark, sf)
    first, second = q._versions(spark, sf)
    assert sorted(spark.read.parquet(folder).select("key", "value").collect()) == \
        sorted(q._messages(spark, sf, first).collect())
    want = sorted(q._messages(spark, sf, second).collect())
    assert want and sorted(q._edited_messages(spark, folder).collect()) == want
    assert sorted(q._labelled_messages(spark, folder).collect()) == \
        sorted(q._messages(spark, sf, q._labelled(spark, sf)).collect())
