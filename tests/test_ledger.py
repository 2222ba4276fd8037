"""The seen ledger by buckets, its filters, and the dedup that uses it."""
import datetime as dt
import random
import time

from pyspark.sql import functions as F

from poststream.operators import ingest as ig
from poststream.session import scratch_path
from poststream.sources import buckets as bk
from poststream.sources import ledger as lg
from poststream.sources import wire
from poststream.streaming import stream as st
from test_keyed import files


def ids(spark, values):
    return spark.createDataFrame([(None if v is None else str(v),) for v in values], "id string")


def test_unseen_equals_a_plain_anti_join(spark):
    path, rng, sent = scratch_path(spark, "t-ledger"), random.Random(1), set()
    assert lg.unseen(ids(spark, [1, 1, None]), path).count() == 3
    for run in range(5):
        new = [rng.randint(0, 4000) for _ in range(500)]
        assert lg.append_run(ids(spark, [*new, None]), path) == run
        sent |= set(new)
        if run in (1, 2):
            assert lg.fold_ledger(spark, path, buckets=8) == run
            assert lg.runs(spark, path) == [] and lg.next_run(spark, path) == run + 1
        asked = [rng.randint(0, 8000) for _ in range(300)] + [None]
        got = [r.id for r in ig.unseen(ids(spark, asked), path).collect()]
        assert sorted(map(str, got)) == sorted(str(a) for a in asked if a is None or a not in sent)
    assert lg.fold_ledger(spark, path) == 4 and lg.fold_ledger(spark, path) == 4
    held = bk.read(spark, f"{path}/ids")
    assert held.count() == held.distinct().count() == len(sent)


def test_only_earlier_runs_count(spark):
    path = scratch_path(spark, "t-ledger")
    lg.append_run(ids(spark, [1]), path, 0)
    lg.append_run(ids(spark, [2]), path, 1)
    left = lambda n: sorted(r.id for r in lg.unseen(ids(spark, [1, 2, 3]), path, before=n).collect())
    assert (left(0), left(1), left(2)) == (["1", "2", "3"], ["2", "3"], ["3"])


def test_filter_lets_all_held_and_few_others_through(spark):
    placed = lambda a, b: spark.range(a, b).select(F.col("id").cast("string")).select(
        "id", bk.bucket_of(["id"], 4))
    filters = lg.build_filter(placed(0, 40_000)).cache()
    assert filters.agg(F.max(F.length("bits"))).first()[0] == lg.BLOCK_BITS // 8
    assert filters.count() == 4 * 4              # ten thousand ids a bucket, three thousand a block
    assert lg.may_hold(placed(0, 40_000), filters).count() == 40_000
    assert lg.may_hold(placed(100_000, 140_000), filters).count() < 0.015 * 40_000


def test_a_run_reads_and_rewrites_little(spark, monkeypatch):
    path = scratch_path(spark, "t-ledger")
    lg.append_run(spark.range(64_000).select(F.col("id").cast("string")), path)
    lg.fold_ledger(spark, path, buckets=256)
    read, rows = bk.read, []

    def counted(spark, where, only=None):
        df = read(spark, where, only)
        if where.endswith("/ids"):
            rows.append(df.count())
        return df
    monkeypatch.setattr(bk, "read", counted)
    asked = ids(spark, [5, 7, *range(200_000, 200_100)])
    assert lg.unseen(asked, path).count() == 100
    assert rows[0] <= 6 * 64_000 / 256 * 1.5      # two held ids, a few let through wrongly
    assert lg.unseen(ids(spark, range(300_000, 300_004)), path).count() == 4
    assert rows[1] < 1000                         # nearly always none
    before = files(f"{path}/ids"), files(f"{path}/filter")
    lg.append_run(ids(spark, [900_001]), path)
    lg.fold_ledger(spark, path)
    for old, new in zip(before, (files(f"{path}/ids"), files(f"{path}/filter"))):
        assert sum(new[d] != old.get(d) for d in new) == 1


def test_first_row_of_an_id_stays(spark):
    rows = [("a", 3, "x"), ("a", 1, "y"), ("a", 2, "z"), ("b", None, "p"), ("b", 5, "q"), (None, 1, "n"),
            (None, 1, "m")]
    df = spark.createDataFrame(rows, "id string, at int, v string").repartition(4)
    got = {r.id: r.v for r in st.first_per_id(df, "id", ["at"]).collect()}
    assert got["a"] == "y" and got["b"] == "q" and len(got) == 3
    for _ in range(3):     # equal candidates: one fixed answer
        assert {r.id: r.v for r in st.first_per_id(df.repartition(3), "id", ["at"]).collect()} == got


def posts(spark, rows):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(str(i), f"t{i}", "", "s", t0 + dt.timedelta(hours=h)) for i, h in rows],
                               "id string, title string, selftext string, subreddit string, "
                               "created_utc timestamp")
    return wire.encode_json(ig.shape_record(df), binary=True)


def test_bounded_state_and_no_loss_over_ten_batches(spark):
    topic, out, seen, ckpt = (scratch_path(spark, f"t-bounded-{n}") for n in "abcd")
    want, rng = set(), random.Random(2)
    for n in range(10):
        # forty new posts a batch, twelve hours on; repeats, very late ones, and repeats of forgotten ones
        rows = [(100 * n + k, 12 * n + k % 12) for k in range(40)]
        rows += [(100 * n + k, 12 * n + k % 12) for k in range(5)]
        rows += [(5000 + n, 0), (100 * max(0, n - 4) + 1, 12 * max(0, n - 4) + 1)]
        rows += [(100 * max(0, n - 5) + 2, 12 * n)]          # a forgotten id under a new time
        want |= {str(i) for i, _ in rows}
        rng.shuffle(rows)
        posts(spark, rows).coalesce(1).write.mode("append").parquet(topic)
    raw = st.read_posts_stream(spark, "parquet", path=topic, max_files_per_trigger=1)
    good, _ = st.parse_posts(raw)
    q = st.bounded_dedup(good, out, seen, ckpt, "1 day", keep=["id"], order=["event_time"],
                         fold_every=4).trigger(availableNow=True).start()
    q.awaitTermination()
    got = [r.id for r in st.read_log(spark, out).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["numInputRows"]]
    dropped = sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in q.recentProgress)
    assert len(held) == 10 and dropped > 0
    assert max(held) <= 5 * 45 < len(want)       # posts of about two days, not of five


def test_bounded_dedup_begins_with_batches_without_a_time(spark):
    """First an empty file, then posts without a time: no newest time is known yet."""
    topic, out, seen, ckpt = (scratch_path(spark, f"t-timeless-{n}") for n in "abcd")
    rows = [[], [("a", None)], [("a", None), ("b", "2024-01-02T00:00:00+00:00")],
            [("b", "2024-01-02T00:00:00+00:00"), ("c", "2024-01-01T00:00:00+00:00"), ("d", None)]]
    record = "id string, title string, created_utc string, selftext string, subreddit string, url string"
    for part in rows:
        df = spark.createDataFrame([(i, "t", at, None, "s", None) for i, at in part], record)
        wire.encode_json(df, binary=True).coalesce(1).write.mode("append").parquet(topic)
        time.sleep(0.01)        # files are taken by their time
    good, _ = st.parse_posts(st.read_posts_stream(spark, "parquet", path=topic, max_files_per_trigger=1))
    q = st.bounded_dedup(good, out, seen, ckpt, "6 hours", keep=["id"], order=["event_time"]).trigger(
        availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.id for r in st.read_log(spark, out).collect()) == ["a", "b", "c", "d"]


def test_dedup_shuffles_no_column_that_is_not_kept(spark, tmp_path):
    """Of a wide batch only the kept columns and those that decide cross the shuffle;
    the choice among equal candidates still follows the whole row."""
    path = str(tmp_path / "wide")
    spark.range(60).selectExpr("cast(id % 20 AS string) AS id", "concat('t', id) AS title",
                               "repeat(concat('body', id), 50) AS selftext").write.parquet(path)
    batch = spark.read.parquet(path)
    cut = st.first_per_id(st.with_row_hash(batch, ["id", "title"]), "id")
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "selftext" not in plan.split("Project")[0]
    whole = st.first_per_id(batch, "id").select("id", "title")
    assert sorted(cut.collect()) == sorted(whole.collect()) and cut.count() == 20
