import datetime as dt
import random
import re

from pyspark.sql import functions as F

from poststream.operators import ingest as ig
from poststream.operators.topn import global_rank, top_n_per_group


def test_tag_patterns():
    def m(p, t):
        return re.match(ig.tag_regex(p), t) is not None
    assert m("reddit.jobs.**", "reddit.jobs")
    assert m("reddit.jobs.**", "reddit.jobs.post")
    assert m("reddit.jobs.**", "reddit.jobs.a.b")
    assert not m("reddit.jobs.**", "reddit.jobsx.post")
    assert not m("reddit.jobs.**", "reddit")
    assert m("a.*", "a.b") and not m("a.*", "a.b.c")
    assert m("a.{b,c}.d", "a.c.d") and not m("a.{b,c}.d", "a.e.d")
    assert m("**.d", "d") and m("**.d", "x.y.d")
    assert m("a.**.d", "a.d") and m("a.**.d", "a.x.y.d")
    assert m("x.y a.b", "a.b")


def test_default_route_keeps_emitted_tag(spark):
    df = spark.createDataFrame([("1",)], "id string")
    tagged = ig.with_tag(df)
    assert tagged.first().tag == "reddit.jobs.post"
    assert ig.route(tagged).count() == 1
    assert ig.route(ig.with_tag(df, "reddit.other.post")).count() == 0


def test_top_n_per_group_with_hot_group_equals_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        src = "hot" if i % 3 else rnd.choice(["s1", "s2", "s3"])
        rows.append((str(i), src, rnd.randint(0, 500)))
    df = spark.createDataFrame(rows, "id string, src string, ts int")
    got = top_n_per_group(df, ["src"], [F.col("ts").desc(), F.col("id").asc()], 25,
                          salt_on=["id"], salt_buckets=16, rank_col="rn")
    got = sorted((r.src, r.rn, r.id) for r in got.collect())
    want = []
    for src in {r[1] for r in rows}:
        part = sorted([r for r in rows if r[1] == src], key=lambda r: (-r[2], r[0]))[:25]
        want += [(src, k + 1, r[0]) for k, r in enumerate(part)]
    assert got == sorted(want)


def _posts(spark):
    t0 = dt.datetime(2024, 1, 3)
    rows = [("1", "Hiring now", "body", "techjobs", t0),
            ("2", "for hire", None, "techjobs", t0 - dt.timedelta(days=356)),
            ("3", "Job", "looking for dev", "webdevjobs", t0 - dt.timedelta(days=357)),
            ("4", "x", "shire", "other", t0),
            ("5", "contract", "", "sysadminjobs", t0),
            ("6", "nothing", "here", "techjobs", t0)]
    return spark.createDataFrame(
        rows, "id string, title string, selftext string, subreddit string, created_utc timestamp")


def test_recent_keeps_boundary(spark):
    got = {r.id for r in ig.recent(_posts(spark), dt.datetime(2024, 1, 3), 356).collect()}
    assert got == {"1", "2", "4", "5", "6"}


def test_prepare_in_order(spark):
    ledger = spark.createDataFrame([("5",), ("5",)], "id string")
    out = ig.prepare(_posts(spark), ledger, dt.datetime(2024, 1, 3),
                     ["techjobs", "webdevjobs", "sysadminjobs"], limit=2)
    rows = {r.id: r for r in out.collect()}
    # techjobs newest two: 1 and 6 (2 is older); 6 is not relevant; 5 is seen; 3 too old
    assert set(rows) == {"1"}
    assert rows["1"].created_utc == "2024-01-03T00:00:00+00:00"
    assert ig.sent_counts(out).first()["sent"] == 1


def test_shape_record_fields(spark):
    shaped = ig.shape_record(_posts(spark))
    assert shaped.columns == ig.RECORD_COLUMNS
    assert all(f.dataType.simpleString() == "string" for f in shaped.schema.fields)


def test_union_sources(spark):
    p = _posts(spark)
    u = ig.union_sources([p.where("subreddit = 'techjobs'"), p.where("subreddit = 'other'")])
    assert u.count() == 4


def test_global_rank_is_consecutive_across_partitions(spark):
    rnd = random.Random(3)
    words = ["w" * rnd.randint(1, 6) + str(i) for i in range(3000)]
    df = spark.createDataFrame([(w,) for w in words], "skill string").repartition(7)
    ranked = global_rank(df, [F.desc(F.length("skill")), F.asc("skill")], "position")
    got = sorted((r.position, r.skill) for r in ranked.collect())
    want = sorted(words, key=lambda w: (-len(w), w))
    assert [p for p, _ in got] == list(range(1, len(words) + 1))
    assert [w for _, w in got] == want
