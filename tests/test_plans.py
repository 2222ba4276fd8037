"""Plan-shape guards: the properties that matter at scale, checked on the
optimized / physical plans rather than on timings."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from poststream.operators import ingest as ig
from poststream.operators import model as ml
from poststream.operators import terms as tm
from poststream.operators.topn import top_n_per_group
from poststream.plans import dashboard as db
from poststream.plans import fixtures as fx
from poststream.session import scratch_path
from poststream.sources import wire
from poststream.streaming import stream as st


def explain(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001


@pytest.fixture()
def no_broadcast_no_aqe(spark):
    old = {k: spark.conf.get(k) for k in ["spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.enabled"]}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # as with 100 TB inputs
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def test_regex_runs_once_under_filters_on_derived_columns(spark):
    idx = db.index(spark, SF_SMALL)
    for df in [idx.where(F.col("category") == "en"),
               ml.drop_missing(ml.training_rows(idx))]:
        assert optimized(df).count("regexp_extract_all") == 1


def test_json_parsed_once(spark):
    path = scratch_path(spark, "plan-msgs")
    spark.createDataFrame([("1", '{"id":"1"}')], "key string, value string").write.parquet(path)
    good, bad = wire.decode_json(spark.read.parquet(path))
    assert optimized(good).count("from_json") == 1
    assert optimized(bad).count("from_json") == 1


def test_join_with_events_does_not_shuffle_text(no_broadcast_no_aqe):
    spark = no_broadcast_no_aqe
    df = db.index(spark, SF_SMALL).select("id", "category", "created_utc", "skills_array")
    plan = explain(df)
    blocks = re.findall(r"\(\d+\) Exchange\s*\nInput \[\d+\]: \[([^\]]*)\]\s*\nArguments: "
                        r"hashpartitioning\((\w+)#", plan)
    assert {key for _, key in blocks} == {"doc_id", "event_id"}
    for cols, _ in blocks:
        assert "text#" not in cols


def test_top_n_per_group_limits_before_each_shuffle(no_broadcast_no_aqe):
    spark = no_broadcast_no_aqe
    df = fx.posts(spark, SF_SMALL)
    out = top_n_per_group(df, ["subreddit"], [F.col("created_utc").desc(), F.col("id")], 10,
                          salt_on=["id"])
    plan = explain(out)
    partial = [m.start() for m in re.finditer(r"row_number\(\), 10, Partial", plan)]
    assert len(partial) == 2


def test_latest_per_id_picks_winners_on_narrow_rows(no_broadcast_no_aqe):
    spark = no_broadcast_no_aqe
    path = scratch_path(spark, "plan-log")
    fx.posts(spark, SF_SMALL).select("id", "title", "selftext", "created_utc") \
        .withColumn("batch_id", F.lit(0)).write.parquet(path)
    plan = explain(st.latest_per_id(spark.read.parquet(path)))
    assert "SortAggregate" not in plan and "row_number(), 1, Partial" in plan
    exchanges = re.findall(r"\(\d+\) Exchange\s*\nInput \[\d+\]: \[([^\]]*)\]", plan)
    assert [("selftext#" in cols) for cols in exchanges].count(True) == 1   # rows come back once


def test_unseen_lets_a_hot_id_be_split(spark):
    keep = {k: spark.conf.get(k) for k in (
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        for k, v in zip(keep, ("-1", "20k", "2", "10k")):
            spark.conf.set(k, v)
        posts = spark.range(200_000).selectExpr(
            "if(id % 5 < 4, 'hot', string(id)) as id", "md5(string(id)) as title").repartition(16)
        ledger = spark.range(50_000).selectExpr("string(id * 3) as id")
        df = ig.unseen(posts, ledger)
        assert df.where("id = 'hot'").count() == 160_000
        df.collect()
        assert "SortMergeJoin(skew=true)" in explain(df, "simple")
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_panels_shuffle_counts_not_arrays(no_broadcast_no_aqe):
    spark = no_broadcast_no_aqe
    got = tm.panels(db.panel_index(spark, SF_SMALL), store=False)
    for name, df in got.items():
        plan = explain(df)
        assert "regexp_extract_all" not in plan, name      # reads the stored index
        for cols in re.findall(r"\(\d+\) Exchange\s*\nInput \[\d+\]: \[([^\]]*)\]", plan):
            assert "skills_array" not in cols and "_values" not in cols, (name, cols)


def test_panel_shuffle_is_bounded_by_the_lexicon(spark):
    """1,000 posts with sets of a 500-term lexicon: pairs, not posts, are shuffled."""
    posts = spark.range(20_000).selectExpr(
        "concat('c', id % 3) as category",
        "transform(sequence(0, 4), i -> concat('t', (id * 31 + i * i * 17 + id div 7) % 500)) "
        "as skills_array").repartition(4)
    counts = tm.nested_terms(posts, "category", "skills_array", 7, 20)
    assert counts.count() == 3 * 21
    part = posts.select("category", F.explode("skills_array").alias("t")).groupBy("category", "t").count()
    assert part.count() <= 3 * 500


def _exchanged(plan):
    return re.findall(r"\(\d+\) Exchange\s*\nInput \[\d+\]: \[([^\]]*)\]\s*\nArguments: "
                      r"hashpartitioning\((\w+)#", plan)


def test_ingest_shuffles_narrow_rows(no_broadcast_no_aqe, monkeypatch):
    captured = []
    monkeypatch.setattr(ig, "stored", lambda df: captured.append(df) or df)
    spark = no_broadcast_no_aqe
    ledger = fx.table(spark, SF_SMALL, "labels").select(F.col("doc_id").cast("string").alias("id"))
    ig.prepare(fx.timed(spark, SF_SMALL), ledger, fx.AS_OF, fx.SOURCES, fx.KEYWORDS,
               texts=fx.texts(spark, SF_SMALL))
    assert set(captured[0].columns) == {"id", "subreddit", "created_utc"}
    blocks = _exchanged(explain(captured[0]))
    assert sum(key == "subreddit" for _, key in blocks) == 2    # salted stage and final stage
    for cols, _ in blocks:
        assert "title#" not in cols and "selftext#" not in cols and "text#" not in cols


def test_ingest_texts_meet_the_survivors_without_a_time_join(spark):
    from poststream.plans.registry import QUERIES
    plan = explain(QUERIES["ingest_batch"](spark, SF_SMALL))
    assert "events.parquet" not in plan          # decided before, on narrow rows
    assert plan.count("documents.parquet") == 1


@pytest.mark.parametrize("name", ["post_text", "clean_text", "keyword_hits", "truncate_body",
                                  "title_preview", "relevant_posts"])
def test_text_queries_shuffle_nothing(no_broadcast_no_aqe, name):
    from poststream.plans.registry import QUERIES
    assert "Exchange" not in explain(QUERIES[name](no_broadcast_no_aqe, SF_SMALL))
