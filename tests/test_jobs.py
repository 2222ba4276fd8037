import datetime as dt

from poststream import jobs
from poststream.operators import ingest as ig
from poststream.operators import model as ml
from poststream.session import scratch_path
from poststream.sources import wire
from poststream.streaming import stream as st

TRAIN = ["python, aws,Backend", "react, css,Frontend", "python, django,Backend",
         "aws, terraform,Cloud", "react, typescript,Frontend", "python, docker,Backend",
         "css, html,Frontend", "terraform, gcp,Cloud"]


def _training_csv(tmp_path):
    rows = []
    for k in range(12):
        for line in TRAIN:
            *skills, cat = line.split(",")
            rows.append('"' + ",".join(skills) + f' {k}",{cat}')
    p = tmp_path / "train.csv"
    p.write_text("skills,category\n" + "\n".join(rows) + "\n")
    return str(p)


def test_train_then_classify_stream(spark, tmp_path):
    model = scratch_path(spark, "job-model")
    out = jobs.train(spark, _training_csv(tmp_path), model, parallelism=2)
    assert len(out["grid"]) == 4 and 0.0 <= out["accuracy"] <= 1.0

    lex = tmp_path / "skills.csv"
    lex.write_text("Skill\nPython\nAWS\nreact\ncss\n")
    t0 = dt.datetime(2024, 1, 1)
    posts = spark.createDataFrame(
        [("1", "Python dev", "AWS and more", "s", t0), ("2", "Nothing", "here", "s", t0)],
        "id string, title string, selftext string, subreddit string, created_utc timestamp")
    topic = scratch_path(spark, "job-topic")
    wire.encode_json(ig.shape_record(posts), binary=True).unionByName(
        spark.createDataFrame([("3", bytearray(b"{bad"))], "key string, value binary")) \
        .coalesce(1).write.parquet(topic)
    index, bad = scratch_path(spark, "job-index"), scratch_path(spark, "job-bad")
    q = jobs.classify(spark, str(lex), model, index, scratch_path(spark, "job-ckpt"),
                      source_format="parquet", source_path=topic, quarantine_path=bad,
                      trigger={"availableNow": True})
    q.awaitTermination()
    docs = {r.id: r for r in st.read_keyed(spark, index).collect()}
    assert list(docs["1"].skills_array) == ["python", "aws"]
    assert docs["2"].category == "other"
    assert [r.reason for r in st.read_log(spark, bad).collect()] == ["malformed json"]


def test_ingest_run_appends_ledger(spark):
    t0 = dt.datetime(2024, 1, 3)
    posts = spark.createDataFrame(
        [("1", "We are hiring", "x", "techjobs", t0), ("2", "hiring", "y", "techjobs", t0)],
        "id string, title string, selftext string, subreddit string, created_utc timestamp")
    ledger, out = scratch_path(spark, "job-ledger"), scratch_path(spark, "job-out")
    assert jobs.ingest(spark, posts, ledger, out, "2024-01-03 00:00:00") == 2
    assert jobs.ingest(spark, posts, ledger, out, "2024-01-03 00:00:00") == 0   # seen now
    assert spark.read.parquet(out).count() == 2


def test_ingest_loop_backfill_then_increments_and_survives_failure(spark):
    t0 = dt.datetime(2024, 1, 3)
    rows = [(str(i), f"hiring {i}", "x", "techjobs", t0 - dt.timedelta(minutes=i))
            for i in range(60)]
    posts = spark.createDataFrame(
        rows, "id string, title string, selftext string, subreddit string, created_utc timestamp")
    calls = []

    def read():
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("source down")
        return posts

    waits = []
    ledger, out = scratch_path(spark, "loop-ledger"), scratch_path(spark, "loop-out")
    sent = jobs.ingest_loop(spark, read, ledger, out, as_of=lambda: "2024-01-03 00:00:00",
                            sources=["techjobs"], runs=3, sleep=waits.append, every_seconds=60)
    assert sent == [60, 0]        # backfill took all 60; the increment finds nothing new
    assert waits == [60, 60, 60]
    assert spark.read.parquet(out).count() == 60


def test_options_reach_the_reader_and_the_sink():
    args = jobs.parser().parse_args(
        ["classify", "--lexicon", "l", "--model", "m", "--index", "predjob", "--bootstrap", "b:9092",
         "--max-per-trigger", "500", "--min-partitions", "8", "--sink-format", "some.index",
         "--sink-option", "es.nodes=n1"])
    opts = jobs.source_options(args)
    assert opts["maxOffsetsPerTrigger"] == "500" and opts["minPartitions"] == "8"
    assert args.sink_format == "some.index" and args.sink_option == ["es.nodes=n1"]
    assert st.index_options("predjob", options={"es.nodes": "n1"}) == {
        "es.resource": "predjob", "es.mapping.id": "id", "es.nodes": "n1"}


def test_chain_from_ingest_to_panels(spark, tmp_path):
    """ingest -> publish -> classify -> compact -> panels, from file to file."""
    t0 = dt.datetime(2024, 1, 3)
    posts = spark.createDataFrame(
        [("1", "hiring python", "aws", "techjobs", t0), ("2", "hiring react", "", "techjobs", t0),
         ("3", "hiring", "nobody", "techjobs", t0)],
        "id string, title string, selftext string, subreddit string, created_utc timestamp")
    path = {n: scratch_path(spark, f"chain-{n}") for n in
            ("ledger", "messages", "topic", "model", "index", "base", "panels", "pub", "ckpt")}
    assert jobs.ingest(spark, posts, path["ledger"], path["messages"], "2024-01-03 00:00:00") == 3
    now = {"availableNow": True}
    jobs.publish(spark, path["messages"], "parquet", {}, path["topic"], path["pub"],
                 trigger=now).awaitTermination()
    rows = spark.createDataFrame([(str(i), s, c) for i, (s, c) in enumerate(
        [("python, aws", "Backend"), ("react", "Frontend")] * 6)], "id string, skills string, category string")
    ml.save_model(ml.build_classifier(ml.fit_label_indexer(rows), max_iter=5).fit(rows), path["model"])
    lex = tmp_path / "skills.csv"
    lex.write_text("Skill\nPython\nAWS\nreact\n")
    topic = spark.read.parquet(path["topic"])
    assert topic.columns == ["key", "value"] and topic.count() == 3
    topic.select("key", topic.value.cast("binary").alias("value")).write.parquet(path["topic"] + "-b")
    jobs.classify(spark, str(lex), path["model"], path["index"], path["ckpt"],
                  source_format="parquet", source_path=path["topic"] + "-b", trigger=now).awaitTermination()
    assert jobs.compact(spark, path["index"], path["base"]) == 0
    got = jobs.panels(spark, path["index"], path["panels"])
    assert got["total_posts"] == 1 and got["top_skills"] == 3
    share = {r.category: r.posts for r in spark.read.json(path["panels"] + "/category_share").collect()}
    assert share == {"Backend": 1, "Frontend": 1, "other": 1}
