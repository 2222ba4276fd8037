"""Per-source folders, run metrics, and the training CSV."""
from pyspark.sql import functions as F

from poststream.operators import ingest as ig
from poststream.session import scratch_path
from poststream.sources.files import read_sources, read_training
from poststream.streaming import metrics as mx


def test_sources_with_differing_columns_and_a_broken_one(spark, tmp_path):
    root = str(tmp_path)
    put = lambda name, df: df.write.parquet(f"{root}/subreddit={name}")
    put("a", spark.createDataFrame([("1", "x")], "id string, title string"))
    put("b", spark.createDataFrame([("2", 5)], "id string, score int"))
    put("7", spark.createDataFrame([(3, "z")], "id long, title string"))
    (tmp_path / "subreddit=bad").mkdir()
    (tmp_path / "subreddit=bad" / "part-0.parquet").write_text("garbage")
    put("unused", spark.createDataFrame([("9",)], "id string"))
    frames, broken = read_sources(spark, root, ["a", "b", "7", "bad", "gone"])
    assert set(broken) == {"bad", "gone"} and "gone" in broken["gone"]
    assert len(frames) == 2                       # one scan, and one whose types differ
    got = ig.union_sources(frames)
    assert {tuple(r) for r in got.select("id", "title", "score", "subreddit").collect()} == {
        ("1", "x", None, "a"), ("2", None, 5, "b"), ("3", "z", None, "7")}
    assert read_sources(spark, root, ["gone"]) == ([], {"gone": "no folder subreddit=gone"})


def test_metrics_of_each_batch(spark):
    topic, path = scratch_path(spark, "m-in"), scratch_path(spark, "m-table")
    listener = mx.SentMetrics(spark, path, ["a", "b"])
    spark.streams.addListener(listener)
    try:
        for batch in (["a", "a", "b"], ["c", None, "b"]):
            spark.createDataFrame([(s,) for s in batch], "subreddit string").coalesce(1).write.mode(
                "append").parquet(topic)
        raw = spark.readStream.schema("subreddit string").option("maxFilesPerTrigger", 1).parquet(topic)
        q = (mx.observe_sources(raw, ["a", "b"]).writeStream.format("noop")
             .option("checkpointLocation", scratch_path(spark, "m-ckpt")).trigger(availableNow=True).start())
        q.awaitTermination()
        assert listener.wait(q) and not listener.errors
    finally:
        spark.streams.removeListener(listener)
    got = mx.read_metrics(spark, path)
    assert got.select("batch_id", "query").distinct().count() == 2
    assert {r["source"]: r["n"] for r in got.groupBy("source").agg(F.sum("sent").alias("n")).collect()} == {
        "a": 2, "b": 2, None: 2}


def test_training_csv_with_quotes_and_line_breaks(spark, tmp_path):
    p = tmp_path / "train.csv"
    p.write_text('skills,category\n"a, ""b""\nc",X\n"d",Y\n')
    got = [tuple(r) for r in read_training(spark, str(p), multi_line=True).collect()]
    assert got == [('a, "b"\nc', "X"), ("d", "Y")]
