"""The keyed base by buckets and the panel counts kept by deltas."""
import os
import random

import pytest

from poststream import jobs
from poststream.operators import terms as tm
from poststream.session import delete_path, path_exists, scratch_path
from poststream.sources import buckets as bk
from poststream.streaming import deltas as dl
from poststream.streaming import stream as st

DOC = "id string, category string, skills_array array<string>, created_utc string"


def docs(spark, ids, category="a", skills=("x", "y"), minute=0):
    return spark.createDataFrame([(None if i is None else str(i), category, list(skills), f"t{minute}")
                                  for i in ids], DOC)


def files(base):
    base = base.removeprefix("file:")
    return {d: sorted(f for f in os.listdir(f"{base}/rows/{d}") if f.endswith(".parquet"))
            for d in os.listdir(f"{base}/rows") if d.startswith("bucket=")}


def paths(spark, *names):
    return [scratch_path(spark, f"k-{n}") for n in names]


def test_fold_rewrites_touched_buckets_only(spark):
    log, base = paths(spark, "log", "base")
    st.batch_writer(log)(docs(spark, range(200)), 0)
    assert st.fold_log(spark, log, base, buckets=16) == 0
    before = files(base)
    st.batch_writer(log)(docs(spark, [3, 500], "b"), 1)
    assert st.fold_log(spark, log, base) == 1           # the base knows its buckets
    after = files(base)
    moved = {d for d in after if after[d] != before.get(d)}
    assert 1 <= len(moved) <= 2 and len(after) > 10
    got = {r.id: r.category for r in st.read_keyed(spark, log, base=base).collect()}
    assert len(got) == 201 and got["3"] == got["500"] == "b" and got["4"] == "a"


def test_reading_and_folding_without_any_batch(spark):
    log, base, out = paths(spark, "log", "base", "panels")
    for n in range(2):
        st.batch_writer(log)(docs(spark, [n, 7]), n)
    assert jobs.compact(spark, log, base) == 1 and jobs.retire(spark, log, base) == 2
    assert st.batches(spark, log) == []
    assert jobs.panels(spark, log, out, base)["total_posts"] == 1
    assert jobs.compact(spark, log, base) == 1 and jobs.retire(spark, log, base) == 0
    assert sorted(r.id for r in st.read_keyed(spark, log, base=base).collect()) == ["0", "1", "7"]
    # a flat base of ``compact`` as well
    flat, = paths(spark, "flat")
    st.batch_writer(log)(docs(spark, [9]), 2)
    assert st.compact(spark, log, flat, base=base) == 2
    st.retire(spark, log, 2)
    assert st.read_keyed(spark, log, base=flat, since=2).count() == 4
    assert st.compact(spark, log, flat + "2", base=flat, since=2) == 2
    st.batch_writer(log)(docs(spark, [9], "late"), 3)
    assert jobs.compact(spark, log, base) == 3
    assert {r.category for r in st.read_keyed(spark, log, base=base).collect()} == {"a", "late"}


def test_log_without_batches_needs_a_schema(spark):
    with pytest.raises(ValueError, match="no batch"):
        st.read_log(spark, scratch_path(spark, "k-none"))


def test_interrupted_fold_is_finished_or_dropped(spark):
    log, base = paths(spark, "log", "base")
    st.batch_writer(log)(docs(spark, range(50)), 0)
    st.fold_log(spark, log, base, buckets=4)
    # prepared, then stopped with one folder already gone
    rows = bk.read(spark, base).withColumn("category", st.F.lit("new"))
    finish, bk.finish = bk.finish, lambda *a: None
    try:
        bk.replace(spark, base, rows, 1, 4)
    finally:
        bk.finish = finish
    gone = next(iter(files(base)))
    delete_path(spark, f"{base}/rows/{gone}")
    assert bk.finish(spark, base) and bk.state(spark, base).since == 1
    got = st.read_keyed(spark, log, base=base).collect()
    assert len(got) == 50 and {r.category for r in got} == {"new"}
    # stopped before it was fully prepared: nothing changes
    bk.read(spark, base).limit(3).write.partitionBy(bk.BUCKET).parquet(f"{base}/_pending/rows")
    assert not bk.finish(spark, base)
    assert st.read_keyed(spark, log, base=base).count() == 50 and not path_exists(spark, f"{base}/_pending")


def test_missing_keys_and_several_key_columns(spark):
    log, base = paths(spark, "log", "base")
    st.batch_writer(log)(docs(spark, [None, 1, 1]), 0)
    st.fold_log(spark, log, base, buckets=4)
    st.batch_writer(log)(docs(spark, [None, 2], "b"), 1)
    now = {r.id: r.category for r in st.read_keyed(spark, log, base=base).collect()}
    assert now == {None: "b", "1": "a", "2": "b"}
    st.fold_log(spark, log, base)
    assert {r.id: r.category for r in bk.read(spark, base).collect()} == now
    log2, base2 = paths(spark, "log", "base")
    st.batch_writer(log2)(docs(spark, [1, 2]), 0)
    st.fold_log(spark, log2, base2, key=["id", "category"])
    st.batch_writer(log2)(docs(spark, [1], "b"), 1)
    assert st.read_keyed(spark, log2, ["id", "category"], base=base2).count() == 3


def recount(spark, log, base):
    now = st.read_keyed(spark, log, base=base)
    return sorted(dl.signed_counts(now, now.limit(0)).collect(), key=str)


def test_deltas_equal_a_recount(spark):
    log, deltas, base, sums = paths(spark, "log", "deltas", "base", "sums")
    rng = random.Random(4)
    write = dl.delta_writer(log, deltas, base)
    for n in range(6):
        made = [(str(rng.randint(0, 30)) if rng.random() > 0.1 else None,
                 rng.choice(["a", "b", None]), rng.choices(["x", "y", "z", None], k=rng.randint(0, 3)),
                 f"t{rng.randint(0, 9)}") for _ in range(20)]
        batch = spark.createDataFrame(made, DOC)
        write(batch, n)
        write(batch, n)                                  # replayed
        assert sorted(dl.read_counts(spark, deltas, sums).collect(), key=str) == recount(spark, log, base)
        if n in (1, 3):
            assert st.fold_log(spark, log, base, buckets=4) == n
            st.retire(spark, log, n)
            assert dl.fold_deltas(spark, deltas, sums) == n
            write(docs(spark, [1], "folded already"), n)
    assert dl.fold_deltas(spark, deltas, sums) == 5 and st.batches(spark, deltas) == []
    assert sorted(dl.read_counts(spark, deltas, sums).collect(), key=str) == recount(spark, log, base)
    assert dl.fold_deltas(spark, deltas, sums) == 5


def test_total_share_and_top_lists_read_no_index(spark):
    log, deltas = paths(spark, "log", "deltas")
    write = dl.delta_writer(log, deltas)
    write(docs(spark, range(9)), 0)
    write(docs(spark, [1, 2], "b", ["z"]), 1)
    counts, index = dl.read_counts(spark, deltas), st.read_keyed(spark, log)
    got = tm.panels(index, counts=counts, store=False)
    assert got["total_posts"].first()[0] == 9
    assert [(r.category, r.posts) for r in got["category_share"].collect()] == [("a", 7), ("b", 2)]
    tops = tm.top_terms(index, "skills_array", 3, other=False, name="skill",
                        counts=tm._values_of(counts, "skill", "skill"))  # noqa: SLF001
    assert [(r.skill, r.posts) for r in tops.collect()] == [("x", 7), ("y", 7), ("z", 2)]
    for df in (got["total_posts"], got["category_share"], tops):
        read = [f.split("/k-")[1].split("-")[0] for f in df.inputFiles()]
        assert set(read) == {"deltas"}
    for name, df in tm.panels(index, store=False).items():
        assert [tuple(r) for r in got[name].collect()] == [tuple(r) for r in df.collect()]


def test_jobs_keep_and_use_the_deltas(spark):
    log, deltas, base, sums, out = paths(spark, "log", "deltas", "base", "sums", "out")
    write = dl.delta_writer(log, deltas, base)
    write(docs(spark, range(5)), 0)
    assert jobs.compact(spark, log, base, 4, deltas, sums) == 0
    write(docs(spark, [1], "b"), 1)
    rows = jobs.panels(spark, log, out, base, deltas, sums)
    assert rows["category_share"] == 2
    share = {r.category: r.posts for r in spark.read.json(out + "/category_share").collect()}
    assert share == {"a": 4, "b": 1}


def test_replace_moves_the_prepared_files(spark, tmp_path):
    """The prepared buckets are moved into their places, not written a second time;
    what an interrupted move has left is brought in by the next one."""
    path = str(tmp_path / "table")
    rows = spark.range(200).selectExpr("id", "cast(id % 4 AS int) AS bucket")
    done, bk.finish = bk.finish, lambda *a: False
    try:
        bk.replace(spark, path, rows, 1, 4)
    finally:
        bk.finish = done
    names = {p.name for p in (tmp_path / "table/_pending/rows").rglob("*.parquet")}
    bk.move_folder(spark, f"{path}/_pending/rows/bucket=2", f"{path}/rows/bucket=2")    # stopped here
    assert bk.finish(spark, path) and not bk.finish(spark, path)
    assert {p.name for p in (tmp_path / "table/rows").rglob("*.parquet")} == names
    assert sorted(r.id for r in bk.read(spark, path).collect()) == list(range(200))
    bk.replace(spark, path, rows.where("bucket = 1").limit(3), 2, 4)
    assert bk.read(spark, path).count() == 153 and bk.state(spark, path).since == 2
