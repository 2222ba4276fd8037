import duckdb
import pandas as pd

from poststream.llm import mixing


def _sorted(df):
    return sorted(map(tuple, df.astype(object).where(df.notna(), None).itertuples(index=False)), key=repr)


def test_mix_equals_sql_and_mixed_repeats(docs, rows):
    got = mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken").toPandas()
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(
        {"doc_id": pd.array([r["doc_id"] for r in rows], "Int64"),
         "text": [r["text"] for r in rows], "source": [r["source"] for r in rows]}))
    want = con.sql(mixing.MIX_SQL).df()[got.columns]
    got["doc_id"] = got["doc_id"].astype("Int64")
    want["doc_id"] = want["doc_id"].astype("Int64")
    assert _sorted(got) == _sorted(want)
    assert (got["taken"] <= 3 * got["size"]).all()
    whole = mixing.mixed(docs)
    assert whole.columns == docs.columns
    words = mixing.sized(whole).agg({"size": "sum"}).first()[0]
    assert words == got["taken"].sum()


def test_caps_share_the_excess(spark):
    sized = spark.createDataFrame(
        [(1, "a", 10, 5), (2, "b", 10, 6), (3, "c", 1000, 7)],
        "doc_id long, source string, size long, hash long")
    goals = {r["source"]: r["target"] for r in mixing.targets(sized).collect()}
    # c weighs 3: 1020 shared by 1, 2, 3; a and b stop at 30
    assert goals == {"a": 30.0, "b": 30.0, "c": 960.0}


def test_budgets_nest(spark):
    sized = spark.range(300).selectExpr(
        "id as doc_id", "'s' as source", "id % 7 as size", "cast(conv(substring(md5(string(id)), 1, 15), 16, 10) as long) as hash")
    def taken(budget):
        goals = spark.createDataFrame([("s", 10_000, float(budget))],
                                      "source string, source_size long, target double")
        t = mixing.thresholds(sized, goals).first()["threshold"]
        return {r["doc_id"] for r in sized.where(f"hash <= {t}").where("size > 0").collect()}
    small, large = taken(100), taken(400)
    assert small < large
    assert abs(sum(i % 7 for i in small) - 100) <= 3 and abs(sum(i % 7 for i in large) - 400) <= 3


def test_targets_are_met_where_ids_are_missing_or_equal(spark):
    rows = [(None if i % 3 == 0 else i % 50 if i % 3 == 1 else i, f"s{i % 4}", f"word{i} " * (1 + i % 9))
            for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(docs).groupBy("source", "target").agg({"taken": "sum"}).collect()
    assert len(got) == 4
    for r in got:
        assert abs(r["sum(taken)"] - r["target"]) <= 0.01 * r["target"]


def test_empty(no_docs):
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed(no_docs).count() == 0
