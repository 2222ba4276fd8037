import datetime as dt

from poststream.operators import terms as tm

SCHEMA = "id string, category string, skills_array array<string>, created_utc timestamp"


def _idx(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _posts(spark):
    t = dt.datetime(2024, 1, 1)
    return _idx(spark, [("1", "x", ["a", "a", "b"], t), ("2", "x", ["a"], t),
                        ("3", "y", [], t), ("4", None, None, t)])


def test_posts_versus_occurrences(spark):
    df = _posts(spark)
    top = {r.skill: r.posts for r in tm.top_terms(df, "skills_array", 10, name="skill").collect()}
    occ = {r.skill: r.occurrences for r in tm.occurrences(df, "skills_array", "skill").collect()}
    assert top == {"a": 2, "b": 1}
    assert occ == {"a": 3, "b": 1}


def test_total_posts_null_when_empty(spark):
    assert tm.total_posts(_posts(spark)).first()[0] == 4
    assert tm.total_posts(_posts(spark).where("id = 'none'")).first()[0] is None


def test_rest_bucket_of_arrays_counts_posts_without_top_terms(spark):
    t = dt.datetime(2024, 1, 1)
    df = _idx(spark, [("1", "x", ["a", "b"], t), ("2", "x", ["a", "c"], t),
                      ("3", "x", ["c", "d"], t), ("4", "x", ["d"], t), ("5", "x", ["a"], t)])
    got = {r.skill: (r.posts, r.rank)
           for r in tm.top_terms(df, "skills_array", 1, name="skill").collect()}
    # a is top (3 posts); posts 3 and 4 have terms but no 'a'
    assert got == {"a": (3, 1), "__other__": (2, 2)}


def test_rest_bucket_of_plain_column_and_share(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(str(i), c, [], t) for i, c in enumerate("aaabbc")]
    got = {r.category: (r.posts, r.share)
           for r in tm.top_terms(_idx(spark, rows), "category", 2, share=True).collect()}
    assert got == {"a": (3, 0.5), "b": (2, 0.333333), "__other__": (1, 0.166667)}


def test_no_rest_row_when_everything_is_top(spark):
    got = tm.top_terms(_posts(spark), "category", 5).collect()
    assert {r.category for r in got} == {"x", "y"}


def test_nested_terms(spark):
    t = dt.datetime(2024, 1, 1)
    df = _idx(spark, [("1", "x", ["a", "b"], t), ("2", "x", ["a"], t), ("3", "x", ["b", "c"], t),
                      ("4", "y", ["c"], t), ("5", "z", ["c"], t), ("6", "z", [], t)])
    got = {(r.category, r.skill): r.posts for r in
           tm.nested_terms(df, "category", "skills_array", 2, 1, inner_name="skill").collect()}
    # top categories: x (3 posts), z (2) ; y goes to the rest bucket
    assert got == {("x", "a"): 2, ("x", "__other__"): 1, ("z", "c"): 1,
                   ("__other__", "c"): 1}


def test_trend_and_options(spark):
    rows = [("1", "en", ["a"], dt.datetime(2024, 1, 1, 0, 5)),
            ("2", "en", ["a", "a"], dt.datetime(2024, 1, 1, 0, 55)),
            ("3", "es", ["b"], dt.datetime(2024, 1, 1, 1, 0)),
            ("4", "fr", ["b"], dt.datetime(2024, 1, 1, 1, 0))]
    df = _idx(spark, rows)
    trend = {(r.bucket.hour, r.category): r.posts
             for r in tm.trend(df, "created_utc", "1 hour", by="category").collect()}
    assert trend == {(0, "en"): 2, (1, "es"): 1, (1, "fr"): 1}
    sk = {(r.bucket.hour, r.skill): r.posts
          for r in tm.trend(df, "created_utc", "1 hour", by="skills_array", name="skill").collect()}
    assert sk == {(0, "a"): 2, (1, "b"): 2}
    opts = {r.category: r.posts for r in tm.term_options(df, "category", "E").collect()}
    assert opts == {"en": 2, "es": 1}


def test_time_slice_fraction_bounds(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(str(h), "x", [], base + dt.timedelta(hours=h)) for h in range(0, 9)]
    df = _idx(spark, rows)
    got = sorted(int(r.id) for r in tm.time_slice(df, "created_utc", 0.25, 0.75).collect())
    assert got == [2, 3, 4, 5]          # [min + 2h, min + 6h)
    for lo, hi in ((0.0, 1.0), (-0.00155, 1.00062)):      # the newest post belongs to the range
        assert tm.time_slice(df, "created_utc", lo, hi).count() == 9
    chosen = tm.panel_filter(df, "created_utc", 0.0, 1.0, "category", ["y"]).count()
    assert chosen == 0
    assert tm.choose(df, "category", []).count() == 9


def test_panels_equal_single_panels(spark):
    from conftest import SF_SMALL
    from poststream.plans import dashboard as db
    idx = db.panel_index(spark, SF_SMALL)
    got = tm.panels(idx)

    def rows(df):
        return sorted(tuple(r) for r in df.collect())

    assert rows(got["top_skills"]) == rows(tm.top_terms(idx, "skills_array", 30, name="skill"))
    assert rows(got["category_share"]) == rows(tm.top_terms(idx, "category", 8, share=True))
    assert rows(got["category_skill_treemap"]) == rows(
        tm.nested_terms(idx, "category", "skills_array", 7, 20, share=True, inner_name="skill"))
    assert rows(got["category_skill_bars"]) == rows(
        tm.nested_terms(idx, "category", "skills_array", 7, 30, inner_name="skill"))
    assert got["total_posts"].first()[0] == tm.total_posts(idx).first()[0]


def test_outputs_come_in_display_order(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(str(i), c, [s], t) for i, (c, s) in enumerate(zip("aaabbcd", "xxyyzzw"))]
    df = _idx(spark, rows)
    ranks = [r.rank for r in tm.top_terms(df, "category", 2).collect()]
    assert ranks == sorted(ranks) and ranks[-1] == 3          # rest bucket last
    opts = [r.category for r in tm.term_options(df, "category").collect()]
    assert opts == ["a", "b", "c", "d"]
