"""Queries: text functions, lexicon, enrichment and the dashboard panels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..defaults import (BARS_SIZES, CATEGORY_PIE_SIZE, CSV_MISSING_MARKERS, SKILL_CLOUD_SIZE,
                        TREEMAP_SIZES)
from ..functions.text import clean_text, post_text, skill_matcher, skills_text
from ..operators import lexicon as lx
from ..operators import terms as tm
from ..operators.enrich import ENRICHED_COLUMNS, category_override, with_skills
from ..session import scratch_path, stored
from ..streaming import deltas as dl
from ..streaming import stream as st
from . import fixtures as fx
from .registry import query

MATCHER = skill_matcher(fx.LEXICON)

PRELUDE = f"""WITH {fx.POSTS_CTE},
txt AS (SELECT *, concat_ws(' ', title, selftext) AS text FROM posts),
sk AS (SELECT *, {fx.duck_skills('text')} AS skills_array FROM txt),
idx AS (SELECT CASE WHEN len(skills_array) = 0 THEN 'other' ELSE category END AS category,
               id, title, selftext, created_utc, skills_array, subreddit, category AS label
        FROM sk)"""


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched posts with the fixture label standing in for the model's
    prediction (the model itself has its own queries).  Skills are extracted
    on the document side; the event join then moves arrays, not texts, unless
    the caller keeps title or body."""
    docs = fx.doc_posts(spark, sf_dir).withColumn("label", F.col("category"))
    enriched = category_override(with_skills(docs, MATCHER, text="text"), "category")
    idx = fx.with_time(enriched.select("doc_id", "id", "title", "selftext", "subreddit",
                                       "label", "category", "skills_array"), spark, sf_dir)
    return idx.select(*ENRICHED_COLUMNS, "subreddit", "label")


def panel_index(spark: SparkSession, sf_dir: str,
                columns: tuple[str, ...] = ("category", "skills_array")) -> DataFrame:
    """The columns that a panel reads, as a stored table: panels go over
    it twice, and the skills are extracted once."""
    return stored(index(spark, sf_dir).select(*columns), "panel-index")


# ----------------------------------------------------------------- text ----

@query("post_text", PRELUDE + " SELECT id, text FROM txt")
def q_post_text(spark, sf_dir):
    return fx.texts(spark, sf_dir).select("id", post_text("title", "selftext").alias("text"))


@query("clean_text", PRELUDE + f" SELECT id, {fx.duck_clean('text')} AS clean FROM txt")
def q_clean_text(spark, sf_dir):
    return fx.texts(spark, sf_dir).select(
        "id", clean_text(post_text("title", "selftext")).alias("clean"))


@query("extract_skills", PRELUDE + " SELECT id, skills_array FROM sk")
def q_extract_skills(spark, sf_dir):
    return index(spark, sf_dir).select("id", "skills_array")


@query("lexicon_match_join", PRELUDE + " SELECT id, skills_array FROM sk")
def q_lexicon_match_join(spark, sf_dir):
    """The same matches with the lexicon as a table."""
    lexicon = spark.createDataFrame([(t,) for t in fx.LEXICON], "skill string")
    return lx.match_by_join(fx.doc_posts(spark, sf_dir).select("id", "text"), lexicon)


@query("skills_text", PRELUDE + " SELECT id, array_to_string(skills_array, ', ') AS skills FROM sk")
def q_skills_text(spark, sf_dir):
    return index(spark, sf_dir).select("id", skills_text("skills_array").alias("skills"))


@query("category_override", PRELUDE + " SELECT id, category FROM idx")
def q_category_override(spark, sf_dir):
    return index(spark, sf_dir).select("id", "category")


@query("enriched_posts", PRELUDE + """ SELECT category, id, title, selftext, created_utc,
 skills_array FROM idx""")
def q_enriched_posts(spark, sf_dir):
    return index(spark, sf_dir).select("category", "id", "title", "selftext", "created_utc",
                                       "skills_array")


# -------------------------------------------------------------- lexicon ----

def _raw_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw lexicon table derived from the documents: the first word of every
    title, under a header that needs normalising (' Skill ')."""
    return fx.texts(spark, sf_dir).select(
        F.substring_index(F.col("title"), " ", 1).alias(" Skill "))


_MARKERS_SQL = ", ".join("'" + m.replace("'", "''") + "'" for m in CSV_MISSING_MARKERS)

RAW_LEXICON_SQL = f"""WITH {fx.POSTS_CTE},
raw AS (SELECT string_split(title, ' ')[1] AS skill FROM posts),
lex AS (SELECT DISTINCT lower(skill) AS skill FROM raw
        WHERE skill IS NOT NULL AND skill NOT IN ({_MARKERS_SQL}))"""


@query("lexicon_load", RAW_LEXICON_SQL + " SELECT skill FROM lex")
def q_lexicon_load(spark, sf_dir):
    return lx.load_lexicon(_raw_lexicon(spark, sf_dir))


@query("lexicon_size", RAW_LEXICON_SQL + " SELECT count(DISTINCT skill) AS lexicon_size FROM lex")
def q_lexicon_size(spark, sf_dir):
    return lx.lexicon_size(lx.load_lexicon(_raw_lexicon(spark, sf_dir)))


@query("lexicon_order", RAW_LEXICON_SQL + """ SELECT skill,
 row_number() OVER (ORDER BY length(skill) DESC, skill) AS position FROM lex""")
def q_lexicon_order(spark, sf_dir):
    return lx.order_terms(lx.load_lexicon(_raw_lexicon(spark, sf_dir)))


_LEX_VALUES = ", ".join("('" + t.replace("'", "''") + "')" for t in fx.LEXICON)


@query("lexicon_coverage", PRELUDE + f""",
lexicon(skill) AS (VALUES {_LEX_VALUES}),
counts AS (SELECT skill, count(*) AS posts
           FROM (SELECT unnest(list_distinct(skills_array)) AS skill FROM idx) GROUP BY skill)
SELECT l.skill, CAST(coalesce(c.posts, 0) AS BIGINT) AS posts
FROM lexicon l LEFT JOIN counts c USING (skill)""")
def q_lexicon_coverage(spark, sf_dir):
    lexicon = spark.createDataFrame([(t,) for t in fx.LEXICON], "skill string")
    return lx.lexicon_coverage(index(spark, sf_dir), lexicon)


# --------------------------------------------------------------- panels ----

@query("total_posts", PRELUDE + " SELECT nullif(count(*), 0) AS total_posts FROM idx")
def q_total_posts(spark, sf_dir):
    # the index holds one row per post; counting needs no skill extraction
    return tm.total_posts(fx.posts(spark, sf_dir))


def _top_sql(src: str, col: str, name: str, n: int, share: bool, multi: bool) -> str:
    if multi:
        counts = (f"SELECT {name}, count(*) AS posts FROM (SELECT unnest(list_distinct("
                  f"list_filter({col}, lambda x: x IS NOT NULL))) AS {name} FROM {src}) GROUP BY {name}")
        rest = (f"SELECT '__other__' AS {name}, count(*) AS posts, {n + 1} AS rank FROM {src} "
                f"WHERE len(list_filter({col}, lambda x: x IS NOT NULL)) > 0 AND NOT "
                f"list_has_any({col}, (SELECT coalesce(list({name}), []) FROM top))")
    else:
        counts = (f"SELECT {col} AS {name}, count(*) AS posts FROM {src} "
                  f"WHERE {col} IS NOT NULL GROUP BY {col}")
        rest = (f"SELECT '__other__' AS {name}, (SELECT count({col}) FROM {src}) - "
                f"(SELECT coalesce(sum(posts), 0) FROM top) AS posts, {n + 1} AS rank")
    body = f"""counts AS ({counts}),
top AS (SELECT {name}, posts, row_number() OVER (ORDER BY posts DESC, {name}) AS rank
        FROM counts QUALIFY rank <= {n}),
rest AS ({rest}),
panel AS (SELECT {name}, posts, CAST(rank AS INTEGER) AS rank FROM top
          UNION ALL SELECT {name}, CAST(posts AS BIGINT), CAST(rank AS INTEGER) FROM rest
          WHERE posts > 0)"""
    final = (f"SELECT {name}, posts, rank, round(posts / sum(posts) OVER (), 6) AS share FROM panel"
             if share else f"SELECT {name}, posts, rank FROM panel")
    return body + "\n" + final


@query("top_skills", PRELUDE + ",\n" + _top_sql("idx", "skills_array", "skill",
                                                SKILL_CLOUD_SIZE, False, True))
def q_top_skills(spark, sf_dir):
    return tm.top_terms(panel_index(spark, sf_dir, ("skills_array",)), "skills_array", SKILL_CLOUD_SIZE,
                        name="skill")


@query("category_share", PRELUDE + ",\n" + _top_sql("idx", "category", "category",
                                                    CATEGORY_PIE_SIZE, True, False))
def q_category_share(spark, sf_dir):
    return tm.top_terms(index(spark, sf_dir), "category", CATEGORY_PIE_SIZE, share=True)


def _nested_sql(src: str, n_outer: int, n_inner: int, share: bool) -> str:
    body = f"""ocounts AS (SELECT category, count(*) AS posts FROM {src}
            WHERE category IS NOT NULL GROUP BY category),
otop AS (SELECT category FROM ocounts ORDER BY posts DESC, category LIMIT {n_outer}),
based AS (SELECT CASE WHEN category IN (SELECT category FROM otop) THEN category
                      ELSE '__other__' END AS category,
                 list_distinct(list_filter(skills_array, lambda x: x IS NOT NULL)) AS vals
          FROM {src} WHERE category IS NOT NULL),
counts AS (SELECT category, skill, count(*) AS posts
           FROM (SELECT category, unnest(vals) AS skill FROM based) GROUP BY category, skill),
top AS (SELECT category, skill, posts,
               row_number() OVER (PARTITION BY category ORDER BY posts DESC, skill) AS rank
        FROM counts QUALIFY rank <= {n_inner}),
tops AS (SELECT category, list(skill) AS tl FROM top GROUP BY category),
rest AS (SELECT b.category, '__other__' AS skill, count(*) AS posts, {n_inner + 1} AS rank
         FROM based b LEFT JOIN tops t ON b.category = t.category
         WHERE len(b.vals) > 0 AND NOT coalesce(list_has_any(b.vals, t.tl), false)
         GROUP BY b.category),
panel AS (SELECT category, skill, posts, CAST(rank AS INTEGER) AS rank FROM top
          UNION ALL SELECT category, skill, posts, CAST(rank AS INTEGER) FROM rest)"""
    final = ("SELECT category, skill, posts, rank, round(posts / sum(posts) OVER (), 6) AS share "
             "FROM panel" if share else "SELECT category, skill, posts, rank FROM panel")
    return body + "\n" + final


@query("category_skill_treemap", PRELUDE + ",\n" + _nested_sql("idx", *TREEMAP_SIZES, True))
def q_category_skill_treemap(spark, sf_dir):
    return tm.nested_terms(panel_index(spark, sf_dir), "category", "skills_array",
                           *TREEMAP_SIZES, share=True, inner_name="skill")


@query("category_skill_bars", PRELUDE + ",\n" + _nested_sql("idx", *BARS_SIZES, False))
def q_category_skill_bars(spark, sf_dir):
    return tm.nested_terms(panel_index(spark, sf_dir), "category", "skills_array",
                           *BARS_SIZES, inner_name="skill")


@query("category_options", PRELUDE + f""" SELECT category, count(*) AS posts FROM idx
 WHERE category IS NOT NULL AND starts_with(lower(category), '{fx.OPTION_PREFIX}')
 GROUP BY category""")
def q_category_options(spark, sf_dir):
    return tm.term_options(index(spark, sf_dir), "category", prefix=fx.OPTION_PREFIX)


@query("skill_occurrences", PRELUDE + """ SELECT skill, count(*) AS occurrences
 FROM (SELECT unnest(skills_array) AS skill FROM idx) WHERE skill IS NOT NULL GROUP BY skill""")
def q_skill_occurrences(spark, sf_dir):
    return tm.occurrences(index(spark, sf_dir), "skills_array", name="skill")


@query("category_trend", PRELUDE + """ SELECT date_trunc('hour', created_utc) AS bucket, category,
 count(*) AS posts FROM idx GROUP BY ALL""")
def q_category_trend(spark, sf_dir):
    return tm.trend(index(spark, sf_dir), "created_utc", fx.TREND_EVERY, by="category")


@query("skill_trend", PRELUDE + """ SELECT bucket, skill, count(*) AS posts FROM (
 SELECT date_trunc('hour', created_utc) AS bucket,
        unnest(list_distinct(list_filter(skills_array, lambda x: x IS NOT NULL))) AS skill FROM idx)
 GROUP BY ALL""")
def q_skill_trend(spark, sf_dir):
    return tm.trend(index(spark, sf_dir), "created_utc", fx.TREND_EVERY, by="skills_array",
                    name="skill")


def _slice_sql(lo: float, hi: float) -> str:
    return f"""bounds AS (SELECT min(epoch_us(created_utc)) AS a, max(epoch_us(created_utc)) AS b
           FROM idx),
sliced AS (SELECT idx.* FROM idx, bounds
           WHERE created_utc >= make_timestamp(a + CAST(round((b - a) * {float(lo)}) AS BIGINT))
             AND created_utc < make_timestamp(a + CAST(round((b - a) * {float(hi)}) AS BIGINT)))"""


@query("time_slice_all", PRELUDE + " SELECT id, created_utc FROM idx WHERE created_utc IS NOT NULL")
def q_time_slice_all(spark, sf_dir):
    """The whole range, newest post included."""
    return tm.time_slice(panel_index(spark, sf_dir, ("id", "created_utc")), "created_utc", 0.0, 1.0,
                         bounds_from=fx.posts(spark, sf_dir)).select("id", "created_utc")


@query("time_slice_opening", PRELUDE + " SELECT id, created_utc FROM idx WHERE created_utc IS NOT NULL")
def q_time_slice_opening(spark, sf_dir):
    """The state the dashboard opens in: fractions just outside the range."""
    return tm.time_slice(panel_index(spark, sf_dir, ("id", "created_utc")), "created_utc", *fx.OPENING_SLICE,
                         bounds_from=fx.posts(spark, sf_dir)).select("id", "created_utc")


@query("time_slice", PRELUDE + ",\n" + _slice_sql(*fx.SLICE)
       + " SELECT id, category, created_utc FROM sliced")
def q_time_slice(spark, sf_dir):
    return tm.time_slice(index(spark, sf_dir), "created_utc", *fx.SLICE,
                         bounds_from=fx.posts(spark, sf_dir)).select("id", "category", "created_utc")


CHOSEN = ["en", "fr"]


@query("category_filter", PRELUDE + " SELECT id, category FROM idx WHERE category IN ('en', 'fr')")
def q_category_filter(spark, sf_dir):
    return tm.choose(panel_index(spark, sf_dir, ("id", "category")), "category", CHOSEN).select("id", "category")


@query("filtered_categories", PRELUDE + ",\n" + _slice_sql(*fx.SLICE)
       + ",\nchosen AS (SELECT * FROM sliced WHERE category IN ('en', 'fr')),\n"
       + _top_sql("chosen", "category", "category", CATEGORY_PIE_SIZE, True, False))
def q_filtered_categories(spark, sf_dir):
    panel = tm.panel_filter(panel_index(spark, sf_dir, ("category", "created_utc")), "created_utc", *fx.SLICE, "category",
                            CHOSEN, bounds_from=fx.posts(spark, sf_dir))
    return tm.top_terms(panel, "category", CATEGORY_PIE_SIZE, share=True)


# ------------------------------------------------------- one-pass refresh ----

def _sub(body: str) -> str:
    return "(WITH " + body + ")"


_DASHBOARD = f"""
SELECT 'total_posts' AS panel, CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS skill,
       nullif(count(*), 0) AS posts, CAST(NULL AS INTEGER) AS rank, CAST(NULL AS DOUBLE) AS share
FROM idx
UNION ALL
SELECT 'category_share', category, NULL, posts, rank, share
FROM {_sub(_top_sql("idx", "category", "category", CATEGORY_PIE_SIZE, True, False))}
UNION ALL
SELECT 'top_skills', NULL, skill, posts, rank, NULL
FROM {_sub(_top_sql("idx", "skills_array", "skill", SKILL_CLOUD_SIZE, False, True))}
UNION ALL
SELECT 'category_skill_treemap', category, skill, posts, rank, share
FROM {_sub(_nested_sql("idx", *TREEMAP_SIZES, True))}
UNION ALL
SELECT 'category_skill_bars', category, skill, posts, rank, NULL
FROM {_sub(_nested_sql("idx", *BARS_SIZES, False))}"""
DASHBOARD_SQL = PRELUDE + _DASHBOARD


def _stacked(got: dict[str, DataFrame]) -> DataFrame:
    """All panels under each other, with a ``panel`` column."""
    cols = ["panel", "category", "skill", "posts", "rank", "share"]

    def shape(name: str, df: DataFrame) -> DataFrame:
        present = set(df.columns)
        types = {"category": "string", "skill": "string", "posts": "long", "rank": "int",
                 "share": "double"}
        return df.select(F.lit(name).alias("panel"), *[
            (F.col(c) if c in present else F.lit(None)).cast(types[c]).alias(c)
            for c in cols[1:]])

    stacked = None
    for name, df in got.items():
        if name == "total_posts":
            df = df.withColumnRenamed("total_posts", "posts")
        part = shape(name, df)
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked


@query("dashboard_panels", DASHBOARD_SQL)
def q_dashboard_panels(spark, sf_dir):
    """All five panels from one stored index, stacked with a ``panel`` column."""
    return _stacked(tm.panels(panel_index(spark, sf_dir), store=False))


EDIT = "CAST(id AS BIGINT) % 5 = 0"
EDITED_PRELUDE = f"""WITH {fx.POSTS_CTE},
txt AS (SELECT *, concat_ws(' ', title, selftext) AS text
        FROM (SELECT id, title, subreddit, created_utc,
                     CASE WHEN {EDIT} THEN NULL ELSE selftext END AS selftext,
                     CASE WHEN {EDIT} THEN subreddit ELSE category END AS category FROM posts)),
sk AS (SELECT *, {fx.duck_skills('text')} AS skills_array FROM txt),
idx AS (SELECT CASE WHEN len(skills_array) = 0 THEN 'other' ELSE category END AS category,
               id, skills_array FROM sk)"""


def edited_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second versions of a fifth of all posts: no body, the source as category."""
    edits = fx.posts(spark, sf_dir).where(EDIT).select(
        "id", "title", F.lit(None).cast("string").alias("selftext"), F.col("subreddit").alias("category"),
        (F.col("created_utc") + F.expr("INTERVAL 1 MINUTE")).alias("created_utc"))
    return category_override(with_skills(edits, MATCHER), "category").select(*ENRICHED_COLUMNS)


@query("panels_incremental", EDITED_PRELUDE + _DASHBOARD)
def q_panels_incremental(spark, sf_dir):
    """The dashboard after edits of a fifth of all posts, in three batches of the
    keyed log with a folded base and folded sums in between: the counts come
    from signed deltas, the index is read for the rest buckets alone."""
    log, deltas, base, sums = (scratch_path(spark, f"delta-{n}") for n in ("log", "counts", "base", "sums"))
    write = dl.delta_writer(log, deltas, base)
    write(index(spark, sf_dir).select(*ENRICHED_COLUMNS), 0)
    st.fold_log(spark, log, base)
    dl.fold_deltas(spark, deltas, sums)
    edits = edited_posts(spark, sf_dir)
    early = F.col("id").cast("long") % 2 == 0
    # the first batch of edits is edited once more by the second
    write(edits.where(early).withColumn("category", F.lit("draft")), 1)
    write(edits, 2)
    counts = stored(dl.read_counts(spark, deltas, sums), "panel-counts")
    current = st.read_keyed(spark, log, base=base)
    return _stacked(tm.panels(current, counts=counts))
