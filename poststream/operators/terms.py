"""Dashboard aggregations over the enriched post index.

"Count of records" counts posts: a skill found three times in one post counts
once.  Every panel is a partial + final hash aggregation over (category, skill)
pairs: map-side combine comes first, so what a task shuffles is bounded by
categories times lexicon terms, and a skill that sits in a third of all posts
is one partial row per task, not a hot reducer.  Top lists are bounded by
the panel size; they reach the rest buckets as scalar subqueries (Spark
evaluates them once and inlines a literal), never as a cross join.  A rest
bucket is a conditional count in a second pass, so the input should be a stored
index (as ``panels`` makes it), not a plan that extracts skills.

No operator here filters rows on an input column before aggregating: a
filter would be pushed below the projection that derives the column (e.g. a
category computed from the extracted skills) and evaluate that expression a
second time.  Conditions become conditional counts, and empty groups are
dropped after the aggregation, where nothing can be pushed down.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..defaults import (BARS_SIZES, CATEGORY_PIE_SIZE, OTHER_BUCKET, SKILL_CLOUD_SIZE,
                        TREEMAP_SIZES)
from ..session import stored

SHARE_DIGITS = 6


def _is_array(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.ArrayType)


def _distinct_values(col: str) -> Column:
    return F.array_distinct(F.array_compact(F.col(col)))


def total_posts(df: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Number of posts; no posts gives NULL, not 0.  ``counts``: see ``panels``."""
    if counts is not None:
        return (counts.where("skill IS NULL")
                .agg(F.nullif(F.coalesce(F.sum("posts"), F.lit(0)), F.lit(0)).alias("total_posts")))
    return df.agg(F.nullif(F.count(F.lit(1)), F.lit(0)).alias("total_posts"))


def _with_share(df: DataFrame, count_col: str = "posts") -> DataFrame:
    # the panel result holds at most (n + 1) rows, so one global sum is cheap
    total = F.sum(count_col).over(Window.partitionBy())
    return df.withColumn("share", F.round(F.col(count_col) / total, SHARE_DIGITS))


def _term_counts(df: DataFrame, col: str, name: str) -> DataFrame:
    if _is_array(df, col):
        values = df.select(F.explode(_distinct_values(col)).alias(name))
        return values.groupBy(name).agg(F.count(F.lit(1)).alias("posts"))
    # NULL forms one group whose count(col) is 0; it is dropped afterwards
    return (df.groupBy(F.col(col).alias(name)).agg(F.count(F.col(col)).alias("posts"))
            .where(F.col("posts") > 0))


def _count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def _ranked_top(counts: DataFrame, name: str, n: int) -> DataFrame:
    # TakeOrderedAndProject: each task keeps its own n best rows; the
    # ranking window then runs over at most n rows
    w = Window.orderBy(F.desc("posts"), F.asc(name))
    top = counts.orderBy(F.desc("posts"), F.asc(name)).limit(n)
    return top.select(name, "posts", F.row_number().over(w).alias("rank"))


def _with_rest(top: DataFrame, rest: DataFrame | None, name: str, n: int,
               share: bool) -> DataFrame:
    result = top
    if rest is not None:
        rest = rest.where(F.col("posts") > 0).select(
            F.lit(OTHER_BUCKET).alias(name), F.col("posts").cast("long").alias("posts"),
            F.lit(n + 1).alias("rank"))
        result = top.unionByName(rest)
    result = _with_share(result) if share else result
    return result.orderBy("rank")                 # at most n + 1 rows


def _top_values(counts: DataFrame, name: str, n: int, other: bool, share: bool) -> DataFrame:
    top = _ranked_top(counts, name, n)
    rest = None
    if other:
        # the total comes from the per-value counts (same plan as the top
        # list, so the shuffle is reused instead of scanning the input again)
        total = counts.agg(F.sum("posts")).scalar()
        rest = top.agg((total - F.coalesce(F.sum("posts"), F.lit(0))).alias("posts"))
    return _with_rest(top, rest, name, n, share)


def _values_of(counts: DataFrame, col: str, name: str) -> DataFrame:
    """Posts per category or per skill from (category, skill, posts) counts."""
    own = counts.where("skill IS NULL" if col == "category" else "skill IS NOT NULL")
    return (own.where(F.col(col).isNotNull()).groupBy(F.col(col).alias(name))
            .agg(F.sum("posts").alias("posts")).where("posts > 0"))


def top_terms(df: DataFrame, col: str, n: int, other: bool = True, share: bool = False,
              name: str | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Top ``n`` values of ``col`` by posts, plus a rest bucket.

    Ties: posts descending, then value ascending.  Rest bucket of an array
    column: posts that have a value but none of the top values (not the sum
    of the tail); of a plain column: the posts of all other values.  A rest
    bucket with no post is left out.  ``share`` is posts / panel total.
    ``counts`` (value, posts) may be given; ``df`` is then read for the rest
    bucket of an array column only.
    """
    name = name or col
    if counts is None:
        counts = _term_counts(df, col, name)
    if not _is_array(df, col):
        return _top_values(counts, name, n, other, share)
    top = _ranked_top(counts, name, n)
    rest = None
    if other:
        values = _distinct_values(col)
        top_list = top.select(F.collect_list(name)).scalar()
        rest = df.agg(_count_if((F.size(values) > 0) & ~F.arrays_overlap(values, top_list))
                      .alias("posts"))
    return _with_rest(top, rest, name, n, share)


def nested_terms(df: DataFrame, outer: str, inner: str, n_outer: int, n_inner: int,
                 other: bool = True, share: bool = False,
                 outer_name: str | None = None, inner_name: str | None = None,
                 counts: DataFrame | None = None) -> DataFrame:
    """Top ``n_outer`` values of ``outer``; inside each, top ``n_inner`` of
    the array column ``inner``; rest buckets at both levels.

    The outer rest bucket pools all remaining outer values and is split by
    ``inner`` the same way.  The inner rest bucket of a group counts the
    group's posts that have an inner value but none of the group's top list.
    ``counts`` (category, skill, posts; see ``panels``) may be given; ``df`` is
    then read for the rest buckets only.
    """
    outer_name, inner_name = outer_name or outer, inner_name or inner
    outer_counts = _term_counts(df, outer, outer_name) if counts is None \
        else _values_of(counts, "category", outer_name)
    outer_top = (outer_counts
                 .orderBy(F.desc("posts"), F.asc(outer_name)).limit(n_outer))
    outer_list = outer_top.select(F.collect_list(outer_name)).scalar()
    bucket = (F.when(F.col(outer).isNull(), F.lit(None).cast("string"))
              .when(F.array_contains(outer_list, F.col(outer)), F.col(outer)))
    if other:
        bucket = bucket.otherwise(F.lit(OTHER_BUCKET))
    based = df.select(bucket.alias(outer_name), _distinct_values(inner).alias("_values"))

    if counts is None:
        pairs = based.select(outer_name, F.explode("_values").alias(inner_name))
        counts = (pairs.groupBy(outer_name, inner_name)
                  .agg(F.count(outer_name).alias("posts")).where(F.col("posts") > 0))
    else:
        counts = (counts.where("skill IS NOT NULL").toDF(outer, "_skill", "_posts")
                  .select(bucket.alias(outer_name), F.col("_skill").alias(inner_name), "_posts")
                  .groupBy(outer_name, inner_name).agg(F.sum("_posts").alias("posts"))
                  .where((F.col("posts") > 0) & F.col(outer_name).isNotNull()))
    # per group at most |lexicon| rows: the window sorts small groups
    w = Window.partitionBy(outer_name).orderBy(F.desc("posts"), F.asc(inner_name))
    top = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n_inner)
    result = top.select(outer_name, inner_name, "posts", "rank")
    if other:
        top_map = top.groupBy(outer_name).agg(F.collect_list(inner_name).alias("_top")) \
            .select(F.map_from_entries(F.collect_list(F.struct(outer_name, "_top")))).scalar()
        group_top = F.try_element_at(top_map, F.col(outer_name))
        in_rest = (F.col(outer_name).isNotNull() & (F.size("_values") > 0)
                   & ~F.coalesce(F.arrays_overlap("_values", group_top), F.lit(False)))
        rest = (based.groupBy(outer_name).agg(_count_if(in_rest).alias("posts"))
                .where(F.col("posts") > 0)
                .select(outer_name, F.lit(OTHER_BUCKET).alias(inner_name), "posts",
                        F.lit(n_inner + 1).alias("rank")))
        result = result.unionByName(rest)
    return _with_share(result) if share else result


def panels(df: DataFrame, category: str = "category", skills: str = "skills_array",
           sizes: dict | None = None, store: bool = True,
           counts: DataFrame | None = None) -> dict[str, DataFrame]:
    """All dashboard panels of an index.

    ``counts`` (category, skill, posts; NULL skill: the posts of a category),
    kept by ``streaming.deltas``, spares counting: total, shares and top lists
    come from it, and the index is read for rest buckets alone.

    Only the two columns that they read are taken; by default those are written
    below ``spark.checkpoint.dir`` first, so an index that is still a plan
    extracts its skills once for all panels (``store=False`` for one that is
    already a table).
    """
    sz = {"pie": CATEGORY_PIE_SIZE, "cloud": SKILL_CLOUD_SIZE, "treemap": TREEMAP_SIZES,
          "bars": BARS_SIZES, **(sizes or {})}
    index = df.select(category, skills)
    if store:
        index = stored(index, "panel-index")
    by_category = by_skill = None
    if counts is not None:
        by_category, by_skill = _values_of(counts, "category", category), _values_of(counts, "skill", "skill")
    return {
        "total_posts": total_posts(index, counts),
        "category_share": top_terms(index, category, sz["pie"], share=True, counts=by_category),
        "top_skills": top_terms(index, skills, sz["cloud"], name="skill", counts=by_skill),
        "category_skill_treemap": nested_terms(index, category, skills, *sz["treemap"], share=True,
                                               inner_name="skill", counts=counts),
        "category_skill_bars": nested_terms(index, category, skills, *sz["bars"],
                                            inner_name="skill", counts=counts),
    }


def term_options(df: DataFrame, col: str, prefix: str = "", name: str | None = None) -> DataFrame:
    """Option list: distinct values with post counts, most posts first;
    prefix search is case-insensitive; empty prefix lists all."""
    name = name or col
    cond = F.col(col).isNotNull()
    if prefix:
        cond = cond & F.startswith(F.lower(F.col(col)), F.lit(prefix.lower()))
    return (df.groupBy(F.col(col).alias(name)).agg(_count_if(cond).alias("posts"))
            .where(F.col("posts") > 0)
            .orderBy(F.desc("posts"), F.asc(name)))      # options listed by count


def occurrences(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """Term frequency as occurrences: duplicates inside a post count."""
    name = name or col
    return (df.select(F.explode(F.col(col)).alias(name))
            .groupBy(name).agg(F.count(F.col(name)).alias("occurrences"))
            .where(F.col("occurrences") > 0))


def trend(df: DataFrame, ts: str, every: str = "1 hour", by: str | None = None,
          name: str | None = None) -> DataFrame:
    """Posts per time bucket (tumbling, aligned to the epoch in UTC), split
    by ``by``; an array ``by`` counts each post once per distinct value."""
    bucket = F.window(F.col(ts), every).start.alias("bucket")
    if by is None:
        return df.groupBy(bucket).agg(F.count(F.lit(1)).alias("posts"))
    name = name or by
    if _is_array(df, by):
        rows = df.select(bucket, F.explode(_distinct_values(by)).alias(name))
    else:
        rows = df.select(bucket, F.col(by).alias(name))
    return rows.groupBy("bucket", name).agg(F.count(F.lit(1)).alias("posts"))


def _fraction_of(lo_us: Column, hi_us: Column, frac: float) -> Column:
    return F.timestamp_micros(lo_us + F.round((hi_us - lo_us) * F.lit(float(frac))).cast("long"))


def time_slice(df: DataFrame, ts: str, lo: float, hi: float,
               bounds_from: DataFrame | None = None) -> DataFrame:
    """Rows with ``start <= ts < end`` where start and end are fractions of
    the data's own time range (min and max come in as scalar subqueries); a
    slice up to 1 or beyond includes the newest post.
    ``bounds_from``: a cheaper frame with the same times (e.g. the posts
    before enrichment) to take the range from."""
    src = bounds_from if bounds_from is not None else df
    bounds = src.agg(F.min(F.unix_micros(F.col(ts))).alias("a"),
                     F.max(F.unix_micros(F.col(ts))).alias("b"))
    a = bounds.select("a").scalar()
    b = bounds.select("b").scalar()
    start, end = _fraction_of(a, b, lo), _fraction_of(a, b, hi)
    until = F.col(ts) <= end if hi >= 1 else F.col(ts) < end
    return df.where((F.col(ts) >= start) & until)


def choose(df: DataFrame, col: str, values: Sequence[str] | None) -> DataFrame:
    """Options control: keep the chosen values; nothing chosen keeps all."""
    return df.where(F.col(col).isin(list(values))) if values else df


def panel_filter(df: DataFrame, ts: str, lo: float, hi: float, col: str,
                 values: Sequence[str] | None, bounds_from: DataFrame | None = None
                 ) -> DataFrame:
    """Controls in dashboard order: time slice first, then the options."""
    return choose(time_slice(df, ts, lo, hi, bounds_from), col, values)
