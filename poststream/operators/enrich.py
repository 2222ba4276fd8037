"""Enrichment: text -> skills -> category, the same plan for batch and stream.

Map-only: no shuffle, so it scales with the number of input partitions.  The
skill array is computed once per row; the projections that read it (size,
text join, output) sit above it, and Catalyst keeps the non-cheap regex from
being duplicated when projections collapse.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..defaults import NO_SKILL_CATEGORY
from ..functions.text import SkillMatcher, extract_skills, post_text, skill_matcher, skills_text

# fixed values: the columns of an index document, in this order
ENRICHED_COLUMNS = ["category", "id", "title", "selftext", "created_utc", "skills_array"]


Skills = SkillMatcher | str | Sequence[str]


def skills_column(skills: Skills, text: Column | str = "text") -> Column:
    """Extraction for a matcher, a cleaned-text pattern, or a list of terms."""
    if isinstance(skills, SkillMatcher):
        return extract_skills(text, matcher=skills)
    if isinstance(skills, str):
        return extract_skills(text, pattern=skills)
    return extract_skills(text, matcher=skill_matcher(skills))


def with_skills(df: DataFrame, skills: Skills, title: str = "title",
                body: str = "selftext", text: str | None = None) -> DataFrame:
    """Add ``text`` (title + body), ``skills_array`` and ``skills`` text.

    ``text``: name of a column that already holds the whole post text (it is
    matched directly and kept as is).

    The extraction sits in a one-element ``explode``: later filters on the
    skills or on anything derived from them (the category, the skills text)
    stay above that generator instead of being inlined below it, so the regex
    runs once per post whatever the query filters on.  The text expression
    goes into the generator itself, so the joined text is never copied into
    an intermediate row.  The price: Catalyst keeps the generator even when
    no column of it is read, so questions that need no skills (counts, time
    ranges) should read the posts themselves.
    """
    text_expr = F.col(text) if text else post_text(title, body)
    out = df.select("*", F.explode(F.array(skills_column(skills, text_expr)))
                    .alias("skills_array"))
    if not text:
        out = out.withColumn("text", text_expr)
    return out.withColumn("skills", skills_text("skills_array"))


def category_override(df: DataFrame, predicted: str = "predicted_category",
                      skills: str = "skills_array") -> DataFrame:
    """Posts without any skill get ``other``; the rest keep the prediction."""
    return df.withColumn("category", F.when(F.size(F.col(skills)) == 0, F.lit(NO_SKILL_CATEGORY))
                         .otherwise(F.col(predicted)))


def enriched(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The index document: category, id, title, selftext, created_utc,
    skills_array (plus any ``keep`` columns, e.g. the source)."""
    return df.select(*ENRICHED_COLUMNS, *keep)


def build_index(posts: DataFrame, skills: Skills, predicted: str = "predicted_category",
                keep: tuple[str, ...] = ()) -> DataFrame:
    """Skills, override and projection on posts that already carry a
    prediction column (from a model, or a label when checking)."""
    return enriched(category_override(with_skills(posts, skills), predicted), keep)
