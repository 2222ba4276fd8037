"""Column -> Column functions (built-in Spark expressions only)."""

from .text import (  # noqa: F401
    clean_text, epoch_to_utc, extract_skills, is_relevant, iso_timestamp, job_text,
    keyword_hits, post_text, skill_pattern, skills_text, title_preview, tokenize_skills,
    truncate_body,
)
