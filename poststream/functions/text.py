"""Column functions for post text.

All of these are built-in Spark expressions, so they stay inside whole-stage
codegen and need no Python worker.  The skill matcher is one
``regexp_extract_all`` whose pattern is a foldable literal: Spark compiles it
once per task and the lexicon travels with the plan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..defaults import BODY_CHARS, TITLE_PREVIEW_CHARS

ColumnOrName = Column | str



def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------
# text assembly and cleaning
# --------------------------------------------------------------------------

def post_text(*cols: ColumnOrName) -> Column:
    """Title and body joined by one blank; NULL parts are skipped."""
    return F.concat_ws(" ", *[_col(c) for c in cols])


def clean_text(c: ColumnOrName) -> Column:
    """Lower-case; every character outside ``[a-z0-9+#./-]`` and whitespace
    becomes a blank; runs of whitespace collapse to one blank; trimmed."""
    lowered = F.lower(_col(c))
    kept = F.regexp_replace(lowered, r"[^a-z0-9+#./\-\s]", " ")
    return F.trim(F.regexp_replace(kept, r"\s+", " "))


# --------------------------------------------------------------------------
# lexicon matching
# --------------------------------------------------------------------------

# characters that survive cleaning; everything else (and whitespace) turns
# into the single blank between tokens
# fixed values: the characters that cleaning keeps
KEPT = "abcdefghijklmnopqrstuvwxyz0123456789+#./-"
GAP = r"[^a-z0-9+#./\-]+"


def _escape(term: str, gap: bool = False) -> str:
    out = []
    for ch in term:
        code = ord(ch)
        if gap and ch == " ":
            out.append(GAP)
        elif ch.isascii() and ch.isalnum():
            out.append(ch)
        elif code < 0x20 or code >= 0x7F:
            out.append("\\x{%x}" % code)
        else:
            out.append("\\" + ch)
    return "".join(out)


def _ordered(terms: Iterable[str]) -> list[str]:
    uniq = {t for t in terms if t is not None and t != ""}
    return sorted(uniq, key=lambda t: (-len(t), t))


def _trie_body(terms: Sequence[str], gap: bool = False) -> str:
    end = object()
    root: dict = {}
    for t in terms:
        node = root
        for ch in t:
            node = node.setdefault(ch, {})
        node[end] = True

    def emit(node: dict) -> str:
        branches = [_escape(ch, gap) + emit(child)
                    for ch, child in sorted(((k, v) for k, v in node.items() if k is not end),
                                            key=lambda kv: kv[0])]
        if not branches:
            return ""
        if len(branches) == 1 and end not in node:
            return branches[0]
        group = "(?:" + "|".join(branches) + ")"
        # a greedy optional tail tries the longer terms first and backtracks to
        # the shorter one, so longest-first is kept
        return group + "?" if end in node else group

    return emit(root)


def _alternation(ordered: Sequence[str], trie: bool | None, gap: bool = False) -> str:
    use_trie = True if trie is None else trie
    return _trie_body(ordered, gap) if use_trie else "|".join(_escape(t, gap) for t in ordered)


def skill_pattern(terms: Iterable[str], trie: bool | None = None) -> str:
    """Regex that finds lexicon terms as whole tokens of the cleaned text,
    longest term first.

    A term matches where no word character precedes its first and none
    follows its last character.  The terms form a prefix trie, which makes far
    fewer attempts per position than a flat alternation (``trie=False``) and
    finds the same matches.
    """
    ordered = _ordered(terms)
    if not ordered:
        return ""
    return r"(?<!\w)(?:" + _alternation(ordered, trie) + r")(?!\w)"


def _matchable(term: str) -> bool:
    """Can the term occur in cleaned text at all?  (Only kept characters and
    single blanks survive cleaning.)"""
    return all(ch in KEPT or ch == " " for ch in term) and "  " not in term


@dataclass(frozen=True)
class SkillMatcher:
    """Compiled lexicon.

    ``raw`` matches the lower-cased text directly: a blank inside a term
    stands for any run of non-kept characters, edges are checked against
    ``[a-z0-9]`` -- exactly the tokens the cleaned text would give, without
    rewriting every text twice.  The few matches are normalised afterwards.
    ``raw`` is None when a term starts or ends with a blank (cleaning trims
    the text, which the raw form cannot see); then the cleaned path runs.
    """
    pattern: str
    raw: str | None
    gap: bool

    def column(self, c: ColumnOrName) -> Column:
        empty = F.array().cast("array<string>")
        if not self.pattern:
            return empty
        if self.raw is None:
            found = F.regexp_extract_all(clean_text(c), F.lit(self.pattern), F.lit(0))
        else:
            found = F.regexp_extract_all(F.lower(_col(c)), F.lit(self.raw), F.lit(0))
            if self.gap:
                found = F.transform(found, lambda m: F.regexp_replace(m, GAP, " "))
        return F.coalesce(found, empty)


def skill_matcher(terms: Iterable[str], trie: bool | None = None) -> SkillMatcher:
    ordered = _ordered(terms)
    pattern = skill_pattern(ordered, trie)
    live = [t for t in ordered if _matchable(t)]
    if not live:
        return SkillMatcher("", None, False)
    if any(t[0] == " " or t[-1] == " " for t in live):
        return SkillMatcher(pattern, None, False)
    raw = r"(?<![a-z0-9])(?:" + _alternation(live, trie, gap=True) + r")(?![a-z0-9])"
    return SkillMatcher(pattern, raw, any(" " in t for t in live))


def extract_skills(c: ColumnOrName, terms: Iterable[str] | None = None,
                   pattern: str | None = None, matcher: SkillMatcher | None = None,
                   cleaned: bool = False) -> Column:
    """All non-overlapping lexicon matches, left to right, duplicates kept.

    Never NULL: NULL or empty text, or an empty lexicon, give ``[]`` so that a
    later ``size(...) == 0`` test sees zero.  Pass ``terms`` (or a prepared
    ``matcher``) for the fast path; a bare cleaned-text ``pattern`` is matched
    against ``clean_text(c)`` (or ``c`` itself when ``cleaned``).
    """
    if pattern is None:
        return (matcher or skill_matcher(terms or [])).column(c)
    empty = F.array().cast("array<string>")
    if not pattern:
        return empty
    text = _col(c) if cleaned else clean_text(c)
    return F.coalesce(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), empty)


def skills_text(arr: ColumnOrName) -> Column:
    """Array of skills as ``", "``-joined text; ``[]`` gives ``''``."""
    return F.concat_ws(", ", _col(arr))


def tokenize_skills(c: ColumnOrName, compat: bool = False) -> Column:
    """Split skills text into tokens, case kept, empty tokens dropped.

    ``compat=True`` splits on ``,`` alone like the original tokenizer (the
    blank after each comma stays on the token); the default also eats the
    blanks around the comma so training and serving agree.
    """
    pattern = "," if compat else r"\s*,\s*"
    return F.filter(F.split(_col(c), pattern), lambda t: F.length(t) > 0)


# --------------------------------------------------------------------------
# time
# --------------------------------------------------------------------------

def epoch_to_utc(c: ColumnOrName) -> Column:
    """Epoch seconds (integral or fractional) to a UTC timestamp."""
    col = _col(c)
    return F.timestamp_micros(F.round(col.cast("double") * 1_000_000).cast("long"))


def iso_timestamp(c: ColumnOrName) -> Column:
    """UTC timestamp as ISO-8601 text with ``+00:00``; microseconds appear
    only when non-zero (as Python's ``isoformat`` does)."""
    ts = _col(c).cast("timestamp")
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    frac = F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))) \
        .otherwise(F.lit(""))
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), frac, F.lit("+00:00"))


# --------------------------------------------------------------------------
# keyword relevance and truncation
# --------------------------------------------------------------------------

def job_text(title: ColumnOrName, body: ColumnOrName) -> Column:
    """Lower-cased ``title + " " + body`` used by the keyword test (a NULL
    part counts as empty text)."""
    return F.lower(F.concat(F.coalesce(_col(title), F.lit("")), F.lit(" "),
                            F.coalesce(_col(body), F.lit(""))))


def keyword_hits(text: ColumnOrName, keywords: Sequence[str]) -> Column:
    """Keywords that occur in ``text`` as plain substrings, in keyword order."""
    t = _col(text)
    return F.filter(F.array(*[F.lit(k) for k in keywords]).cast("array<string>"),
                    lambda k: F.contains(t, k))


def is_relevant(text: ColumnOrName, keywords: Sequence[str]) -> Column:
    """True when any keyword occurs in ``text`` (substring, so "hire" also
    matches "shire"): one pass over the text for all keywords."""
    if not keywords:
        return F.lit(False)
    return _col(text).rlike("|".join(_quoted(k) for k in keywords))


def _quoted(text: str) -> str:
    return "".join(ch if ch.isalnum() or ch == " " else "\\" + ch for ch in text)


def title_preview(c: ColumnOrName, n: int = TITLE_PREVIEW_CHARS) -> Column:
    return F.substring(_col(c), 1, n)


def truncate_body(c: ColumnOrName, n: int = BODY_CHARS) -> Column:
    return F.substring(_col(c), 1, n)
