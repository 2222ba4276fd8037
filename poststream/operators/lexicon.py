"""Skill lexicon: load, order, size, match, coverage report.

A lexicon that a user wrote (hundreds to a few hundred thousand terms) reaches
the executors as a literal regex in the plan.  A lexicon held as a table, of
any size, is matched by a join (``match_by_join``) and never collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..defaults import CSV_MISSING_MARKERS
from ..functions.text import SkillMatcher, clean_text, skill_matcher
from ..session import stored
from .topn import global_rank

# a word, a kept sign, or a run of what cleaning turns into one blank
ATOM = "[a-z0-9]+|[+#./-]|[^a-z0-9+#./-]+"
SIEVE_BITS = 1 << 16


def read_lexicon_csv(spark: SparkSession, path: str) -> DataFrame:
    """Lexicon CSV with a header; every column read as text (no inference)."""
    return load_lexicon(spark.read.option("header", True).csv(path))


def load_lexicon(df: DataFrame, column: str = "skill") -> DataFrame:
    """Normalise a raw lexicon table to ``df[skill]``.

    Header names are stripped and lower-cased; missing values (NULL and the
    markers a pandas CSV reader treats as missing) are dropped; terms are
    lower-cased (not trimmed) and made distinct.
    """
    renamed = df.toDF(*[c.strip().lower() for c in df.columns])
    if column not in renamed.columns:
        raise ValueError(f"lexicon needs a '{column}' column, got {renamed.columns}")
    raw = F.col(column).cast("string")
    return (renamed
            .where(raw.isNotNull() & ~raw.isin(CSV_MISSING_MARKERS))
            .select(F.lower(raw).alias("skill"))
            .dropDuplicates(["skill"]))


def order_terms(lexicon: DataFrame) -> DataFrame:
    """Terms longest first (ties alphabetical) with their 1-based position.

    Ranked with a distributed sort, so a lexicon derived from the data (a
    vocabulary) never has to fit one task.
    """
    terms = lexicon.select("skill")
    return global_rank(terms, [F.desc(F.length("skill")), F.asc("skill")], "position")


def lexicon_size(lexicon: DataFrame) -> DataFrame:
    return lexicon.agg(F.count_distinct("skill").alias("lexicon_size"))


def lexicon_terms(lexicon: DataFrame) -> list[str]:
    """The terms of a lexicon that a user wrote, for the literal pattern.  A
    lexicon derived from data belongs in ``match_by_join``."""
    return [r.skill for r in lexicon.select("skill").collect()]


def lexicon_matcher(lexicon: DataFrame) -> SkillMatcher:
    """The matcher that ships a user's lexicon with the plan."""
    return skill_matcher(lexicon_terms(lexicon))


def anchored(lexicon: DataFrame) -> DataFrame:
    """(skill, atom, offset, size, head, tail): each term once, under the rarest of
    its atoms, with its text before and after that atom.

    Rarest: contained in the fewest terms; of equals the longer, and words before
    other characters, for blanks and single signs stand in every text.  The choice
    decides how many places of a text are looked at, never what is found."""
    terms = lexicon.select("skill").where("skill <> ''").distinct().withColumn(
        "a", F.expr(f"regexp_extract_all(skill, r'{ATOM}', 0)"))
    atoms = terms.select("skill", "a", F.posexplode("a").alias("offset", "atom"))
    # terms per atom: pre-aggregated, so that a blank in most terms is no hot key
    spread = atoms.select("skill", "atom").distinct().groupBy("atom").agg(F.count(F.lit(1)).alias("n"))
    rank = F.struct(~F.col("atom").rlike("^[a-z0-9]"), "n", -F.length("atom"), "offset")
    return (atoms.join(spread, "atom").groupBy("skill", "a")
            .agg(F.min_by(F.struct("atom", "offset"), rank).alias("m"))
            .select("skill", "m.atom", "m.offset", F.size("a").alias("size"),
                    F.expr("array_join(slice(a, 1, m.offset), '')").alias("head"),
                    F.expr("array_join(slice(a, m.offset + 2, size(a)), '')").alias("tail")))


def _sieve(anchors: DataFrame) -> list[int]:
    """A bit for the hash of each anchor, in words of 64: always SIEVE_BITS bits,
    however many terms there are."""
    bit = F.pmod(F.xxhash64("atom"), F.lit(SIEVE_BITS)).alias("bit")
    words = (anchors.select(bit).groupBy(F.expr("cast(bit div 64 as int)").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).collect())
    out = [0] * (SIEVE_BITS // 64)
    for r in words:
        out[r["w"]] = r["bits"]
    return out


def match_by_join(posts: DataFrame, lexicon: DataFrame, key: str = "id", text: str = "text",
                  out: str = "skills_array") -> DataFrame:
    """(key, ``out``): the same terms as ``extract_skills``, for a lexicon of
    any size that stays a table.

    A term is looked for only where its rarest atom stands.  A text's atoms pass a
    sieve of fixed size (a bit per hash of an anchor); those that pass leave their
    text with as many neighbours as the longest term has, and are joined to the
    anchors; the rest of the term is compared with the neighbours.  The join is
    Spark's choice: a small lexicon is broadcast, a large one shuffled, where AQE
    splits a frequent atom.  From a post's hits the leftmost is taken, of those the
    longest, then the next one that begins after it.  ``key`` must be unique.
    """
    anchors = stored(anchored(lexicon), "anchors")
    before, after, blank = anchors.agg(F.max("offset"), F.max(F.expr("size - offset - 1")),
                                       F.max(F.expr("trim(skill) = ''"))).first()
    before, after = (before or 0) + 1, (after or 0) + 1
    # matched as cleaned text: what is not kept is one blank, none at the ends
    raw = F.col("clean") if "clean" in posts.columns else F.lower(F.col(text))
    cut = posts.select(F.col(key), raw.alias("t")).select(
        F.col(key), F.expr(f"regexp_extract_all(t, r'{ATOM}', 0)").alias("a"))
    kept = "x rlike '^[a-z0-9+#./-]'"
    as_clean = f"transform(%s, x -> if({kept}, x, ' '))"
    if blank:       # a term of blanks alone
        cut = cut.select(F.col(key), F.expr(as_clean % "a").alias("a"))
    sieve = ", ".join(f"{w}L" if w > -2 ** 63 else "bigint('-9223372036854775808')" for w in _sieve(anchors))
    bit = f"pmod(xxhash64(get(a, i)), {SIEVE_BITS}L)"
    passes = (f"getbit(get(array({sieve}), cast(shiftright({bit}, 6) as int)), cast({bit} & 63 as int)) = 1")
    left = as_clean % f"slice(a, greatest(i - {before}, 0) + 1, least(i, {before}))"
    right = as_clean % f"slice(a, i + 2, {after})"
    places = F.expr(
        f"if(size(a) = 0, array(), transform(filter(sequence(0, size(a) - 1), i -> {passes}), i -> struct("
        f"i as at, get(a, i) as atom, if(i <= {before}, ltrim(array_join({left}, '')), array_join({left}, '')) "
        f"as before, if(i + {after} >= size(a) - 1, rtrim(array_join({right}, '')), array_join({right}, '')) "
        f"as after, i in (0, size(a) - 1) as edge)))")
    free = "not coalesce(%s rlike '[a-z0-9]', false)"
    hits = (cut.select(F.col(key), F.explode(places).alias("p")).select(F.col(key), "p.*")
            .join(anchors, "atom")
            .where("endswith(before, head) and startswith(after, tail) and not (edge and atom = ' ')")
            .where(free % "substr(before, char_length(before) - char_length(head), if(char_length(before) > char_length(head), 1, 0))")
            .where(free % "substr(after, char_length(tail) + 1, 1)"))
    fold = F.expr(
        "aggregate(array_sort(collect_list(struct(at - offset as start, -size as size, skill))), "
        "named_struct('upto', 0, 'got', cast(array() as array<string>)), "
        "(s, x) -> if(x.start >= s.upto, named_struct('upto', x.start - x.size, "
        "'got', concat(s.got, array(x.skill))), s), s -> s.got)")
    found = hits.groupBy(key).agg(fold.alias(out))
    none = F.array().cast("array<string>")
    return posts.select(key).join(found, key, "left").select(key, F.coalesce(out, none).alias(out))


def lexicon_coverage(index: DataFrame, lexicon: DataFrame,
                     skills: str = "skills_array") -> DataFrame:
    """Posts per lexicon term, terms without any post included with 0.

    Posts are reduced to per-term counts first (partial aggregation on the
    executors); only the term-sized result meets the lexicon.
    """
    counts = (index
              .select(F.explode(F.array_distinct(F.col(skills))).alias("skill"))
              .groupBy("skill").agg(F.count(F.lit(1)).alias("posts")))
    return (lexicon.select("skill").distinct()
            .join(counts, "skill", "left")
            .select("skill", F.coalesce(F.col("posts"), F.lit(0)).cast("long").alias("posts")))
