import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from poststream.functions import text as tx

EDGE_LEXICON = ["c", "c++", "c#", "java", "node.js", "node", ".net", "ci/cd",
                "machine learning", "javascript", "go"]

EDGE_ROWS = [
    ("C++, Java & java; Node.js\tMachine\nLearning asp.net .NET CI/CD c++11 Go-lang",
     ["c++", "java", "java", "node.js", "machine learning", ".net", "ci/cd", "c", "go"]),
    ("", []),
    ("Java Script JAVASCRIPT _java_ é go K c#", ["java", "javascript", "java", "go", "c#"]),
    ("İ C# java.", ["c#", "java"]),
    ("   \t ", []),
    (None, []),
]


def _clean(s):
    s = s.lower()
    s = re.sub(r"[^a-z0-9+#./\-\s]", " ", s)
    return re.sub(r"\s+", " ", s).strip()


def brute_force(text, terms):
    """Independent scan: at each position that follows no word character,
    take the longest term that is followed by no word character."""
    if not text:
        return []
    t = _clean(text)
    ordered = sorted(set(terms), key=len, reverse=True)
    word = lambda ch: ch.isalnum() or ch == "_"
    out, i = [], 0
    while i < len(t):
        if i == 0 or not word(t[i - 1]):
            for term in ordered:
                end = i + len(term)
                if t.startswith(term, i) and (end == len(t) or not word(t[end])):
                    out.append(term)
                    i = end
                    break
            else:
                i += 1
        else:
            i += 1
    return out


def _extract(spark, texts, terms, trie=None, raw=False):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    if raw:
        col = tx.extract_skills("t", matcher=tx.skill_matcher(terms, trie=trie))
    else:
        col = tx.extract_skills("t", pattern=tx.skill_pattern(terms, trie=trie))
    rows = df.select("i", col.alias("s")).collect()
    return [r.s for r in sorted(rows, key=lambda r: r.i)]


def test_edge_rows(spark):
    got = _extract(spark, [t for t, _ in EDGE_ROWS], EDGE_LEXICON)
    assert got == [e for _, e in EDGE_ROWS]


def test_edge_rows_trie(spark):
    got = _extract(spark, [t for t, _ in EDGE_ROWS], EDGE_LEXICON, trie=True)
    assert got == [e for _, e in EDGE_ROWS]


def test_edge_rows_raw_path(spark):
    assert tx.skill_matcher(EDGE_LEXICON).raw is not None
    for trie in (False, True):
        got = _extract(spark, [t for t, _ in EDGE_ROWS], EDGE_LEXICON, trie=trie, raw=True)
        assert got == [e for _, e in EDGE_ROWS]


MULTI = ["of the", "of", "the", "a b", "b", "c++", "+1", "x.y", "y", "- -", "Upper", "u_v",
         "  two"]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="abcfhoteuxy .,+1-_\t\nU", max_size=30), min_size=1,
                max_size=40))
def test_raw_path_equals_cleaned_path(spark, texts):
    terms = [t for t in MULTI if not t.startswith(" ")]
    want = [brute_force(t, terms) for t in texts]
    assert _extract(spark, texts, terms, raw=True) == want
    assert _extract(spark, texts, terms, raw=True, trie=True) == want


def test_blank_edged_term_falls_back_to_cleaned_path(spark):
    m = tx.skill_matcher(["java", " aws"])
    assert m.raw is None
    assert _extract(spark, ["x+, aws java", "  aws"], ["java", " aws"], raw=True) == \
        [brute_force("x+, aws java", ["java", " aws"]), brute_force("  aws", ["java", " aws"])]


def test_brute_force_matches_edge_rows():
    for text, expected in EDGE_ROWS:
        assert brute_force(text, EDGE_LEXICON) == expected


ALPHABET = "abcgjnoltv .+#/-_,;\t\nCJé 123"


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=40))
def test_native_equals_brute_force(spark, texts):
    want = [brute_force(t, EDGE_LEXICON) for t in texts]
    assert _extract(spark, texts, EDGE_LEXICON) == want
    assert _extract(spark, texts, EDGE_LEXICON, trie=True) == want


def test_trie_pattern_is_longest_first():
    pat = tx.skill_pattern(["c", "c#", "c++"], trie=True)
    assert re.findall(pat, "c++ c# c c+") == ["c++", "c#", "c", "c"]


def test_empty_lexicon_gives_empty_arrays(spark):
    assert _extract(spark, ["java go"], []) == [[]]


def test_clean_text(spark):
    df = spark.createDataFrame([("  Hello,\tWORLD!! c++  été ",)], "t string")
    assert df.select(tx.clean_text("t")).first()[0] == "hello world c++ t"


def test_post_text_skips_nulls(spark):
    df = spark.createDataFrame([("a", None), (None, "b"), ("a", "b")], "x string, y string")
    assert [r[0] for r in df.select(tx.post_text("x", "y")).collect()] == ["a", "b", "a b"]


def test_tokenize_default_and_compat(spark):
    df = spark.createDataFrame([("python, aws",), ("python,aws",), ("",), (None,)], "s string")
    default = [r[0] for r in df.select(tx.tokenize_skills("s")).collect()]
    compat = [r[0] for r in df.select(tx.tokenize_skills("s", compat=True)).collect()]
    assert default == [["python", "aws"], ["python", "aws"], [], None]
    assert compat == [["python", " aws"], ["python", "aws"], [], None]


def test_skills_text(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],)], "a array<string>")
    assert [r[0] for r in df.select(tx.skills_text("a")).collect()] == ["a, b", ""]


def test_time_functions(spark):
    df = spark.createDataFrame([(1704067207,), (0,)], "e long")
    rows = df.select(tx.iso_timestamp(tx.epoch_to_utc("e"))).collect()
    assert [r[0] for r in rows] == ["2024-01-01T00:00:07+00:00", "1970-01-01T00:00:00+00:00"]
    frac = spark.createDataFrame([(1704067207.5,)], "e double")
    assert frac.select(tx.iso_timestamp(tx.epoch_to_utc("e"))).first()[0] == \
        "2024-01-01T00:00:07.500000+00:00"


def test_keywords(spark):
    df = spark.createDataFrame([("We are Hiring", "a contract"), ("the shire", None),
                                ("nothing", "here")], "t string, b string")
    text = tx.job_text("t", "b")
    kws = ["hire", "hiring", "contract"]
    rows = df.select(tx.keyword_hits(text, kws), tx.is_relevant(text, kws)).collect()
    assert [list(r[0]) for r in rows] == [["hiring", "contract"], ["hire"], []]
    assert [r[1] for r in rows] == [True, True, False]


def test_truncation(spark):
    df = spark.createDataFrame([("x" * 70, "y" * 6000)], "t string, b string")
    r = df.select(F.length(tx.title_preview("t")), F.length(tx.truncate_body("b"))).first()
    assert (r[0], r[1]) == (60, 5000)
