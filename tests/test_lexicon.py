from pyspark.sql import functions as F
from pyspark.sql import types as T

from poststream.functions.text import extract_skills, skill_pattern
from poststream.operators import lexicon as lx


def test_load_lexicon_normalises(spark):
    raw = spark.createDataFrame(
        [("Python",), ("python",), (" AWS",), ("NA",), ("null",), (None,), ("",), ("Na",)],
        T.StructType([T.StructField(" Skill ", T.StringType())]))
    got = sorted(r.skill for r in lx.load_lexicon(raw).collect())
    assert got == [" aws", "na", "python"]   # not trimmed; markers dropped before lower


def test_read_lexicon_csv(spark, tmp_path):
    p = tmp_path / "skills.csv"
    p.write_text(" Skill ,weight\nGo,1\n,2\nNULL,3\nRust,4\ngo,5\n")
    got = sorted(r.skill for r in lx.read_lexicon_csv(spark, str(p)).collect())
    assert got == ["go", "rust"]


def test_order_and_size(spark):
    lex = spark.createDataFrame([("c",), ("c++",), ("go",), ("ab",)], "skill string")
    order = [r.skill for r in lx.order_terms(lex).orderBy("position").collect()]
    assert order == ["c++", "ab", "go", "c"]
    assert lx.lexicon_size(lex).first()[0] == 4
    assert sorted(lx.lexicon_terms(lex)) == ["ab", "c", "c++", "go"]


def test_match_by_join_equals_the_pattern(spark):
    terms = ["c", "c++", "c#", "java", "node.js", "node", ".net", "ci/cd", "machine learning",
             "javascript", "go", "of the", "of", "the", " aws", "###", "+1", "a b c", "a_b", "a  b", "x,y",
             "learning machine", "## +", "the end", " "]
    texts = ["C++, Java & java; Node.js\tMachine\nLearning asp.net .NET CI/CD c++11 Go-lang", "", None,
             "Java Script JAVASCRIPT _java_ \u00e9 go c#", "of the of the the of", "###+1 +1 a b c a b",
             "x aws .net.net go/go go.go", "machine  learning machine learning", "+ + a_b a  b x,y",
             " aws aws, aws ", "\u00a0of \u2014 the of_the Of-The 1of the2", "## + c++ ++c c +", "the end",
             "lathe end", "\n", " + "]
    posts = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    lexicon = spark.createDataFrame([(t,) for t in terms], "skill string")
    want = {r.id: r.k for r in posts.select("id", extract_skills(
        F.coalesce("text", F.lit("")), pattern=skill_pattern(terms)).alias("k")).collect()}
    got = {r.id: r.skills_array for r in lx.match_by_join(posts, lexicon).collect()}
    assert got == want
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = lx.match_by_join(posts, lexicon).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert {r.id: r.skills_array for r in large} == want
    none = lx.match_by_join(posts, lexicon.where("false"))
    assert {tuple(r.skills_array) for r in none.collect()} == {()}


def test_coverage_keeps_zero_terms(spark):
    idx = spark.createDataFrame([(["a", "a", "b"],), (["a"],), ([],)], "skills_array array<string>")
    lex = spark.createDataFrame([("a",), ("b",), ("z",)], "skill string")
    got = {r.skill: r.posts for r in lx.lexicon_coverage(idx, lex).collect()}
    assert got == {"a": 2, "b": 1, "z": 0}
