"""Winnowing fingerprints with native expressions.

A text is a row of tokens: runs of non-blank characters, cut after 16.  Text
without blanks (a run over 48 characters, or over 16 if letters of scripts
written without blanks are in it) has a token at each character instead, the
``ROLL`` characters from there on, so that its k-grams roll character by
character wherever the run began; ``K`` such tokens are ``ROLL + K - 1``
characters.  (A shorter run, as an address, has at most three pieces, counted
from the blank before it.)  Every run of ``K`` tokens (a k-gram) is hashed; of every ``WINDOW`` neighbouring
k-grams the least hash is chosen, the rightmost of equal ones, and kept with
its position.  So two texts that share ``K + WINDOW - 1`` tokens in a row share
a chosen hash (the match guarantee), while about ``2 / (WINDOW + 1)`` of the
hashes are kept.  A shorter text has one k-gram over all its tokens.

The hash of a k-gram is XXH64 over its tokens' hashes; the order that picks the
minimum is its upper 32 bits.  Everything is done by array functions on the
row that holds the text; no text is cut, whatever its length.

NULL and empty texts have no tokens: no fingerprint entries, and two such texts
are alike (1.0).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from poststream.llm.tables import stored

K = 5
WINDOW = 8
ROLL = 8
BLANK = r"\x20\x09-\x0D"
UNSPACED = "".join(rf"\p{{Is{s}}}" for s in (
    "Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan"))
# the end of a run or a short one, a whole run of unspaced text, 16 characters of another run
PIECE = (rf"[^{BLANK}]{{1,16}}+(?![^{BLANK}])|[^{BLANK}]{{49,}}+"
         rf"|(?=[^{BLANK}{UNSPACED}]{{0,47}}+[{UNSPACED}])[^{BLANK}]{{17,}}+|[^{BLANK}]{{16}}")
POSITIONS = (1 << 31) - 1
GROUP_ROWS = 512
MAX_GROUPS = 8192


def with_winnow(df: DataFrame, text: str, out: str, k: int = K, window: int = WINDOW) -> DataFrame:
    """Add ``out``: array of (hash, position) chosen from column ``text``.

    Each step is a column of its own, so no step is evaluated twice.
    """
    p, t, g, v = f"_{out}_p", f"_{out}_t", f"_{out}_g", f"_{out}_v"
    grams = ", ".join(f"get({t}, i + {j})" for j in range(k))
    rolled = ", ".join(f"get(c, i + {j})" for j in range(ROLL))
    df = df.withColumn(p, F.expr(f"regexp_extract_all({text}, r'{PIECE}', 0)"))
    df = df.withColumn(t, F.expr(
        f"if(exists({p}, x -> char_length(x) > 16), "
        f"flatten(transform({p}, x -> if(char_length(x) <= 16, array(xxhash64(x)), "
        f"get(transform(array(transform(split(x, ''), y -> xxhash64(y))), "
        f"c -> transform(sequence(0, size(c) - {ROLL}), i -> xxhash64({rolled}))), 0)))), "
        f"transform({p}, x -> xxhash64(x)))"))
    df = df.withColumn(g, F.expr(
        f"if(size({t}) = 0, array(), "
        f"transform(sequence(0, greatest(size({t}) - {k}, 0)), i -> xxhash64({grams})))"))
    # upper hash bits, then the position counted down: least = rightmost minimum
    df = df.withColumn(v, F.expr(
        f"transform({g}, (x, i) -> shiftleft(shiftrightunsigned(x, 32), 31) + ({POSITIONS}L - i))"))
    reach, last = 1, v
    while reach < window:
        step = min(reach, window - reach)
        column = f"_{out}_m{reach}"
        df = df.withColumn(column, F.expr(
            f"transform({last}, (x, i) -> least(x, get({last}, i + {step})))"))
        reach, last = reach + step, column
    chosen = f"_{out}_c"
    df = df.withColumn(chosen, F.expr(
        f"array_distinct(slice({last}, 1, greatest(size({last}) - {window - 1}, 1)))"))
    df = df.withColumn(out, F.expr(
        f"transform({chosen}, x -> struct(get({g}, cast({POSITIONS}L - (x & {POSITIONS}L) as int)) "
        f"as hash, {POSITIONS}L - (x & {POSITIONS}L) as position))"))
    return df.drop(*[c for c in df.columns if c.startswith(f"_{out}_")])


def digest(winnowed: str) -> Column:
    """32 hex digits over all chosen hashes and positions, in order."""
    return F.lower(F.concat(*[F.lpad(F.hex(F.xxhash64(F.expr(f"{winnowed}.{part}"))), 16, "0")
                              for part in ("hash", "position")]))


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two arrays of distinct hashes; two empty ones are alike."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def _groups(docs: DataFrame) -> tuple[list[int], int]:
    """Upper ids of ranges of about GROUP_ROWS documents (a few thousand numbers)."""
    rows = docs.count()
    groups = max(1, min(MAX_GROUPS, rows // GROUP_ROWS))
    if groups == 1:
        return [], 1
    cuts = docs.agg(F.percentile_approx(
        "doc_id", [i / groups for i in range(1, groups)], 100 * groups)).first()[0]
    return sorted(set(cuts or [])), groups


def _group_of(cuts: list[int], groups: int) -> Column:
    """Number of the range that an id falls in, found in two steps."""
    if not cuts:
        return F.lit(0)
    side = max(1, int(len(cuts) ** 0.5))
    rows = [cuts[i: i + side] for i in range(0, len(cuts), side)]
    tops = F.array(*[F.lit(r[0]) for r in rows])
    inner = F.array(*[F.array(*[F.lit(x) for x in r]) for r in rows])
    row = F.size(F.filter(tops, lambda x: x < F.col("doc_id")))
    return F.when(F.col("doc_id").isNull() | (row == 0), F.lit(0)).otherwise(
        (row - 1) * side + F.size(F.filter(F.element_at(inner, F.greatest(row, F.lit(1))),
                                           lambda x: x < F.col("doc_id"))))


def neighbours(docs: DataFrame) -> DataFrame:
    """(doc_id, text, hashes, fingerprint) and ``next_text``, ``next_hashes`` of
    the next document: descending ``doc_id`` (NULL last, equal ids by a hash
    of the text), and the first document again after the last.

    Documents are grouped in ranges of ids; the first document of each range
    is also sent to the range before it, so that the last one finds its
    successor.  The texts are shuffled once.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    cuts, groups = _groups(docs)
    keyed = docs.withColumn("h", F.xxhash64("text")).withColumn("g", _group_of(cuts, groups))
    # the first row of each range (NULL ids order below all others), one row per range
    rank = F.struct(F.col("doc_id").isNotNull().alias("some"), F.col("doc_id").alias("i"),
                    F.col("h").alias("j"))
    firsts = keyed.groupBy("g").agg(F.max(rank).alias("top"))
    down = Window.orderBy(F.col("g").desc())   # a row per range: a few thousand
    to = firsts.select("top", F.coalesce(
        F.lag("g").over(down),
        F.first("g").over(Window.orderBy("g"))).alias("to"))
    to = stored(to.select(F.col("top.i").alias("i"), F.col("top.j").alias("j"), "to"), "winnow-firsts")
    guests = (keyed.join(to, F.expr("doc_id <=> i and h = j"))
              .dropDuplicates(["to"])
              .select("doc_id", "text", "h", F.col("to").alias("g"), F.lit(True).alias("guest")))
    rows = with_winnow(keyed.withColumn("guest", F.lit(False)).unionByName(guests), "text", "own") \
        .withColumn("hashes", F.expr("array_distinct(own.hash)"))
    order = Window.partitionBy("g").orderBy(
        "guest", F.col("doc_id").desc_nulls_last(), F.col("h").desc())
    # one lead per column: a struct of them would cross the shuffle as a copy
    return (rows.withColumn("fingerprint", digest("own")).drop("own")
            .withColumns({"next_text": F.lead("text").over(order),
                          "next_hashes": F.lead("hashes").over(order)})
            .where("not guest"))


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, with likenesses.

    Edited: the last third of the code points replaced by as many first code
    points of the next document."""
    rows = neighbours(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    rows = rows.withColumn("edited", F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - third).cast("int")),
        F.substring("next_text", F.lit(1), third)))
    rows = with_winnow(rows, "edited", "new").withColumn(
        "new_hashes", F.expr("array_distinct(new.hash)"))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
        digest("new").alias("edited_fingerprint"),
        likeness("hashes", "new_hashes").alias("near_edited"),
        likeness("hashes", "next_hashes").alias("near_next"))
