"""Personal data: fixed patterns plus spans found by weak supervision.

Base spans (email, ip, card, phone) are the leftmost non-overlapping matches of
a fixed pattern per kind that pass a check.  Further candidates are phone numbers
without a country code, national ids, and three kinds of keys and passwords, none
with an upper bound: ``secret``, 16 or more letters and digits, both among them;
``key``, the same with ``_ + / -`` inside and perhaps ``=`` behind; ``password``,
any value up to a blank or quote that follows a naming word and an assignment
sign, if it is not one of the other two (punctuation behind it is left out).
Spans of different kinds may overlap, as those of the base kinds.
They are judged by labelers that vote for, against or not at all: regular
expressions on the value, a gazetteer of naming words before it, and the context
(assignment signs, quotes, plain prose).  Votes are counted by pattern over the whole
corpus; expectation-maximisation on those counts estimates how reliable each
labeler is for data and non-data, and a logistic span classifier is trained on
the resulting probabilities.  Its score decides which candidates are added.

Only array functions are used, so a document's spans are found in its own row,
with no shuffle; the driver sees one count per vote pattern (a few thousand at
most, whatever the corpus).  Places are code points.  Sums along an array go
by blocks, so a text with very many matches does not cost their square.

The patterns are written with look-behinds and possessive quantifiers that
give the same matches as the plain ones (tests compare them) but never
backtrack over long runs.  NULL text is empty: no spans.  Rows are independent,
so repeated rows give equal results; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 64
NOWHERE = 1 << 40       # behind every text
LEFT, RIGHT = 24, 8     # code points of context

# kind, pattern, condition to look at all, check of a match x
LOCAL = "[A-Za-z0-9._%+-]"
JOINED = "[A-Za-z0-9_+/-]"
MIXED = "(?=[A-Za-z_+/-]*+[0-9])(?=[0-9_+/-]*+[A-Za-z])"     # a letter and a digit
QUOTE, CLOSING = "[\"'`]", r"[,;.)\]}>]"
# fixed values: naming words in front of a value
SURE_WORDS = "passwor[dt]|passwd|passphrase|pwd|secret|credential|api.?key|access.?key|" \
             "kennwort|mot de passe|contrase.a"
SECRET_WORDS = "password|passwd|passphrase|pwd|secret|token|credential|auth|bearer|api.?key|access.?key|key"
PHONE_WORDS = "phone|telephone|tel|call|mobile|cell|fax|whatsapp|contact"
ID_WORDS = "ssn|social security|national id|tax id|id no|identity"
BASE = [
    ("email",
     rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
     "contains({t}, '@')", "true"),
    ("ip",
     r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
     "{t} rlike '[0-9][.][0-9]'",
     r"rlike(x, '^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
     r"(?:[.]0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}$')"),
    ("card",
     r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
     "{t} rlike '[0-9]'",
     "luhn_check(translate(x, ' -', ''))"),
    ("phone",
     r"\+[0-9][ ().0-9-]+[0-9]",
     "contains({t}, '+')",
     "length(regexp_replace(x, '[^0-9]', '')) between 8 and 15"),
]
CANDIDATES = [
    ("secret",
     r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])(?=[0-9]*+[A-Za-z])[A-Za-z0-9]{16,}+",
     "{t} rlike '[0-9]'"),
    ("key",
     rf"(?<!{JOINED})(?=[_+/-]*+[A-Za-z0-9]++[_+/-]++[A-Za-z0-9]){MIXED}{JOINED}{{16,}}+={{0,2}}+",
     "{t} rlike '[0-9]'"),
    ("password",
     # the first lookbehinds only save time
     rf"(?<=[:=>\x20\t\"'`])(?<=[:=>][\x20\t]{{0,2}}{QUOTE}?)"
     rf"(?<=(?i:{SURE_WORDS}|{SECRET_WORDS}){QUOTE}?\]?[\x20\t]{{0,2}}(?::=|=>|={{1,3}}|:)"
     rf"[\x20\t]{{0,2}}{QUOTE}?)(?![:=>])"
     rf"(?!{MIXED}{JOINED}{{16,}}+={{0,2}}+{CLOSING}*+(?:\s|{QUOTE}|\z))"
     rf"(?:[^\s\"'`,;.)\]}}>]++|{CLOSING}++(?=[^\s\"'`]))++",
     "contains({t}, ':') or contains({t}, '=')"),
    ("local_phone",
     r"(?<![0-9.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])",
     "{t} rlike '[0-9]'"),
    ("national_id",
     r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
     "{t} rlike '[0-9]'"),
]
KINDS = [b[0] for b in BASE] + [c[0] for c in CANDIDATES]

# labelers on a candidate c (kind, value, before, after): condition for, against
LABELERS = [
    # regular expressions on the value
    ("known_shape",
     "c.value rlike '^(?:AKIA|ASIA)[0-9A-Z]{16}$|^(?:ghp|gho|glpat|xox[a-z]|sk)[0-9A-Za-z]{16,}$'"
     " or c.value rlike '^(?:gh[a-z]|github_pat|glpat|xox[a-z]|[sp]k)[-_][0-9A-Za-z_-]{16,}$'"
     " or c.kind = 'local_phone' and c.value rlike '^[(]?[2-9]'"
     " or c.kind = 'national_id' and not c.value rlike '^(?:000|666|9)'",
     "c.value rlike '^[(]?(?:000|0+1?234)' or c.value rlike '^([0-9A-Za-z])\\\\1+$'"
     " or c.kind = 'password' and lower(c.value) rlike "
     "'^(?:[$%{<\\\\[*].*|none|null|true|false|required|optional|changeme|your.*|[.]+|x+)$'"),
    ("random_shape",
     "c.kind = 'secret' and (c.value rlike '^[0-9a-f]{16,}$' or "
     "length(regexp_replace(regexp_replace(c.value, '[0-9]+', '0'), '[A-Za-z]+', '')) >= 3)"
     " or c.kind = 'key' and c.value rlike '[A-Za-z][0-9]+[A-Za-z].*[0-9][A-Za-z]'"
     " or c.kind = 'password' and (c.value rlike '[0-9]' and c.value rlike '[A-Za-z]' or "
     "c.value rlike '^[0-9]{4,}$|[A-Za-z0-9][!#$%&*+?@^_~-]|[a-z][A-Z]')",
     "c.kind = 'secret' and c.value rlike '^[A-Za-z]+[0-9]{1,4}$|^[0-9]{1,4}[A-Za-z]+$'"
     " or c.kind = 'key' and c.value rlike "   # words and numbers: paths, dates, names
     "'^[_+/-]*+(?:(?:[A-Za-z]++[0-9]{0,4}+|[0-9]++)(?:[_+/-]++|$))++$'"
     " or c.kind = 'password' and c.value rlike '^[^0-9]{0,3}$|^[\\\\p{L}][\\\\p{Ll}]*$'"),
    # gazetteer in front
    ("named",
     f"c.kind in ('secret', 'key') and c.before rlike '(?:{SECRET_WORDS})[^a-z0-9]{{1,6}}$' or "
     f"c.kind = 'password' and c.before rlike '(?:{SURE_WORDS})[^a-z0-9]{{1,6}}$' or "
     f"c.kind = 'local_phone' and c.before rlike '(?:^|[^a-z])(?:{PHONE_WORDS})[^a-z0-9]{{1,6}}$' or "
     f"c.kind = 'national_id' and c.before rlike '(?:^|[^a-z])(?:{ID_WORDS})[^a-z0-9]{{1,6}}$'",
     "c.kind = 'password' or "   # every one follows a naming word; these are also words of prose
     "c.before rlike '(?:isbn|doi|sha|commit|version|build|page|vol|http[^ ]*)[^a-z0-9]{0,6}$'"),
    # context
    ("assigned",
     "c.before rlike '[=:] ?[\"\\']?$' and (c.kind != 'password' or c.before rlike '[=\"\\']$|= $')",
     "c.before rlike '[/#_.]$' or c.after rlike '^[/_]'"),
    ("stands_alone",
     "(c.before = '' or c.before rlike '[ \"\\'=:(\\n]$') and c.after rlike '^(?:$|[ \"\\',.;)\\n])'",
     "c.before rlike '[a-z0-9-]$' or c.after rlike '^[A-Za-z0-9-]'"),
]
EXTRA = [  # features of the classifier beside the votes
    ("quoted", "c.before rlike '[\"\\']$' and c.after rlike '^[\"\\']'"),
    ("long", "length(c.value) >= 32"),
    ("upper", "c.value rlike '[A-Z]' and not c.value rlike '[a-z]'"),
]

PRIOR_WEIGHT = 10.0     # candidates that the first beliefs count for
EM_ROUNDS = 50
FIT_ROUNDS = 400
PENALTY = 0.01
THRESHOLD = 0.5


def _prefix(df: DataFrame, array: str, out: str, fold: str = "s + x", zero: str = "0L") -> DataFrame:
    """Add ``out``: the fold over each array's elements before each place (one
    more than the array is long), by blocks."""
    inner = f"aggregate(slice(v, %s, %s), {zero}, (s, x) -> {fold})"
    blocks = f"transform(sequence(0, size(v) div {BLOCK}), k -> " \
        + inner % (f"k * {BLOCK} + 1", str(BLOCK)) + ")"
    before = _bound(blocks, "b", f"transform(sequence(0, size(b) - 1), k -> "
                                 f"aggregate(slice(b, 1, k), {zero}, (s, x) -> {fold}))")
    tail = f"aggregate(slice(v, (i div {BLOCK}) * {BLOCK} + 1, i % {BLOCK}), " \
           f"get(e, i div {BLOCK}), (s, x) -> {fold})"
    return df.withColumn(out, F.expr(_bound(array, "v", _bound(
        before, "e", f"transform(sequence(0, size(v)), i -> {tail})"))))


def _bound(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is evaluated once.  (A column
    of its own that only a lambda reads would be inlined into the lambda, and
    evaluated for every element.)"""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _with_matches(df: DataFrame, text: str, kind: str, pattern: str, when: str, check: str,
                  context: bool = False) -> DataFrame:
    """Add ``s_<kind>``: array of (kind, start, end) or, with context, also
    (value, before, after)."""
    m, g, a, p = (f"_{kind}_{x}" for x in "mgap")
    df = df.withColumn(m, F.expr(
        f"if({when.format(t=text)}, regexp_extract_all({text}, {_sql(pattern)}, 0), array())"))
    # the texts between the matches give the places, and the context
    around = f", lower(right(get(g, i), {LEFT})) as before, left(get(g, i + 1), {RIGHT}) as after"
    df = df.withColumn(g, F.expr(
        f"if(size({m}) = 0, array(), " + _bound(
            f"split({text}, {_sql(pattern)}, -1)", "g",
            f"transform({m}, (x, i) -> struct(cast(char_length(get(g, i)) + "
            f"coalesce(char_length(get({m}, i - 1)), 0) as bigint) as step"
            f"{around if context else ''}))") + ")"))
    df = df.withColumn(a, F.expr(f"{g}.step"))
    df = _prefix(df, a, p)
    fields = f"'{kind}' as kind, get({p}, i + 1) as start, get({p}, i + 1) + char_length(x) as end"
    if context:
        fields += f", x as value, get({g}, i).before as before, get({g}, i).after as after"
    df = df.withColumn(f"s_{kind}", F.expr(
        f"filter(transform({m}, (x, i) -> if({check}, struct({fields}), null)), x -> x is not null)"))
    return df.drop(m, g, a, p)


def with_base(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the base spans: ``s_email``, ``s_ip``, ``s_card``, ``s_phone``."""
    for kind, pattern, when, check in BASE:
        df = _with_matches(df, text, kind, pattern, when, check)
    return df


def with_candidates(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``candidates``: (kind, start, end, bits), none overlapping a base span;
    ``bits`` holds the votes and features."""
    for kind, pattern, when in CANDIDATES:
        df = _with_matches(df, text, kind, pattern, when, "true", context=True)
    df = df.withColumn("_base", F.expr(
        "concat(" + ", ".join(f"s_{b[0]}" for b in BASE) + ")"))
    df = df.withColumn("_found", F.expr(
        "concat(" + ", ".join(f"s_{c[0]}" for c in CANDIDATES) + ")"))
    df = _apart(df, "_found", "_base", "_all")
    bits = [f"cast({cond} as int) * {1 << i}" for i, cond in enumerate(_conditions())]
    df = df.withColumn("candidates", F.expr(
        f"transform(_all, c -> struct(c.kind as kind, c.start as start, c.end as end, "
        f"{' + '.join(bits)} as bits))"))
    return df.drop("_base", "_found", "_all", *[f"s_{c[0]}" for c in CANDIDATES])


def _apart(df: DataFrame, spans: str, others: str, out: str) -> DataFrame:
    """Add ``out``: the elements of ``spans`` that overlap none of ``others``.  Both are
    laid in one row by their starts; what a span must not overlap is then the farthest
    end of the others before it and the next start of one behind it."""
    row, ends, starts, far, near = (f"_{out}_{x}" for x in ("row", "ends", "starts", "far", "near"))
    df = df.withColumn(row, F.expr(
        f"array_sort(concat(transform({others}, b -> struct(b.start as start, -1 as i, b.end as end)), "
        f"transform({spans}, (c, i) -> struct(c.start as start, i, c.end as end))))"))
    df = df.withColumn(ends, F.expr(f"transform({row}, x -> if(x.i < 0, x.end, 0L))"))
    df = df.withColumn(starts, F.expr(f"reverse(transform({row}, x -> if(x.i < 0, x.start, {NOWHERE}L)))"))
    df = _prefix(df, ends, far, "greatest(s, x)")
    df = _prefix(df, starts, near, "least(s, x)", f"{NOWHERE}L")
    free = "x.i >= 0 and get(f, k) <= x.start and get(n, size(r) - 1 - k) >= x.end"
    kept = _bound(row, "r", _bound(far, "f", _bound(
        near, "n", f"filter(transform(r, (x, k) -> if({free}, x.i, -1)), i -> i >= 0)")))
    return df.withColumn(out, F.expr(_bound(
        spans, "z", f"transform(array_sort({kept}), i -> get(z, i))"))).drop(
        row, ends, starts, far, near)


def _conditions() -> list[str]:
    out = []
    for _, yes, no in LABELERS:
        out += [f"({yes})", f"(({no}) and not ({yes}))"]
    out += [f"({cond})" for _, cond in EXTRA]
    return out + [f"(c.kind = '{k}')" for k, _, _ in CANDIDATES]


def vote_counts(docs: DataFrame) -> dict[int, int]:
    """Candidates of the whole corpus by vote and feature pattern."""
    rows = with_candidates(with_base(docs.select(F.coalesce("text", F.lit("")).alias("text"))))
    # outer: a filter below the generator would repeat the matching in it
    counts = rows.select(F.explode_outer("candidates.bits").alias("bits")) \
        .where("bits is not null").groupBy("bits").count()
    return {r["bits"]: r["count"] for r in counts.collect()}


def _votes(bits: int) -> list[int]:
    """1 for, 2 against, 0 no vote, by labeler."""
    return [bits >> 2 * k & 3 for k in range(len(LABELERS))]


def _kind_bit(kind: str) -> int:
    return 2 * len(LABELERS) + len(EXTRA) + [c[0] for c in CANDIDATES].index(kind)


def _kind(bits: int) -> int:
    return (bits >> (2 * len(LABELERS) + len(EXTRA))).bit_length() - 1


def label_model(counts: dict[int, int]) -> dict[int, float]:
    """Probability of each pattern to be personal data, by expectation-
    maximisation over the labelers' reliabilities (kinds have shares of their
    own).  First beliefs: a vote is right four times in five."""
    first = {1: (0.4, 0.1), 2: (0.1, 0.4), 0: (0.5, 0.5)}   # vote: (if data, if not)
    share = [0.5] * len(CANDIDATES)
    rate = [dict(first) for _ in LABELERS]
    prob: dict[int, float] = {}
    for _ in range(EM_ROUNDS):
        for bits in counts:
            yes, no = math.log(share[_kind(bits)]), math.log(1 - share[_kind(bits)])
            for k, v in enumerate(_votes(bits)):
                yes, no = yes + math.log(rate[k][v][0]), no + math.log(rate[k][v][1])
            prob[bits] = 1 / (1 + math.exp(max(-500.0, min(500.0, no - yes))))
        for j in range(len(share)):
            own = [(prob[b], n) for b, n in counts.items() if _kind(b) == j]
            share[j] = (sum(p * n for p, n in own) + PRIOR_WEIGHT / 2) / (
                sum(n for _, n in own) + PRIOR_WEIGHT)
        for k in range(len(LABELERS)):
            for side in (0, 1):
                mass = {v: PRIOR_WEIGHT * first[v][side] for v in first}
                for b, n in counts.items():
                    mass[_votes(b)[k]] += n * (prob[b] if side == 0 else 1 - prob[b])
                total = sum(mass.values())
                for v in first:
                    pair = list(rate[k][v])
                    pair[side] = mass[v] / total
                    rate[k][v] = tuple(pair)
    return prob


def span_classifier(counts: dict[int, int]) -> list[float]:
    """Weights (bias first) of a logistic classifier on the pattern bits, trained
    on the label model's probabilities."""
    prob = label_model(counts)
    width = 2 * len(LABELERS) + len(EXTRA) + len(CANDIDATES)
    weights = [0.0] * (width + 1)
    # a few votes of prior evidence, so that a corpus without candidates works too
    rows = [([1.0] + [float(b >> i & 1) for i in range(width)], prob[b], float(n))
            for b, n in sorted(counts.items())]
    for k in range(len(LABELERS)):
        for v, target in ((1, 0.8), (2, 0.2)):
            x = [1.0] + [0.0] * width
            x[1 + 2 * k + v - 1] = 1.0
            rows.append((x, target, PRIOR_WEIGHT / len(LABELERS)))
    total = sum(n for _, _, n in rows)
    rate = 4.0 / width
    for _ in range(FIT_ROUNDS):
        slope = [PENALTY * w for w in weights]
        slope[0] = 0.0
        for x, target, n in rows:
            z = sum(w * f for w, f in zip(weights, x))
            error = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - target) * n / total
            for i, f in enumerate(x):
                if f:
                    slope[i] += error
        weights = [w - rate * s for w, s in zip(weights, slope)]
    return weights


def _score(weights: list[float]) -> str:
    terms = [f"{weights[0]!r}D"] + [f"if(c.bits & {1 << i} > 0, {w!r}D, 0D)"
                                    for i, w in enumerate(weights[1:])]
    return f"1 / (1 + exp(-({' + '.join(terms)})))"


def _outvoted() -> str:
    """Paths, dates and words of prose become keys and passwords too: without more
    votes for than against they stay, also if the corpus teaches nothing on them."""
    yes = sum(1 << 2 * k for k in range(len(LABELERS)))
    return (f"c.bits & {sum(1 << _kind_bit(k) for k in ('key', 'password'))} > 0 and "
            f"bit_count(c.bits & {yes}) <= bit_count(c.bits & {2 * yes})")


def find(docs: DataFrame, weights: list[float] | None = None, text: str = "text") -> DataFrame:
    """Add to ``docs`` the base spans ``s_<kind>`` and ``added`` (kind, start,
    end, score); ``docs`` should have no other columns of these names.
    ``weights``: a classifier trained before, else it is trained on ``docs``."""
    if weights is None:
        weights = span_classifier(vote_counts(docs))
    found = with_candidates(with_base(docs.withColumn(
        "_text", F.coalesce(text, F.lit(""))), "_text"), "_text")
    scored = found.withColumn("added", F.expr(
        f"filter(transform(candidates, c -> struct(c.kind as kind, c.start as start, c.end as end, "
        f"if({_outvoted()}, 0D, {_score(weights)}) as score)), c -> c.score >= {THRESHOLD}D)"))
    return scored.drop("candidates", "_text")


def _named(kinds: list[str], array: str | None = None) -> Column:
    parts = ", ".join(
        f"transform({array or 's_' + k}, c -> concat(c.kind, ':', c.start, ':', c.end))" for k in kinds)
    return F.expr(f"array_join(concat({parts}), ',')")


def summary(docs: DataFrame) -> DataFrame:
    """Per document: base counts, digest of the base spans, all spans as text."""
    base = [b[0] for b in BASE]
    rows = find(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    rows = rows.withColumn("_base", _named(base)).withColumn("_added", F.expr(
        "array_join(transform(added, c -> concat(c.kind, ':', c.start, ':', c.end)), ',')"))
    return rows.select(
        "doc_id", *[F.size(f"s_{k}").cast("long").alias(f"n_{k}") for k in base],
        F.sha2(F.col("_base"), 256).alias("base_sha256"),
        F.concat_ws(",", F.when(F.col("_base") != "", F.col("_base")),
                    F.when(F.col("_added") != "", F.col("_added"))).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by ``[KIND]`` and ``n_chars``
    (if there is one) counted anew; overlapping spans become one, named after
    the first.  Other columns, and rows without spans, stay as they are."""
    columns = docs.columns
    df = find(docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), "text"))
    df = df.withColumn("spans", F.expr(
        "array_sort(transform(concat(" + ", ".join(f"s_{b[0]}" for b in BASE)
        + ", transform(added, c -> struct(c.kind as kind, c.start as start, c.end as end))), "
        "c -> struct(c.start as start, c.end as end, c.kind as kind)))"))
    df = df.withColumn("ends", F.expr("transform(spans, c -> c.end)"))
    df = _prefix(df, "ends", "reach", "greatest(s, x)")
    # blocks of spans with the text they cover, so that cutting stays local
    df = df.withColumn("parts", F.expr(f"""
        transform(sequence(0, greatest(size(spans) - 1, 0) div {BLOCK}), k ->
          struct(get(reach, k * {BLOCK}) as at, slice(spans, k * {BLOCK} + 1, {BLOCK}) as spans,
                 slice(reach, k * {BLOCK} + 1, {BLOCK}) as reach,
                 substring(text, cast(get(reach, k * {BLOCK}) as int) + 1,
                   cast(get(reach, least((k + 1) * {BLOCK}, size(spans)))
                        - get(reach, k * {BLOCK}) as int)) as base))"""))
    df = df.withColumn("cut", F.expr("""
        concat(
          array_join(transform(parts, p -> array_join(transform(p.spans, (c, i) ->
            if(c.start >= get(p.reach, i),
               concat(substring(p.base, cast(get(p.reach, i) - p.at as int) + 1,
                                cast(c.start - get(p.reach, i) as int)), '[', upper(c.kind), ']'),
               '')), '')), ''),
          substring(text, cast(get(reach, size(spans)) as int) + 1))"""))
    none = F.size("spans") == 0
    new = {"text": F.col("cut"), "n_chars": F.char_length("cut").cast("long")}
    return df.select(*[
        (F.when(none, F.col(f"row.`{c}`")).otherwise(new[c]) if c in new else F.col(f"row.`{c}`"))
        .alias(c) for c in columns])
