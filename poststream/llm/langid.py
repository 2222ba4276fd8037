"""Language identification by sparse multinomial logistic regression.

Features: character n-grams (1 to 3) of the lower-cased text, other signs than
letters read as a blank, hashed to ``BUCKETS``; weight ``log(1 + count) * idf``,
scaled to length one.  Document frequencies are counted over all training rows
(one vector per task, summed on executors).  The weights are trained with
follow-the-regularised-leader (FTRL-proximal), whose L1 part leaves most of
them zero and whose L2 part keeps the rest small, on a sample of at most
``SAMPLE_DOCS`` labelled rows (at least ``LEAST_PER_LANG`` of each language are
wanted), the same share of texts of each language as far as there are enough.
A fifth of the sample is not trained on; the temperature that makes its
predicted probabilities most likely scales the scores.

The model tells at most ``SAMPLE_DOCS // LEAST_PER_LANG`` languages apart, those with
the most training rows (of equal ones the first by name), since each wants
``LEAST_PER_LANG`` rows of the sample.  A language value with fewer training rows than
that, and than one in ``RARE`` of all, is left out, so that stray values of a dirty
column are not learned; if that leaves none, all count.  So the model (buckets x
languages), the sample and what the driver sees have a bound, whatever the table holds.

A NULL text, or one without a letter, is ``und`` with score 0.  A table with no
labelled row gives ``und`` for all texts.  Rows with NULL language are not
learned from.  Equal texts get equal results.  An empty table gives no rows.  Texts of
any length are read whole.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poststream.llm.arrowtext import whole_texts
from poststream.llm.tables import stored
from poststream.llm.vectors import gather

BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
SAMPLE_DOCS = 4000
LEAST_PER_LANG = 20
RARE = 100
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05
HELD_SHARE = 5          # one sampled row in five sets the temperature
UNKNOWN = "und"
OTHER_SIGNS = ((0x80, 0xAA), (0xAB, 0xB5), (0xB6, 0xBA), (0xBB, 0xC0), (0x2000, 0x2070),
               (0x20A0, 0x20D0), (0x2190, 0x2C00), (0x3000, 0x3005))


def _table() -> np.ndarray:
    """Code point below 0x3100 as it is read: itself, or a blank."""
    table = np.arange(0x3100, dtype=np.uint32)
    for c in range(128):
        if not chr(c).isalpha():
            table[c] = 32
    for a, b in OTHER_SIGNS:
        table[a:b] = 32
    return table


_READ = _table()


def buckets(text: str) -> np.ndarray:
    """Bucket of every n-gram of a whole text (with a blank at both ends)."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    points = np.where(points < len(_READ), _READ[np.minimum(points, len(_READ) - 1)], points)
    parts = []
    for n in ORDERS:
        h = np.full(max(0, len(points) - n + 1), n, np.uint32)
        for k in range(n):
            h = (h ^ points[k: len(points) - n + 1 + k]) * np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
        parts.append((h * np.uint32(0x85EBCA6B)) >> np.uint32(18))
    return np.concatenate(parts)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(buckets present, their counts)."""
    count = np.bincount(buckets(text), minlength=BUCKETS)
    present = np.flatnonzero(count)
    return present, count[present]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray = field(repr=False)     # buckets x languages
    bias: np.ndarray = field(repr=False)
    temperature: float = 1.0

    def vector(self, present: np.ndarray, counts: np.ndarray) -> np.ndarray:
        x = np.log1p(counts) * self.idf[present]
        size = np.sqrt((x * x).sum())
        return x / size if size else x

    def logits(self, present: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.vector(present, counts) @ self.weights[present] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return UNKNOWN, 0.0
        p = softmax(self.logits(*counted(text)) / self.temperature)
        best = int(np.argmax(p))
        return self.langs[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_langs: int,
         epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias after ``epochs`` passes over (buckets, values) rows."""
    z = np.zeros((BUCKETS + 1, n_langs))
    n = np.zeros((BUCKETS + 1, n_langs))

    def weights(i):
        free = np.abs(z[i]) > L1
        return np.where(free, -(z[i] - np.sign(z[i]) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2), 0.0)

    for _ in range(epochs):
        for (present, value), label in zip(rows, labels):
            i = np.append(present, BUCKETS)
            x = np.append(value, 1.0)
            w = weights(i)
            error = softmax(x @ w)
            error[label] -= 1.0
            g = x[:, None] * error[None, :]
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - sigma * w
            n[i] += g * g
    out = weights(np.arange(BUCKETS + 1))
    return out[:-1], out[-1]


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature that makes the labels most likely (golden section).

    The labels count as right but for one in ``rows + 2``, so that a sample
    without a mistake doesn't ask for endless certainty."""
    miss = 1.0 / (len(labels) + 2)
    target = np.full(logits.shape, miss / max(1, logits.shape[1] - 1))
    target[np.arange(len(labels)), labels] = 1 - miss

    def loss(t: float) -> float:
        p = softmax(logits / np.exp(t))
        return -(target * np.log(np.maximum(p, 1e-12))).sum(axis=1).mean()
    a, b = np.log(0.05), np.log(20.0)
    ratio = (np.sqrt(5) - 1) / 2
    for _ in range(40):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        if loss(c) <= loss(d):
            b = d
        else:
            a = c
    return float(np.exp((a + b) / 2))


def learned_languages(rows: DataFrame) -> dict[str, int]:
    """The languages to learn, with their rows (see above)."""
    counts = stored(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    total = counts.agg(F.sum("n")).first()[0] or 0
    most = counts.orderBy(F.desc("n"), "lang").limit(SAMPLE_DOCS // LEAST_PER_LANG).collect()
    sizes = {r["lang"]: r["n"] for r in most}
    least = min(LEAST_PER_LANG, total / RARE)
    return {name: n for name, n in sizes.items() if n >= least} or sizes


def train(rows: DataFrame, lang: str = "lang", key: str = "doc_id") -> Model:
    """Train on all ``rows`` with a text and a language."""
    rows = whole_texts(rows, F.col(lang).alias("lang"),
                       F.pmod(F.xxhash64(key, F.lit("langid")), F.lit(1 << 30)).alias("draw")) \
        .where("text is not null and lang is not null")
    sizes = learned_languages(rows)
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros(BUCKETS), np.zeros((BUCKETS, 0)), np.zeros(0))
    want = max(LEAST_PER_LANG, SAMPLE_DOCS // len(langs))

    def presence(vector: np.ndarray, batch: pa.RecordBatch) -> None:
        for text_ in batch.column(0).to_pylist():
            vector[:BUCKETS] += np.bincount(buckets(text_), minlength=BUCKETS) > 0
            vector[BUCKETS] += 1
    seen = gather(rows.select("text"), BUCKETS + 1, presence)
    idf = np.log((1.0 + seen[-1]) / (1.0 + seen[:-1])) + 1.0

    shares = rows.sparkSession.createDataFrame(
        [(name, int((1 << 30) * min(1.0, want / n))) for name, n in sizes.items()],
        "lang string, share long")

    def count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [counted(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2),
                 pa.array([p.astype(np.uint16).tobytes() for p, _ in got], pa.binary()),
                 pa.array([c.astype(np.uint32).tobytes() for _, c in got], pa.binary())],
                ["lang", "draw", "present", "counts"])
    sample = (rows.join(F.broadcast(shares), "lang")     # a row per learned language
              .where(F.col("draw") < F.col("share")).select("text", "lang", "draw")
              .mapInArrow(count_rows, "lang string, draw long, present binary, counts binary")
              .orderBy("draw", "lang", "present").limit(2 * want * len(langs)).collect())
    model = Model(langs, idf, np.zeros((BUCKETS, len(langs))), np.zeros(len(langs)))
    pairs = [(np.frombuffer(r["present"], np.uint16).astype(np.int64),
              np.frombuffer(r["counts"], np.uint32)) for r in sample]
    number = {name: i for i, name in enumerate(langs)}
    y = np.array([number[r["lang"]] for r in sample])
    held = np.array([r["draw"] % HELD_SHARE == 0 for r in sample], bool)
    if held.all() or not held.any():
        held = np.zeros(len(sample), bool)
    fit = np.flatnonzero(~held)
    # draws are small first; mix the order of languages and rows
    fit = fit[np.argsort([hash((int(sample[i]["draw"]) * 2654435761) % (1 << 32)) for i in fit],
                         kind="stable")]
    model.weights, model.bias = ftrl(
        [(pairs[i][0], model.vector(*pairs[i])) for i in fit], y[fit], len(langs))
    if held.any():
        model.temperature = best_temperature(
            np.stack([model.logits(*pairs[i]) for i in np.flatnonzero(held)]), y[held])
    return model


def predictor(model: Model):
    """A column function: text -> struct(lang, score)."""
    packed = Model(model.langs, model.idf.astype(np.float32), model.weights.astype(np.float32),
                   model.bias.astype(np.float32), model.temperature)

    @F.pandas_udf("lang string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([packed.predict(t) for t in texts], columns=["lang", "score"])
    return predict


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2 (NULL reads as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, learned from the
    rows that are not held out."""
    docs = docs.select("doc_id", "text", "lang")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       predictor(model)("text").alias("p")).select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def in_known_language(docs: DataFrame, least_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (all columns) whose language is told with a score of
    ``least_score`` or more.  Texts without a letter go; if no row has a language
    to learn from, all others stay."""
    model = train(docs.where(~held_out(F.col("doc_id"))))
    if not model.langs:
        return docs.where(F.coalesce(F.rlike("text", F.lit(r"\p{L}")), F.lit(False)))
    told = predictor(model)("text")
    return docs.where((told["lang"] != UNKNOWN) & (told["score"] >= least_score))
