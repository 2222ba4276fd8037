"""Importance resampling towards good text, with Gumbel top-k.

Two generative models over hashed word 1- and 2-grams are counted: one of the
target (texts labelled good and not toxic) and one of all raw texts.  A text's
weight is the log of its probability ratio under the two models, that is the
sum over its n-grams of ``log target / raw``.  (``tempered`` divides the sum by the root
of the number of n-grams, so that a long text does not win or lose by length alone;
it is then no longer the models' ratio.)  Adding Gumbel noise from a hash of the id and keeping the ``k`` largest draws
``k`` documents without replacement in proportion to their weights.

The raw model counts every document.  The target model is fitted on at most
about ``TARGET_DOCS`` labelled rows, drawn by a hash of their id.  ``k`` is the
share of good texts among the labelled ones times the number of documents,
unless given.

The k-th largest key is found by histograms: keys are counted in ranges, and
only the range that holds the k-th is split again.  Nothing is sorted but the
last range.  Rows with equal keys (repeated rows) stay or go together.  NULL and
empty texts weigh 0 words and get the least key.  Without good labels all
weights are 0 and the draw is uniform.  An empty table gives no rows; texts of any
length count whole; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poststream.llm.arrowtext import IS_BLANK, slices, text_buffer, whole_texts, word_bounds
from poststream.llm.tables import stored
from poststream.llm.vectors import gather

BITS = 14
BUCKETS = 1 << BITS
TARGET_DOCS = 10_000
RANGES = 4096
LAST_RANGE = 4096
STEP = np.uint64(0x100000001B3)
MIX = np.uint64(0x9E3779B97F4A7C15)


def ngram_buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every 1- and 2-gram, number of n-grams of each text); words
    are runs of non-blank characters with A-Z in lower case."""
    data, off = text_buffer(column)
    starts, ends, before = word_bounds(data, off)
    n = np.diff(before)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(len(n), np.int64)
    upper = (data >= 65) & (data <= 90)
    values = np.where(IS_BLANK[data], 0, data + 32 * upper.astype(np.uint8) + 1).astype(np.uint64)
    lens = ends - starts
    powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(int(lens.max()), STEP))))
    word_of = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(data))))
    inside = np.arange(starts[0], len(data)) - starts[word_of]
    values = values[starts[0]:] * powers[np.minimum(inside, len(powers) - 1)]
    word = np.add.reduceat(values, starts - starts[0])
    word = (word ^ (word >> np.uint64(29))) * MIX
    row = np.repeat(np.arange(len(n)), n)
    has_next = np.append(row[1:] == row[:-1], False)
    pair = (word * STEP + np.append(word[1:], np.uint64(0))) * MIX
    both = np.stack((word, np.where(has_next, pair, np.uint64(0))), axis=1)
    keep = np.stack((np.ones(len(word), bool), has_next), axis=1)
    out = (both[keep] >> np.uint64(64 - BITS)).astype(np.int64)
    return out, np.maximum(2 * n - 1, 0)


def good_ids(labels: DataFrame, at_most: int = TARGET_DOCS) -> tuple[DataFrame, float]:
    """(ids of at most about ``at_most`` good labelled documents, share of good ones)."""
    good = (F.coalesce(F.col("quality"), F.lit(0)) == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    row = labels.agg(F.count("*").alias("n"), F.sum(good.cast("long")).alias("good")).first()
    n, count = row["n"], row["good"] or 0
    draw = F.pmod(F.xxhash64("doc_id", F.lit("target")), F.lit(1 << 30))
    ids = labels.where(good & (draw < int((1 << 30) * min(1.0, at_most / max(1, count))))) \
        .select(F.col("doc_id").cast("long").alias("good_id")).distinct()
    return stored(ids, "resample-target"), (count / n if n else 1.0)


def log_ratio(docs: DataFrame, ids: DataFrame) -> np.ndarray:
    """log(target / raw) of every bucket, each count plus one."""
    rows = whole_texts(docs).join(ids, F.col("doc_id") == F.col("good_id"), "left") \
        .select("text", F.col("good_id").isNotNull().alias("good"))

    def count(vector: np.ndarray, batch: pa.RecordBatch) -> None:
        for part in slices(batch):
            found, n = ngram_buckets(part.column(0))
            vector[:BUCKETS] += np.bincount(found, minlength=BUCKETS)
            good = np.repeat(part.column(1).to_numpy(zero_copy_only=False).astype(bool), n)
            vector[BUCKETS:] += np.bincount(found[good], minlength=BUCKETS)
    total = gather(rows, 2 * BUCKETS, count)
    raw, target = total[:BUCKETS] + 1.0, total[BUCKETS:] + 1.0
    if total[BUCKETS:].sum() == 0:
        return np.zeros(BUCKETS)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weighed(docs: DataFrame, ratio: np.ndarray, tempered: bool = False) -> DataFrame:
    """(doc_id, n_grams, log_weight) of every document."""
    def task(batches):
        for batch in batches:
            for part in slices(batch):
                found, n = ngram_buckets(part.column(1))
                upto = np.concatenate(([0.0], np.cumsum(ratio[found])))
                end = np.cumsum(n)
                total = upto[end] - upto[end - n]
                if tempered:
                    total = total / np.sqrt(np.maximum(n, 1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n), pa.array(total)],
                    ["doc_id", "n_grams", "log_weight"])
    return whole_texts(docs).mapInArrow(
        task, "doc_id long, n_grams long, log_weight double")


def gumbel(doc_id: Column, seed: str) -> Column:
    """Gumbel noise from a hash of the id."""
    unit = (F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(unit))


def kth_largest(keys: DataFrame, key: str, k: int) -> float | None:
    """The k-th largest value of a double column (None if there is none)."""
    span = keys.agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(key).alias("n")).first()
    lo, hi, n = span["lo"], span["hi"], span["n"]
    if k < 1 or n < k:
        return None
    rows, above = keys.select(key), 0
    while True:
        inside = rows.where(F.col(key).between(lo, hi))
        width = (hi - lo) / RANGES
        if width == 0 or lo + width == lo:
            return float(hi if lo == hi else inside.orderBy(F.col(key).desc())
                         .limit(k - above).agg(F.min(key)).first()[0])
        part = F.least(F.floor((F.col(key) - lo) / width), F.lit(RANGES - 1)).cast("int")
        counts = {r["part"]: r for r in inside.groupBy(part.alias("part")).agg(
            F.count("*").alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).collect()}
        for p in sorted(counts, reverse=True):   # at most RANGES
            if above + counts[p]["n"] >= k:
                break
            above += counts[p]["n"]
        lo, hi = counts[p]["lo"], counts[p]["hi"]
        if counts[p]["n"] <= LAST_RANGE:
            return float(rows.where(F.col(key).between(lo, hi)).orderBy(F.col(key).desc())
                         .limit(k - above).agg(F.min(key)).first()[0])


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None,
             seed: str = "resample", tempered: bool = False) -> DataFrame:
    """(doc_id, n_grams, log_weight, key, kept) of every document."""
    ids, share = good_ids(labels)
    ratio = log_ratio(docs, ids)
    keyed = stored(weighed(docs, ratio, tempered).withColumn("key", F.when(
        F.col("n_grams") > 0, F.col("log_weight") + gumbel(F.col("doc_id"), seed))
        .otherwise(F.lit(-1e300))), "resample-keys")
    if k is None:
        k = round(share * keyed.count())
    least = kth_largest(keyed, "key", k)
    if least is None:   # nothing to draw, or fewer documents than k
        return keyed.withColumn("kept", F.lit(k > 0))
    return keyed.withColumn("kept", F.col("key") >= F.lit(least))
