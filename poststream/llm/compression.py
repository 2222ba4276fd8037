"""Quality rules: base counts and compression bands.

Every whole text is compressed with zstandard, as one piece and in fixed chunks
of 256, 1,024 and 4,096 bytes, of each length that fits into it, however long it
is.  The last chunk of a length ends where the text ends and
counts by the bytes that no chunk before it holds, so every byte is in a chunk.
Repetitive text compresses too well, random text (keys, encoded binaries) hardly
at all, and a short text less than a long one, so the limits depend on the
length.  ``BANDS`` are limits set by hand, wide enough for any prose; ``fit_bands``
learns the lowest ratio of each length from good labelled texts: it lies just under
the ``LOW_QUANTILE`` of the ratios of all of them, in classes of doubling length (a
class with fewer than ``LEAST_GOOD`` keeps the set limit).  A text is rejected if its whole ratio lies outside the band
of its length, or if, at one of the chunk lengths, more than a quarter of its
bytes are in chunks outside the band of that length: so a good text with a
spoiled half, or the reverse, is judged by its parts too, from 512 bytes on (a
shorter one has no two chunks apart).  Texts under 256 bytes have no limits:
there the ratio says more about the length than about the text.

NULL and empty texts have no words and fail the base rule.  One row comes out
per row in, repeated rows included; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poststream.llm.arrowtext import IS_BLANK, codes, per_text, pieces, release, slices, text_buffer, \
    whole_texts, word_bounds
from poststream.session import stored

LEVEL = 3
CHUNK = 4096
SHORT_CHUNKS = (256, 1024)
LEAST_GOOD = 10
BINS = 4096
LOW_QUANTILE, MARGIN = 0.002, 0.99
CLASSES = (256, 512, 1024, 2048, 4096, 8192, 16384)
CHUNK_SHARE = 0.25
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = b"#*$%&|<>"

# set limits: least bytes, lowest and highest ratio of compressed to plain size
BANDS = [
    (0, 0.00, 9.99),
    (256, 0.30, 0.85),
    (1024, 0.25, 0.72),
    (4096, 0.20, 0.65),
    (16384, 0.15, 0.62),
]

IS_SYMBOL = np.zeros(256, bool)
IS_SYMBOL[list(SYMBOLS)] = True

COLUMNS = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
           "n_repeat_words long, n_bytes long, ratio double, odd_chunks double")


def in_band(size: np.ndarray, ratio: np.ndarray, bands: list = BANDS) -> np.ndarray:
    """Is each ratio inside the band of its length?"""
    least = np.array([b[0] for b in bands])
    k = np.searchsorted(least, size, side="right") - 1
    return (ratio >= np.array([b[1] for b in bands])[k]) & (ratio <= np.array([b[2] for b in bands])[k])


def _same(values: np.ndarray) -> np.ndarray:
    """Code of each value among the distinct ones."""
    import pandas as pd
    return pd.factorize(values)[0]


def repeat_words(code: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Words of each text in three-word windows found twice or more in it."""
    n = len(code)
    flags = np.zeros(n, bool)
    if n >= 3:
        row = np.repeat(np.arange(len(before) - 1), np.diff(before))
        at = np.flatnonzero(row[2:] == row[:-2])
        wide = int(code.max()) + 1
        pair = _same(code[at] * wide + code[at + 1])
        triple = _same(pair * wide + code[at + 2])
        here = _same(row[at] * (int(triple.max(initial=0)) + 1) + triple)
        again = at[np.bincount(here)[here] > 1] if len(here) else at
        for k in range(3):
            flags[again + k] = True
    return per_text(flags, before)


def dup_lines(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of the same text."""
    ends_of = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate((off[:-1], ends_of + 1)))
    starts = starts[starts < len(data)]
    line_of = np.searchsorted(off, starts, side="right") - 1
    next_break = np.append(ends_of, len(data))[np.searchsorted(ends_of, starts)]
    ends = np.minimum(next_break, off[line_of + 1])
    solid = np.concatenate(([0], np.cumsum(~IS_BLANK[data], dtype=np.int64)))
    keep = solid[ends] > solid[starts]
    starts, ends, line_of = starts[keep], ends[keep], line_of[keep]
    out = np.zeros(len(off) - 1, np.int64)
    if len(starts):
        code, _ = codes(pieces(data, starts, ends))
        key = _same(line_of * (int(code.max()) + 1) + code)
        _, first = np.unique(key, return_index=True)
        np.add.at(out, line_of, 1)
        np.subtract.at(out, line_of[first], 1)
    return out


def odd_share(view: memoryview, compressor, bands: list = BANDS) -> float:
    """Share of a text's bytes in chunks outside the band of their length; the
    largest over the chunk lengths."""
    n, out = len(view), 0.0
    for size in (*SHORT_CHUNKS, CHUNK):
        if n < size:
            break
        at = list(range(0, n - size + 1, size))
        own = [size] * len(at)
        if n % size:   # the last chunk ends with the text
            at.append(n - size)
            own.append(n % size)
        got = np.array([len(compressor.compress(view[k: k + size])) / size for k in at])
        odd = ~in_band(np.full(len(got), size), got, bands)
        out = max(out, float(np.array(own)[odd].sum()) / n)
    return out


def measure(part: pa.RecordBatch, compressor, bands: list = BANDS) -> pa.RecordBatch:
    """Counts and ratios of a slice of (doc_id, text)."""
    data, off = text_buffer(part.column(1))
    rows = len(off) - 1
    starts, ends, before = word_bounds(data, off)
    solid = ~IS_BLANK[data]
    repeats = np.zeros(rows, np.int64)
    if len(starts):
        repeats = repeat_words(codes(pieces(data, starts, ends))[0], before)
    size = np.diff(off)
    ratio = np.ones(rows)
    odd = np.zeros(rows)
    view = memoryview(np.ascontiguousarray(data))
    for r in np.flatnonzero(size):
        a, b = int(off[r]), int(off[r + 1])
        ratio[r] = len(compressor.compress(view[a:b])) / (b - a)
        odd[r] = odd_share(view[a:b], compressor, bands)
    columns = [part.column(0), np.diff(before), per_text(solid & (data & 0xC0 != 0x80), off),
               per_text(IS_SYMBOL[data], off), dup_lines(data, off), repeats, size, ratio, odd]
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns],
        [c.split()[0] for c in COLUMNS.split(", ")])


def low_quantiles(sizes: DataFrame) -> dict[int, tuple[int, float]]:
    """Per class of (least, ratio): its count and the ``LOW_QUANTILE`` of its ratios,
    interpolated.  Exact, without a class in one group: counts per bin of ratios say
    in which bins the two ranks lie, and only those bins' values are counted singly."""
    bins = sizes.withColumn("bin", F.floor(F.least(F.col("ratio"), F.lit(2.0)) * BINS))
    count = F.count(F.lit(1)).alias("n")
    of: dict[int, list[tuple]] = {}
    for r in sorted(bins.groupBy("least", "bin").agg(count).collect()):     # at most 2 * BINS a class
        of.setdefault(r["least"], []).append((r["bin"], r["n"]))

    def at(values: list[tuple], rank: int):
        for value, n in values:
            if rank < n:
                return value, rank
            rank -= n
    ranks, wanted = {}, set()
    for c, counts in of.items():
        n = sum(k for _, k in counts)
        place = LOW_QUANTILE * (n - 1)
        ranks[c] = n, place, [at(counts, int(place)), at(counts, min(int(place) + 1, n - 1))]
        wanted |= {(c, b) for b, _ in ranks[c][2]}
    if not wanted:
        return {}
    chosen = F.concat_ws(":", "least", "bin").isin([f"{c}:{b}" for c, b in wanted])
    single: dict[tuple, list[tuple]] = {}
    for r in sorted(bins.where(chosen).groupBy("least", "bin", "ratio").agg(count).collect()):
        single.setdefault((r["least"], r["bin"]), []).append((r["ratio"], r["n"]))
    out = {}
    for c, (n, place, (low, high)) in ranks.items():
        a, b = (at(single[c, k], rank)[0] for k, rank in (low, high))
        out[c] = n, a + (b - a) * (place - int(place))
    return out


def fit_bands(docs: DataFrame, labels: DataFrame) -> list[tuple[int, float, float]]:
    """Limits with the lowest ratios learned from the texts that ``labels`` (doc_id,
    quality) call good (1).  Labels of no text, rows without an id, and texts under
    256 bytes teach nothing; without a good text the set limits come back."""
    good = labels.where("quality = 1").select("doc_id").distinct()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            for part in slices(batch):
                data, off = text_buffer(part.column(1))
                size = np.diff(off)
                view = memoryview(np.ascontiguousarray(data))
                at = np.flatnonzero(size >= CLASSES[0])
                ratio = [len(compressor.compress(view[int(off[r]): int(off[r + 1])])) / int(size[r]) for r in at]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(at)), pa.array(size[at], pa.int64()),
                     pa.array(ratio, pa.float64())], ["doc_id", "size", "ratio"])
        release()
    # every text is measured where it lies; only its ratio meets the labels
    least = F.greatest(*[F.when(F.col("size") >= c, c).otherwise(0) for c in CLASSES])
    sizes = stored(whole_texts(docs).where("doc_id IS NOT NULL AND text IS NOT NULL")
                   .mapInArrow(task, "doc_id long, size long, ratio double")
                   .join(good, "doc_id", "left_semi").select(least.alias("least"), "ratio"), "good-ratios")
    found = low_quantiles(sizes)
    out = [BANDS[0]]
    for c in CLASSES:
        _, low, high = [b for b in BANDS if b[0] <= c][-1]
        if c in found and found[c][0] >= LEAST_GOOD:
            low = found[c][1] * MARGIN
        out.append((c, low, high))
    return out


def compression_bands(docs: DataFrame, bands: list | None = None) -> DataFrame:
    """(doc_id, counts, ratio, odd_chunks, base_failed, kept) of every document;
    ``bands``: (least bytes, lowest, highest ratio), ``BANDS`` or ``fit_bands``."""
    bands = bands or BANDS

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            for part in slices(batch):
                yield measure(part, compressor, bands)
        release()
    counted = whole_texts(docs).mapInArrow(task, COLUMNS)
    failed = (F.col("n_words") < MIN_WORDS) | \
        (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    band = F.lit(False)
    for (least, low, high), above in zip(bands, [b[0] for b in bands[1:]] + [None]):
        here = F.col("n_bytes") >= least
        if above is not None:
            here &= F.col("n_bytes") < above
        band |= here & F.col("ratio").between(low, high)
    return counted.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & band & (F.col("odd_chunks") <= CHUNK_SHARE))
