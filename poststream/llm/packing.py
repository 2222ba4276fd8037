"""Harmonic packing of tokenized documents into fixed-length sequences.

A piece of ``r`` tokens belongs to class ``j = capacity // r``: ``j`` such
pieces fill one sequence.  Every worker fills the bins of each class with
exactly ``j`` pieces, with no word to the other workers.  A long document is
first cut into whole sequences; its rest is cut so that each piece lies just
below the reciprocal ``capacity / j`` of its class, which leaves little
padding.  Three steps:

1. in each task: tokenize, cut, fill bins; pieces of bins that are still open
   at the end of the task are marked as left over (at most one bin per class);
2. left-over pieces get a position in their class from counts per task and
   class (a small table), and again every ``j`` of them fill a sequence;
3. what then remains is less than one sequence per class, whatever the size of
   the corpus; it is laid end to end and cut at the capacity, and the last
   sequence is cut at powers of two so that it needs no padding.

The tokenized pieces are written once to a table below
``spark.checkpoint.dir``: a lost executor repeats its own task only.  NULL
text is empty (one end id).  Repeated rows are packed as often as they occur.
An empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from poststream.llm.arrowtext import release, slices, whole_texts
from poststream.llm.tables import stored
from poststream.llm.tokens import encoder, splitting_kind, with_end

CAPACITY = 2048
SLACK_SHARE = 64     # a piece may leave 1/64 of its length unused
FINE = 16            # pieces this short are not cut further
LEFT_SEQUENCES = 1 << 60
LAST_SEQUENCES = 1 << 61

PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "class int, sequence_id long, offset long, task long, place long")
ARROW_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("doc_tokens", pa.int64()), ("class", pa.int32()), ("sequence_id", pa.int64()),
    ("offset", pa.int64()), ("task", pa.int64()), ("place", pa.int64())])


def cuts(rest: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of the pieces of a rest shorter than the capacity."""
    out = []
    while rest:
        j = capacity // rest
        slack = capacity - j * rest          # of a whole bin
        if rest <= FINE or slack * SLACK_SHARE <= rest * j:
            out.append(rest)
            break
        piece = capacity // (j + 1)
        out.append(piece)
        rest -= piece
    return out


class _Bins:
    """Open bins of one task, one per class."""

    def __init__(self, task: int, capacity: int):
        self.task, self.capacity = task, capacity
        self.table = [cuts(r, capacity) for r in range(capacity)]
        self.open: dict[int, list[list]] = defaultdict(list)
        self.fill: dict[int, int] = defaultdict(int)
        self.done = 0
        self.rows: list[list] = []

    def put(self, doc_id, start: int, ids: bytes, doc_tokens: int) -> None:
        length = len(ids) >> 2
        j = self.capacity // length
        bin_rows = self.open[j]
        bin_rows.append([doc_id, start, length, ids, doc_tokens, j, None, self.fill[j],
                         self.task, len(bin_rows)])
        self.fill[j] += length
        if len(bin_rows) == j:
            number = (self.task << 34) + self.done
            for row in bin_rows:
                row[6] = number
            self.rows += bin_rows
            self.done += 1
            self.open[j], self.fill[j] = [], 0

    def add(self, doc_id, ids: np.ndarray) -> None:
        raw, n, at = ids.tobytes(), len(ids), 0
        lengths = [self.capacity] * (n // self.capacity) + self.table[n % self.capacity]
        for length in lengths:
            self.put(doc_id, at, raw[4 * at: 4 * (at + length)], n)
            at += length

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        cols = list(zip(*rows)) if rows else [()] * len(ARROW_PIECES)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(cols, ARROW_PIECES)], schema=ARROW_PIECES)

    def rest(self) -> None:
        for j in sorted(self.open):
            self.rows += self.open[j]
        self.open.clear()


def fill_bins(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """Step 1: tokenized pieces with their sequence, or none if left over."""
    kind = splitting_kind(path)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, kind)
        bins = _Bins(TaskContext.get().partitionId(), capacity)
        for batch in batches:
            for part in slices(batch):
                ids, counts = with_end(*enc.encode(part.column(1)), end_id)
                ends = np.cumsum(counts)
                for doc_id, a, b in zip(part.column(0).to_pylist(), ends - counts, ends):
                    bins.add(doc_id, ids[a:b])
                yield bins.take()
        bins.rest()
        yield bins.take()
        release()
    return whole_texts(docs).mapInArrow(task, PIECES)


def _fill_left(left: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Step 2: (pieces of full sequences, remaining pieces)."""
    counts = left.groupBy("class", "task").agg(F.count("*").alias("n"))
    by_class = Window.partitionBy("class")
    before = counts.select(
        "class", "task",
        F.coalesce(F.sum("n").over(by_class.orderBy("task").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(by_class).alias("all"))
    # at most `class` pieces per task and class: no key is large
    at = (left.join(before, ["class", "task"])
          .withColumn("place", F.col("before") + F.col("place"))
          .withColumn("bin", F.expr("place div class"))
          .withColumn("full", F.expr("place < (all div class) * class")))
    in_bin = Window.partitionBy("class", "bin").orderBy("place").rowsBetween(
        Window.unboundedPreceding, -1)
    full = (at.where("full")
            .withColumn("offset", F.coalesce(F.sum("length").over(in_bin), F.lit(0)))
            .withColumn("sequence_id", F.expr(
                f"{LEFT_SEQUENCES}L + (cast(class as bigint) << 40) + bin")))
    return full, at.where("not full")


def _lay_out(capacity: int):
    """Step 3 on the bounded remainder (under one sequence per class)."""
    def run(rows):
        import pandas as pd
        rows = rows.sort_values(["class", "place"]).reset_index(drop=True)
        total = int(rows["length"].sum())
        whole = total // capacity * capacity
        borders = list(range(0, whole + 1, capacity))
        tail, at = total - whole, whole
        for bit in reversed(range(tail.bit_length())):
            if tail >> bit & 1:
                at += 1 << bit
                borders.append(at)
        out, pos, k = [], 0, 0
        for r in rows.itertuples(index=False):
            done = 0
            while done < r.length:
                while borders[k + 1] <= pos:
                    k += 1
                n = min(r.length - done, borders[k + 1] - pos)
                out.append((r.doc_id, r.start + done, n, r.ids[4 * done: 4 * (done + n)],
                            r.doc_tokens, LAST_SEQUENCES + k, pos - borders[k]))
                done += n
                pos += n
        return pd.DataFrame(out, columns=["doc_id", "start", "length", "ids", "doc_tokens",
                                          "sequence_id", "offset"]).astype({"doc_id": "Int64"})
    return run


OUT = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
OUT_SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
              "sequence_id long, offset long")


def pack(docs: DataFrame, path: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Packed pieces of ``docs`` (doc_id, text): the ids (little-endian unsigned
    32-bit), their place in the document and in a sequence of ``capacity``."""
    placed = stored(fill_bins(docs, path, end_id, capacity), "pack-pieces")
    full = placed.where("sequence_id is not null").select(OUT)
    again, rest = _fill_left(placed.where("sequence_id is null"))
    # bounded: fewer than one sequence per class, for any size of the corpus
    last = rest.groupBy(F.lit(0).alias("all_rest")).applyInPandas(
        lambda rows: _lay_out(capacity)(rows), OUT_SCHEMA)
    return full.unionByName(again.select(OUT)).unionByName(last)
