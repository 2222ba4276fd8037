"""Token ids as directly addressable codes in files, read at any position.

An id is split into chunks of 8 bits.  Level 0 holds the low chunk of every id,
level 1 the next chunk of the ids that have one, and so on; a bitmap per level
marks the ids that continue, and a rank directory (ones before each block of
512 bits) finds the place of an id on the next level.  So any single token is
read with one byte per level and one popcount inside a block, without decoding
its neighbours, and a document with its own bytes on each level: the ranks at
both ends of its range are its range on the next level (``ids_between``).

Files are Parquet tables below one folder, written by Spark's own committed
writer (any store, any lost executor):

* ``segments``: a row per run of whole documents (task, segment, tokens before
  it in the task, doc ids, their token counts, the levels);
* ``shards``: a row per task with its first token in the whole corpus.

Documents are in ascending ``doc_id`` order (NULL first, equal ids by a hash of
their text; equal rows can be in any order).  Rows are range-partitioned on
those keys and a spreading salt, so many equal ids do not fill one task.
NULL text is empty (one end id).  An empty table writes no segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from poststream.llm.arrowtext import release, slices, whole_texts
from poststream.llm.tokens import encoder, splitting_kind, with_end

CHUNK_BITS = 8
BLOCK_BITS = 512
SEGMENT_TOKENS = 1 << 18

SEGMENTS = ("task long, segment long, first long, n_tokens long, doc_ids array<long>, "
            "doc_tokens array<long>, levels array<struct<chunks: binary, more: binary, rank: binary>>")
_LEVEL = pa.struct([("chunks", pa.binary()), ("more", pa.binary()), ("rank", pa.binary())])
ARROW_SEGMENTS = pa.schema([
    ("task", pa.int64()), ("segment", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("doc_tokens", pa.list_(pa.int64())),
    ("levels", pa.list_(_LEVEL))])


def encode_levels(ids: np.ndarray) -> list[dict[str, bytes]]:
    """Chunk bytes, continuation bitmap and rank directory of each level."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        chunks = (rest & 0xFF).astype(np.uint8)
        high = rest >> CHUNK_BITS
        more = high > 0
        bits = np.packbits(more, bitorder="little")
        pad = -len(bits) % (BLOCK_BITS // 8)
        blocks = np.pad(bits, (0, pad)).reshape(-1, BLOCK_BITS // 8)
        ones = np.bitwise_count(blocks).sum(axis=1, dtype=np.uint32)
        rank = np.concatenate(([0], np.cumsum(ones)))[:-1].astype("<u4")
        levels.append({"chunks": chunks.tobytes(), "more": bits.tobytes(), "rank": rank.tobytes()})
        if not more.any():
            return levels
        rest = high[more]


def rank_at(level: dict[str, bytes], place: int) -> int:
    """How many of the ids before ``place`` go on: the directory's count before
    the block and one popcount inside it."""
    block = place // BLOCK_BITS
    if 4 * block == len(level["rank"]):   # the end of a full last block
        if not block:
            return 0
        block -= 1
    before = int.from_bytes(level["rank"][4 * block: 4 * block + 4], "little")
    begin = block * BLOCK_BITS // 8
    inside = int.from_bytes(level["more"][begin: begin + BLOCK_BITS // 8], "little")
    return before + (inside & ((1 << (place - block * BLOCK_BITS)) - 1)).bit_count()


def token_at(levels: list, place: int) -> int:
    """The id at ``place``, read without decoding any other."""
    value = 0
    for k, level in enumerate(levels):
        value |= level["chunks"][place] << (CHUNK_BITS * k)
        if not level["more"][place >> 3] >> (place & 7) & 1:
            return value
        place = rank_at(level, place)
    raise ValueError("the last level says that the id goes on")


def ids_between(levels: list, begin: int, end: int) -> np.ndarray:
    """The ids at places ``begin`` to ``end`` (exclusive), reading the bytes of
    that range alone on each level."""
    parts = []
    for level in levels:
        own = np.frombuffer(level["chunks"], np.uint8, end - begin, begin).astype(np.uint32)
        bits = np.frombuffer(level["more"], np.uint8, ((end + 7) >> 3) - (begin >> 3), begin >> 3)
        more = np.unpackbits(bits, bitorder="little")[begin & 7: (begin & 7) + end - begin].astype(bool)
        parts.append((own, more))
        if not more.any():
            break
        begin, end = rank_at(level, begin), rank_at(level, end)
    value = np.zeros(0, np.uint32)
    for own, more in reversed(parts):
        if more.any():
            own[more] |= value << CHUNK_BITS
        value = own
    return value


def _segments(path: str, end_id: int):
    kind = splitting_kind(path)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, kind)
        number = TaskContext.get().partitionId()
        held_ids, held_docs, held_counts, held = [], [], [], 0
        first, segment = 0, 0

        def flush() -> pa.RecordBatch:
            row = [number, segment, first, held, held_docs, held_counts,
                   encode_levels(np.concatenate(held_ids))]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(row, ARROW_SEGMENTS)], schema=ARROW_SEGMENTS)

        for batch in batches:
            for part in slices(batch):
                ids, counts = with_end(*enc.encode(part.column(1)), end_id)
                ends = np.cumsum(counts)
                # runs of whole documents of about SEGMENT_TOKENS
                run = (ends - 1) // SEGMENT_TOKENS
                for r in np.unique(run):
                    rows = np.flatnonzero(run == r)
                    a, b = rows[0], rows[-1] + 1
                    lo, hi = int(ends[a] - counts[a]), int(ends[b - 1])
                    held_ids.append(ids[lo:hi])
                    held_docs += part.column(0).slice(int(a), int(b - a)).to_pylist()
                    held_counts += counts[a:b].tolist()
                    held += hi - lo
                    if held >= SEGMENT_TOKENS:
                        yield flush()
                        first, segment = first + held, segment + 1
                        held_ids, held_docs, held_counts, held = [], [], [], 0
        if held_docs:
            yield flush()
        release()
    return task


def write_ids(docs: DataFrame, folder: str, path: str, end_id: int = 1) -> None:
    """Tokenize ``docs`` (doc_id, text) in ``doc_id`` order into ``folder``."""
    keyed = whole_texts(docs, F.xxhash64("text").alias("h"),
                        (F.monotonically_increasing_id() % 1021).alias("salt"))
    keys = [F.col("doc_id").asc_nulls_first(), F.col("h"), F.col("salt")]
    ordered = keyed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    (ordered.select("doc_id", "text").mapInArrow(_segments(path, end_id), SEGMENTS)
     .write.mode("overwrite").parquet(f"{folder}/segments"))
    spark = docs.sparkSession
    totals = (spark.read.schema(SEGMENTS).parquet(f"{folder}/segments")
              .groupBy("task").agg(F.sum("n_tokens").alias("n")))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    (totals.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
     .write.mode("overwrite").parquet(f"{folder}/shards"))


def read_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Segments with ``start``, the corpus position of their first token."""
    segments = spark.read.schema(SEGMENTS).parquet(f"{folder}/segments")
    shards = spark.read.schema("task long, base long").parquet(f"{folder}/shards")
    return segments.join(shards, "task").withColumn("start", F.col("base") + F.col("first"))


DOCS = "doc_id long, start long, n_tokens long, ids binary"
ARROW_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids", pa.binary())])


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            counts = np.array(row["doc_tokens"], np.int64)
            ends = np.cumsum(counts)
            yield pa.RecordBatch.from_arrays([
                pa.array(row["doc_ids"], pa.int64()),
                pa.array(row["start"] + ends - counts), pa.array(counts),
                pa.array([ids_between(row["levels"], int(e - c), int(e)).astype("<u4").tobytes()
                          for e, c in zip(ends, counts)], pa.binary()),
            ], schema=ARROW_DOCS)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, each read from the files
    by its own range through the rank directories."""
    return (read_segments(spark, folder).select("doc_ids", "doc_tokens", "levels", "start")
            .mapInArrow(_documents, DOCS))


PLACES = "task long, segment long, doc_id long, n long, at long"
ARROW_PLACES = pa.schema([(n, pa.int64()) for n in ("task", "segment", "doc_id", "n", "at")])


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where each document's ids begin in its segment."""
    for batch in batches:
        for row in batch.to_pylist():
            counts = np.array(row["doc_tokens"], np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array([row["task"]] * len(counts), pa.int64()),
                pa.array([row["segment"]] * len(counts), pa.int64()), pa.array(row["doc_ids"], pa.int64()),
                pa.array(counts), pa.array(np.cumsum(counts) - counts)], schema=ARROW_PLACES)


def read_places(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """(doc_id, place, token) for ``wanted`` (doc_id, place) pairs: only the
    bytes of the wanted tokens are looked at.  Places outside a document give
    no row."""
    docs = (spark.read.schema(SEGMENTS).parquet(f"{folder}/segments")
            .select("task", "segment", "doc_ids", "doc_tokens").mapInArrow(_places, PLACES))
    hits = (wanted.join(docs, "doc_id").where("place >= 0 and place < n")
            .groupBy("task", "segment", (F.col("place") % 64).alias("part"))
            .agg(F.collect_list(F.struct("doc_id", "place", (F.col("at") + F.col("place"))
                                         .alias("inside"))).alias("hits")))

    def task(batches):
        for batch in batches:
            for row in batch.to_pylist():
                found = [(h["doc_id"], h["place"], token_at(row["levels"], h["inside"]))
                         for h in row["hits"]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*found)], ["doc_id", "place", "token"])
    return (read_segments(spark, folder).select("task", "segment", "levels")
            .join(hits, ["task", "segment"]).select("levels", "hits")
            .mapInArrow(task, "doc_id long, place long, token long"))
