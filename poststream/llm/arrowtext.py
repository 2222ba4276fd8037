"""Whole texts as byte buffers: numpy helpers for operators that run in tasks.

Arrow hands a task its texts as one byte buffer plus offsets.  Word edges,
line edges and counts are found on that buffer in a few vector passes, so no
Python object is made per word.  Batches are cut into slices of a few MB
(``slices``); a longer single text is one slice of its own, so memory is
bounded by the slice size and the longest text.  ``whole_texts`` keeps the
batches themselves small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH_ROWS = 1024
SLICE_BYTES = 1 << 20
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_BLANK = np.zeros(256, bool)
IS_BLANK[list(BLANKS)] = True


def whole_texts(docs: DataFrame, *columns: Column | str) -> DataFrame:
    """``docs`` with ``doc_id``, ``text`` and further columns, sent to Python in
    batches of at most ``BATCH_ROWS`` rows (a session setting: the default of
    10,000 whole texts would be held several times over in each task)."""
    conf, name = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *columns)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; NULL counts as the empty text."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    bufs = column.buffers()
    n = len(column)
    if n == 0 or bufs[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(bufs[1], np.int64 if wide else np.int32)
    off = off[column.offset: column.offset + n + 1].astype(np.int64)
    if bufs[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8)[off[0]: off[-1]]
    return data, off - off[0]


def slices(batch: pa.RecordBatch, column: str = "text",
           max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``max_bytes`` of text each."""
    _, off = text_buffer(batch.column(batch.schema.get_field_index(column)))
    row, rows = 0, len(off) - 1
    while row < rows:
        end = int(np.searchsorted(off, off[row] + max_bytes, side="right")) - 1
        end = min(rows, max(row + 1, end))
        yield batch.slice(row, end - row)
        row = end


def release() -> None:
    """Give free memory back at the end of a task: Python workers live on."""
    import ctypes
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):   # another C library
        pass


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words before each text) of runs of non-blank bytes."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    word = ~IS_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last = word
    last[:-1] &= ~word[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Number of set flags in each text."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[off[1:]] - total[off[:-1]]


def pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte runs [start, end) as an Arrow binary column."""
    lens = ends - starts
    out = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lens, out=out[1:])
    if len(starts) and (out[-1] != ends[-1] - starts[0] or (starts[1:] != ends[:-1]).any()):
        keep = np.zeros(len(data) + 1, np.int8)
        keep[starts] += 1  # starts and ends are each distinct
        keep[ends] -= 1
        data = data[np.cumsum(keep[:-1], dtype=np.int8).astype(bool)]
    elif len(starts):
        data = data[starts[0]: ends[-1]]
    else:
        data = data[:0]
    return bytes_column(np.ascontiguousarray(data), out)


def bytes_column(data: bytes | np.ndarray, edges: np.ndarray) -> pa.Array:
    """Byte runs that lie end to end, the i-th from ``edges[i]``, as an Arrow binary column."""
    return pa.Array.from_buffers(pa.large_binary(), len(edges) - 1,
                                 [None, pa.py_buffer(edges), pa.py_buffer(data)])


def codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(code of each value, distinct values)."""
    enc = values.dictionary_encode()
    return enc.indices.to_numpy(zero_copy_only=False).astype(np.int64), enc.dictionary


def spans_gather(lens: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Indices of the runs (start, len) laid end to end."""
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.cumsum(lens) - lens
    return np.repeat(starts - begin, lens) + np.arange(total)
