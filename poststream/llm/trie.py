"""The prefix trie of conversations, from sorted neighbours.

A turn is the 16 bytes of MD5 over its role and text, a conversation the bytes of
its turns end to end; so bytewise order is order by turns, shorter first.  The
conversations are range-sorted and cut into segments of about ``SEGMENT_TURNS``
turns.  In a segment, the longest common prefix (LCP) of each neighbouring pair is
taken, and a sparse table answers range minima of the LCPs.  Each candidate prefix
(conversation, depth) searches by halving steps how far to the left and to the
right all LCPs reach its depth; that interval is the node's members.  No stack is
kept, so candidates are independent of each other.  A candidate that is the first
of its interval stands for the node.  Sums over an interval (leaves, saved text)
are differences of running sums.

A node whose interval goes over a segment's edge gives a part per segment, named
by the hash of its prefix; parts are added up.  So neither a first turn that a
third of all conversations share nor a group of copies meets in one task: such a
node has one row per segment.  (Ids of a spanning group of copies are hashed as a
stream of such rows.)

Conversations are ordered by turn (NULL first; equal turns by role, then hash of
the turn); NULL role and text are empty; rows without ``conv_id`` are left out.
An empty table has no members and no nodes.  Rows that repeat are turns of their
own.  Extra columns are ignored.  Texts don't cross a shuffle; a conversation,
24 bytes a turn, is held by one task as a whole, as a text is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poststream.llm.tables import stored

GROUP = 100         # conversations of a hundred take their first turns from its first
MOST_SHARED = 6     # fewer turns than this are taken
TURN_BYTES = 16
SEGMENT_TURNS = 1 << 16
NO_IDS = hashlib.sha256().hexdigest()

SEGMENTS = ("part int, block int, convs binary, lens binary, turns binary, chars binary, "
            "first binary, last binary")
ARROW_SEGMENTS = pa.schema([("part", pa.int32()), ("block", pa.int32())] + [
    (n, pa.binary()) for n in ("convs", "lens", "turns", "chars", "first", "last")])
EDGES = "part int, block int, before int, after int"
ARROW_EDGES = pa.schema([(n, pa.int32()) for n in ("part", "block", "before", "after")])
# ``key`` names a node that goes on in another segment; its numbers are a part's
NODES = ("key binary, depth long, conv_id long, parent_key binary, parent_conv_id long, n_convs long, "
         "n_children long, n_leaves long, saved_tokens long, above long, ends_sha256 string, ends binary, "
         "part int, block int")
ARROW_NODES = pa.schema([
    ("key", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_key", pa.binary()),
    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
    ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("above", pa.int64()),
    ("ends_sha256", pa.string()), ("ends", pa.binary()), ("part", pa.int32()), ("block", pa.int32())])
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
       "ends_sha256"]


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns, chars) of every conversation with its first turns taken
    from the first conversation of its hundred: hashes of the turns end to end,
    and the code points of each turn's text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    name = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    own = (conversations.where("conv_id IS NOT NULL")
           .select(F.col("conv_id").cast("long").alias("conv_id"),
                   F.struct(F.col("turn"), role.alias("role"), name.alias("name"),
                            F.char_length(text).alias("chars")).alias("t"))
           .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
           .select("conv_id", F.transform("t", lambda x: F.struct(x["name"].alias("name"),
                                                                  x["chars"].alias("chars"))).alias("own")))
    own = stored(own, "conversations")
    heads = own.where(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("base"), F.slice("own", 1, MOST_SHARED - 1).alias("head"))
    shared = (F.crc32(F.col("conv_id").cast("string")) % MOST_SHARED).cast("int")
    both = own.withColumns({"base": F.col("conv_id") - F.col("conv_id") % GROUP, "h": shared}).join(
        heads, "base", "left")
    none = F.array().cast(own.schema["own"].dataType)
    all_turns = F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
                         F.slice("own", F.col("h") + 1, F.size("own")))
    return both.select("conv_id", all_turns.alias("t")).select(
        "conv_id", F.unhex(F.array_join("t.name", "")).alias("turns"), F.col("t.chars").alias("chars"))


def _segments(most: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId(), 0
        convs, turns, chars, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            row = [part, block, np.array(convs, "<i8").tobytes(),
                   np.array([len(t) // TURN_BYTES for t in turns], "<i4").tobytes(), b"".join(turns),
                   np.array([c for own in chars for c in own], "<i4").tobytes(), turns[0], turns[-1]]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip(row, ARROW_SEGMENTS)], schema=ARROW_SEGMENTS)

        for batch in batches:
            for conv, own, lens in zip(*(batch.column(i).to_pylist() for i in range(3))):
                convs.append(conv)
                turns.append(own)
                chars.append(lens)
                held += len(lens) + 1
                if held >= most:
                    yield flush()
                    block, held = block + 1, 0
                    convs, turns, chars = [], [], []
        if convs:
            yield flush()
    return task


def _common(a: bytes, b: bytes) -> int:
    """Number of turns that two conversations begin with alike."""
    n = min(len(a), len(b)) // TURN_BYTES
    x, y = (np.frombuffer(v, "V16", n) for v in (a, b))
    differ = np.flatnonzero(x != y)
    return int(differ[0]) if len(differ) else n


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The LCP of each segment's ends with its neighbours (-1: none), in order."""
    held, before = None, -1
    for batch in batches:
        for row in batch.to_pylist():
            if held is not None:
                after = _common(held["last"], row["first"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], pa.int32()) for v in (held["part"], held["block"], before, after)],
                    schema=ARROW_EDGES)
                before = after
            held = row
    if held is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], pa.int32()) for v in (held["part"], held["block"], before, -1)],
            schema=ARROW_EDGES)


def minima(values: np.ndarray) -> list[np.ndarray]:
    """Sparse table: entry i of level k is the least of values[i : i + 2 ** k]."""
    table = [values]
    while 2 ** len(table) <= len(values):
        half = 2 ** (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))
    return table


def leftmost(table: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """First row from which on all LCPs up to ``row`` reach ``depth``."""
    at = row.copy()
    for k in reversed(range(len(table))):
        to = at - 2 ** k
        ok = to >= 0
        ok[ok] = table[k][to[ok]] >= depth[ok]
        at[ok] = to[ok]
    return at


def rightmost(table: list[np.ndarray], row: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Last row up to which all LCPs from ``row`` on reach ``depth``."""
    at, last = row.copy(), len(table[0])
    for k in reversed(range(len(table))):
        ok = at + 2 ** k <= last
        ok[ok] = table[k][at[ok]] >= depth[ok]
        at[ok] += 2 ** k
    return at


def least(table: list[np.ndarray], begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The least value of each range [begin, end]."""
    level = np.frexp(end - begin + 1)[1] - 1
    out = np.empty(len(begin), table[0].dtype)
    for k in np.unique(level):
        own = level == k
        out[own] = np.minimum(table[k][begin[own]], table[k][end[own] + 1 - 2 ** k])
    return out


def neighbours(turns: np.ndarray, lens: np.ndarray, off: np.ndarray) -> np.ndarray:
    """LCP of each row with the next."""
    both = np.minimum(lens[:-1], lens[1:])
    row = np.repeat(np.arange(len(both)), both)
    at = np.arange(len(row)) - np.repeat(np.cumsum(both) - both, both)
    differ = np.flatnonzero(turns[off[row] + at] != turns[off[row + 1] + at])
    rows, first = np.unique(row[differ], return_index=True)
    out = both.copy()
    out[rows] = at[differ[first]]
    return out


def _prefix_keys(turns: bytes, most: int) -> list[bytes]:
    """A hash of the first 0 .. ``most`` turns."""
    running = hashlib.md5()
    keys = [running.digest()]
    for d in range(most):
        running.update(turns[TURN_BYTES * d: TURN_BYTES * (d + 1)])
        keys.append(running.digest())
    return keys


def segment_nodes(convs: np.ndarray, lens: np.ndarray, turns: bytes, chars: np.ndarray,
                  before: int, after: int) -> dict[str, np.ndarray | list]:
    """All nodes of a segment; parts of those that its edges share."""
    n = len(convs)
    off = np.concatenate(([0], np.cumsum(lens)))
    lcp = np.append(neighbours(np.frombuffer(turns, "V16"), lens, off), after)
    reach = minima(lcp[:-1]) if n > 1 else []
    # candidates: every prefix of every row, in order
    begin = off[:-1] + np.arange(n)
    row = np.repeat(np.arange(n), lens + 1)
    depth = np.arange(len(row)) - begin[row]
    left = leftmost(reach, row, depth)
    right = rightmost(reach, row, depth) if n > 1 else row
    # text of the first d turns: of each row, running
    text = np.concatenate(([0], np.cumsum(chars)))
    upto = lambda rows, d: text[off[rows] + d] - text[off[rows]]
    leaf = np.concatenate(([0], np.cumsum(lcp < lens)))
    pair = np.concatenate(([0], np.cumsum(upto(np.arange(n), np.maximum(lcp, 0)))))
    least_conv = minima(convs)
    # the parent of (row, d) is the first of (row, d - 1)'s interval; it counts a child once
    node = np.flatnonzero(left == row)
    child = node[depth[node] > 0]
    parent = np.full(len(row), -1)
    parent[child] = begin[left[child - 1]] + depth[child] - 1
    began = child[(row[child] > 0) | (depth[child] > before)]
    children = np.bincount(parent[began], minlength=len(row))
    same = lcp[:-1] == lens[:-1]
    same &= lens[1:] == lens[:-1]       # copies of the next row
    stops = np.flatnonzero(np.append(~same, True))
    i, d, r = row[node], depth[node], right[node]
    open_left, open_right = (i == 0) & (d <= before), (r == n - 1) & (d <= after)
    is_open = open_left | open_right
    conv = least(least_conv, i, r)
    above = upto(i, np.maximum(d - 1, 0))
    saved = pair[r + open_right] - pair[i]
    keys_first = _prefix_keys(turns[:TURN_BYTES * int(max(before, 0))], max(before, 0))
    keys_last = _prefix_keys(turns[TURN_BYTES * int(off[-2]):], max(after, 0))
    key: list = [None] * len(node)
    for k in np.flatnonzero(is_open).tolist():
        key[k] = (keys_first if open_left[k] else keys_last)[int(d[k])]
    ends: list = [b""] * len(node)
    whole = np.flatnonzero(d == lens[i])
    for k, last in zip(whole.tolist(), stops[np.searchsorted(stops, i[whole])].tolist()):
        ends[k] = ",".join(map(str, convs[i[k]: last + 1].tolist())).encode()
    number = np.full(len(row), -1)
    number[node] = np.arange(len(node))
    up = np.where(d > 0, number[parent[node]], -1)
    parent_key = [key[u] if u >= 0 else None for u in up.tolist()]
    known = (up >= 0) & ~is_open[up]
    return {"key": key, "depth": d, "conv_id": conv, "parent_key": parent_key,
            "parent_conv_id": [c if ok else None for c, ok in zip(conv[up].tolist(), known.tolist())],
            "n_convs": r - i + 1, "n_children": children[node], "n_leaves": leaf[r + 1] - leaf[i],
            "saved_tokens": np.where(is_open, saved, saved - (r - i) * above), "above": above,
            "ends_sha256": [None if k else hashlib.sha256(e).hexdigest() if e else NO_IDS
                            for k, e in zip(key, ends)],
            "ends": [e if k and e else None for k, e in zip(key, ends)]}


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1).to_pylist()[0]
            numbers = [np.frombuffer(row[c], t).astype(np.int64) for c, t in (
                ("convs", "<i8"), ("lens", "<i4"), ("chars", "<i4"))]
            made = segment_nodes(numbers[0], numbers[1], row["turns"], numbers[2],
                                 row["before"], row["after"])
            n = len(made["key"])
            made |= {"part": [row["part"]] * n, "block": [row["block"]] * n}
            yield pa.RecordBatch.from_arrays(
                [pa.array(made[f.name], f.type) for f in ARROW_NODES], schema=ARROW_NODES)


def _stream_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the id lists of each key, which come in order."""
    key, running = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()),
                                           pa.array([running.hexdigest()])], ["k", "ids_sha256"])
    for batch in batches:
        for own, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if own != key:
                if running is not None:
                    yield row()
                key, running = own, hashlib.sha256(ends)
            else:
                running.update(b"," + ends)
    if running is not None:
        yield row()


def prefix_trie(sequences: DataFrame, segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """The nodes over ``sequences`` (conv_id, turns, chars): a row per distinct prefix."""
    keys = ["turns", "conv_id"]
    cut = (sequences.select("conv_id", "turns", "chars").repartitionByRange(*keys)
           .sortWithinPartitions(*keys).mapInArrow(_segments(segment_turns), SEGMENTS))
    segments = stored(cut, "trie-segments")
    # a row per segment, in order: each looks at the next
    edges = stored(segments.select("part", "block", "first", "last").repartition(1)
                   .sortWithinPartitions("part", "block").mapInArrow(_edges, EDGES), "trie-edges")
    nodes = stored(segments.drop("first", "last").join(edges, ["part", "block"])
                   .mapInArrow(_nodes, NODES), "trie-nodes")
    parts = nodes.where("key IS NOT NULL")
    ends = (parts.where("ends IS NOT NULL").select("key", "ends", "part", "block")
            .repartition("key").sortWithinPartitions("key", "part", "block").select("key", "ends")
            .mapInArrow(_stream_ends, "k binary, ids_sha256 string"))
    merged = stored(
        parts.groupBy("key", "depth").agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
            F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved_tokens").alias("saved"), F.max("above").alias("above"),
            F.max("parent_key").alias("parent_key"))
        .join(ends, F.col("key") == F.col("k"), "left")
        .withColumns({"saved_tokens": F.col("saved") - (F.col("n_convs") - 1) * F.col("above"),
                      "ends_sha256": F.coalesce("ids_sha256", F.lit(NO_IDS))})
        .drop("k", "ids_sha256", "saved", "above"), "trie-merged")
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    whole = nodes.where("key IS NULL")
    return (whole.where("parent_key IS NULL").select(*OUT)
            .unionByName(whole.where("parent_key IS NOT NULL").drop("parent_conv_id")
                         .join(above, "parent_key").select(*OUT))
            .unionByName(merged.join(above, "parent_key", "left").select(*OUT)))


def _crc32_sql(text: str) -> str:
    """DuckDB: unsigned crc32 of an ASCII text."""
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len({text})), "
            f"lambda i: ascii(substr({text}, i + 1, 1))::BIGINT)), lambda a, b: list_reduce(list_prepend("
            "xor(a, b), range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) "
            "ELSE x >> 1 END)), 4294967295)")


TRIE_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS txt
           FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'role': role, 'txt': txt}} ORDER BY turn NULLS FIRST, role,
                             md5(strlen(role)::VARCHAR || ':' || role || txt)) AS ts
        FROM t GROUP BY conv_id),
cut AS (SELECT *, {_crc32_sql('conv_id::VARCHAR')} % {MOST_SHARED} AS h FROM own),
re AS (SELECT c.conv_id, list_concat(list_slice(coalesce(b.ts, []), 1, h),
                                     list_slice(c.ts, h + 1, len(c.ts))) AS s
       FROM cut c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % {GROUP}),
p AS (SELECT conv_id, len(s) AS n, unnest(range(len(s) + 1)) AS d, s FROM re),
node AS (SELECT list_slice(s, 1, d) AS pre, d, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), ''))
             AS ends_sha256 FROM p GROUP BY ALL),
up AS (SELECT list_slice(pre, 1, d - 1) AS pre, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
full_node AS (SELECT node.*, coalesce(up.n, 0) AS n_children,
           (n_convs - 1) * coalesce(length(pre[-1].txt), 0) AS saved
         FROM node LEFT JOIN up USING (pre)),
anc AS (SELECT pre, unnest(range(d + 1)) AS a, n_children, saved FROM full_node),
sub AS (SELECT list_slice(pre, 1, a) AS pre, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
          sum(saved)::BIGINT AS saved_tokens FROM anc GROUP BY 1)
SELECT f.conv_id, f.d AS depth, q.conv_id AS parent_conv_id, f.n_convs, f.n_children, sub.n_leaves,
  sub.saved_tokens, f.ends_sha256
FROM full_node f JOIN sub USING (pre) LEFT JOIN node q ON f.d > 0 AND q.pre = list_slice(f.pre, 1, f.d - 1)
"""
