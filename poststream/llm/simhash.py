"""SimHash near-dedup: fingerprints, tiled exact comparison, components.

Fingerprint: lower-case A-Z, words are runs of non-blank characters, shingles
of four words joined by one space (repeats count; fewer words: the whole
sequence; none: zero), XXH64 with seed 42 of each; a bit is set if it is set in
over half of the hashes.

Links: two fingerprints link if they differ in at most ``radius`` bits.  The
distinct fingerprints are dealt into tiles by population count; a pair of tiles
is compared only if their population counts can be within the radius.  A task
gets one pair of tiles (a bounded number of fingerprints), takes exclusive-ors
and bit counts block by block, again skipping blocks by population count, and
returns a spanning forest of the links it found instead of all pairs, so a
large group of near copies costs as many rows as it has members.

Components: the forests of all tile pairs are contracted round by round (each
node joins its smallest neighbour in a mixed order); every round is written
below ``spark.checkpoint.dir``.  Ids never reach the driver; it sees 65 counts.

NULL text has no words.  Documents with the same fingerprint (copies, or no
words at all) are one node.  Rows with a NULL id link as others do; a component
has no id only if all its ids are NULL.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from poststream.llm.arrowtext import IS_BLANK, release, slices, text_buffer, whole_texts, word_bounds
from poststream.llm.tables import stored

SHINGLE = 4
SEED = 42
RADIUS = 4
TILE = 1 << 16          # fingerprints in a tile, at most
LEAST_TILES = 24        # smaller tiles on small input, so that all cores work
BLOCK = (128, 8192)     # fingerprints compared at once
MIX = np.uint64(0x9E3779B97F4A7C15)   # odd, so multiplication is one to one
UPPER = np.zeros(256, np.uint8)
UPPER[65:91] = 32


def _fold(hashes: np.ndarray) -> int:
    """The fingerprint of one text's shingle hashes."""
    ones = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 16):
        part = hashes[a: a + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints_of(column: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """uint64 fingerprints of an Arrow text column."""
    from xxhash import xxh64_intdigest
    data, off = text_buffer(column)
    starts, ends, before = word_bounds(data, off)
    out = np.zeros(len(off) - 1, np.uint64)
    if not len(starts):
        return out
    lower = data + UPPER[data]
    blank = IS_BLANK[data]
    keep = ~blank
    keep[1:] |= blank[1:] & ~blank[:-1]     # one blank after each word
    lower[blank] = 0x20
    place = np.cumsum(keep) - 1
    raw = lower[keep].tobytes()
    first, last = place[starts], place[ends - 1] + 1
    n = np.diff(before)
    row = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(starts)) - before[:-1][row]
    size = np.minimum(n, shingle)[row]
    opens = np.flatnonzero(inside + size <= n[row])
    a, b = first[opens], last[opens + size[opens] - 1]
    hashes = np.fromiter((xxh64_intdigest(raw[i:j], SEED) for i, j in zip(a.tolist(), b.tolist())),
                         np.uint64, len(opens))
    cut = np.searchsorted(row[opens], np.arange(len(n) + 1))
    for r in np.flatnonzero(n):
        out[r] = _fold(hashes[cut[r]: cut[r + 1]])
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, row_hash, fp, node): ``row_hash`` is over all columns, ``node``
    is the fingerprint in a mixed order."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                fp = fingerprints_of(part.column(1), shingle)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(fp.view(np.int64)),
                     pa.array((fp * MIX).view(np.int64))], ["doc_id", "row_hash", "fp", "node"])
        release()
    return whole_texts(docs, row_hash(docs)) \
        .mapInArrow(task, "doc_id long, row_hash long, fp long, node long")


def row_hash(docs: DataFrame):
    """A hash over all columns of a row."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("row_hash")


def forest(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS) -> np.ndarray:
    """Pairs (member, root) that connect all fingerprints linked between two
    tiles, or within one (``right`` None)."""
    def sort(x):
        count = np.bitwise_count(x)
        order = np.argsort(count, kind="stable")
        return x[order], count[order].astype(np.int64)
    left, left_count = sort(left)
    inner = right is None
    right, right_count = (left, left_count) if inner else sort(right)
    shift = 0 if inner else len(left)
    nodes = left if inner else np.concatenate((left, right))
    root = np.arange(len(nodes))
    xor = np.empty(BLOCK, np.uint64)
    bits = np.empty(BLOCK, np.uint8)
    for i in range(0, len(left), BLOCK[0]):
        a = left[i: i + BLOCK[0]]
        lo = np.searchsorted(right_count, left_count[i] - radius)
        hi = np.searchsorted(right_count, left_count[i + len(a) - 1] + radius, side="right")
        for j in range(max(lo, i) if inner else lo, hi, BLOCK[1]):
            b = right[j: min(hi, j + BLOCK[1])]
            x, d = xor[:len(a), :len(b)], bits[:len(a), :len(b)]
            np.bitwise_xor(a[:, None], b[None, :], out=x)
            np.bitwise_count(x, out=d)
            near = d <= radius
            if not near.any():
                continue
            p, q = np.nonzero(near)
            p, q = p + i, q + j + shift
            while True:
                u, v = root[p], root[q]
                apart = u != v
                if not apart.any():
                    break
                p, q, u, v = p[apart], q[apart], u[apart], v[apart]
                np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
                while True:
                    up = root[root]
                    if (up == root).all():
                        break
                    root = up
    member = np.flatnonzero(root != np.arange(len(nodes)))
    return np.stack((nodes[member], nodes[root[member]]), axis=1)


def tile_plan(counts: dict[int, int], radius: int, least: int = LEAST_TILES,
              most: int = TILE) -> list[tuple[int, int, int, int]]:
    """For each population count 0..64: (first tile, tiles, lowest and highest
    tile to compare with).  Small neighbouring counts share a tile."""
    total = sum(counts.values())
    size = max(1, min(most, -(-total // least)))
    first, parts, held, tile = [0] * 65, [1] * 65, 0, 0
    for p in range(65):
        n = counts.get(p, 0)
        if held and held + n > size:
            tile, held = tile + 1, 0
        first[p], parts[p] = tile, max(1, -(-n // size))
        held += n
        if parts[p] > 1:
            tile, held = tile + parts[p], 0
    last = [first[p] + parts[p] - 1 for p in range(65)]
    plan = []
    for p in range(65):
        mates = [q for q in range(65) if last[q] >= first[p] and first[q] <= last[p]]
        lo = first[max(0, min(mates) - radius)]
        hi = last[min(64, max(mates) + radius)]
        plan.append((first[p], parts[p], lo, hi))
    return plan


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): node pairs that connect all linked fingerprints of ``nodes``
    (distinct fp, node)."""
    count = F.bit_count("fp").cast("int")
    counts = {r["p"]: r["n"] for r in nodes.groupBy(count.alias("p")).agg(
        F.count("*").alias("n")).collect()}   # 65 rows at most
    plan = tile_plan(counts, radius)

    def of(k):
        return F.element_at(F.array(*[F.lit(x[k]) for x in plan]), count + 1)
    tiled = nodes.select(
        "fp", (of(0) + F.pmod(F.col("node"), of(1))).cast("int").alias("tile"),
        F.explode(F.sequence(of(2), of(3))).alias("other"))
    dealt = tiled.select("fp", F.least("tile", "other").alias("t"),
                         F.greatest("tile", "other").alias("u"),
                         (F.col("tile") <= F.col("other")).alias("is_left"))

    def compare(key, rows):
        import pandas as pd
        fp = rows["fp"].to_numpy().view(np.uint64)
        is_left = rows["is_left"].to_numpy(bool)
        pairs = forest(fp, None, radius) if key[0] == key[1] else \
            forest(fp[is_left], fp[~is_left], radius)
        mixed = (pairs * MIX).view(np.int64)
        return pd.DataFrame({"a": mixed[:, 0], "b": mixed[:, 1]})
    return dealt.groupBy("t", "u").applyInPandas(compare, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): connected components of the graph of ``edges`` (a, b);
    nodes without an edge have no row."""
    edges = stored(edges.where("a <> b").distinct(), "cc-edges")
    labels = stored(edges.selectExpr("a as node").union(edges.selectExpr("b")).distinct()
                    .selectExpr("node", "node as label"), "cc-labels")
    while not edges.isEmpty():
        both = edges.unionByName(edges.selectExpr("b as a", "a as b"))
        up = stored(both.groupBy("a").agg(F.min("b").alias("b"))
                    .selectExpr("a as old", "least(a, b) as new"), "cc-up")
        a = up.selectExpr("old as a", "new as x")
        b = up.selectExpr("old as b", "new as y")
        edges = stored(edges.join(a, "a").join(b, "b").selectExpr("x as a", "y as b")
                       .where("a <> b").distinct(), "cc-edges")
        labels = stored(labels.join(up.selectExpr("old as label", "new"), "label", "left")
                        .selectExpr("node", "coalesce(new, label) as label"), "cc-labels")
    return labels


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, row_hash, fp, component_id, label) of every document; ``label``
    names the component even where it has no id."""
    marked = stored(fingerprints(docs, shingle), "simhash")
    nodes = stored(marked.groupBy("fp", "node").agg(F.min("doc_id").alias("rep")), "simhash-nodes")
    labels = components(links(nodes.select("fp", "node"), radius))
    named = stored(nodes.join(labels, "node", "left")
                   .selectExpr("node", "rep", "coalesce(label, node) as label"), "simhash-named")
    least = stored(named.groupBy("label").agg(F.min("rep").alias("component_id")), "simhash-least")
    of_node = stored(named.join(least, "label").select("node", "component_id", "label"),
                     "simhash-of-node")
    return marked.join(of_node, "node").select("doc_id", "row_hash", "fp", "component_id", "label")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each component, all columns: the one with the
    smallest id (rows with NULL ids only if there are no others; equal ids by a
    hash of the row; of equal rows any one)."""
    groups = near_duplicates(docs, shingle, radius)
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_hash"))
    keep = stored(groups.groupBy("label").agg(least.alias("k")).selectExpr(
        "coalesce(k.doc_id, 0) as id", "k.doc_id is null as no_id", "k.row_hash as h"), "simhash-keep")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
                       F.col("doc_id").isNull().alias("no_id"), row_hash(docs).alias("h"))
    key = ["id", "no_id", "h"]
    first = Window.partitionBy(*key).orderBy("h")   # equal rows; the join deals them out already
    return (rows.join(keep, key).withColumn("nth", F.row_number().over(first))
            .where("nth = 1").select("row.*"))


def hex16(fp: str = "fp"):
    """16 lower-case hex digits of a fingerprint column."""
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")
