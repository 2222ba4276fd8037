"""A hash tree over a dataset whose parents keep copied hash states.

Every row is a leaf: the SHA-256 of its fields (``-`` for NULL, else byte count,
colon, value).  The leaves of a language ascend by ``doc_id`` (NULL first, equal
ids by leaf; equal rows in any order) and every ``FAN`` consecutive nodes become
the hash of their hex digests, until one node is left: the language's subroot.
The subroots, NULL language first, then bytewise, become the root in the same way.

A child's hex digest is one SHA-256 block, so the hash state of a parent before
each child slot is eight words.  Parents retain these states.  To fold a changed
leaf up to the root, each parent's state before its slot is resumed with the
replacement and the right siblings only; left siblings are never hashed again.

The manifest is a folder of Parquet tables:

* ``leaves``: every row's place in its language's tree;
* ``trees/pass=k`` and ``top/pass=k``: blocks of up to ``FAN ** deep`` consecutive
  nodes with the digests and states of ``deep`` levels; the block roots are the
  nodes of the next pass.

No language, however large, meets in one task: places come from range-sorted
partitions and their counts, a task holds one block (about 700 KB) at a time.  A
row keeps its place by value, so lost executors repeat nothing but their task.
An empty table gives empty tables; texts of any length are hashed whole; columns
other than the five fields are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from poststream.llm import sha
from poststream.session import path_exists

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 8
DEEP = 4
PART_BITS = 33      # of monotonically_increasing_id
SALTS = 1021

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

BLOCKS = ("tree string, block long, total long, digests array<binary>, states array<binary>, "
          "root binary")
ARROW_BLOCKS = pa.schema([
    ("tree", pa.string()), ("block", pa.int64()), ("total", pa.int64()),
    ("digests", pa.list_(pa.binary())), ("states", pa.list_(pa.binary())), ("root", pa.binary())])
# the way from a node to the root: per level its slot, the state before it, its siblings
PATHS = ("tree string, pos long, slots array<int>, states array<binary>, siblings array<binary>, "
         "subroot binary, root binary")
ARROW_PATHS = pa.schema([
    ("tree", pa.string()), ("pos", pa.int64()), ("slots", pa.list_(pa.int32())),
    ("states", pa.list_(pa.binary())), ("siblings", pa.list_(pa.binary())),
    ("subroot", pa.binary()), ("root", pa.binary())])
FOLDED = ("tree string, pos long, doc_id long, leaf string, subroot string, root string, "
          "proof_sha256 string, folded_root string")
ARROW_FOLDED = pa.schema([
    ("tree", pa.string()), ("pos", pa.int64()), ("doc_id", pa.int64())] + [
    (n, pa.string()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")])


def leaf(text: Column | str = "text") -> Column:
    """Digest (binary) of a row's fields, with ``text`` as its text."""
    parts = []
    for name in FIELDS:
        value = (F.col(text) if isinstance(text, str) else text) if name == "text" else F.col(name)
        value = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value),
                                F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def tree_of(lang: Column) -> Column:
    """Key of a language's tree, which orders NULL first, then bytewise."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def tampered_text() -> Column:
    """The text as a tamperer leaves it where 3 divides the id's crc32: ASCII lower case."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return F.when(hit, F.translate("text", UPPER, UPPER.lower()))


def place(nodes: DataFrame, keys: list[Column], folder: str) -> DataFrame:
    """``nodes`` with ``pos`` (from 0, in the order of ``keys`` in each ``tree``)
    and ``total`` (nodes of the tree), stored below ``folder``.

    Rows are range-sorted over all tasks; counts per (tree, task) give the
    places, so a tree may span any number of tasks."""
    spark = nodes.sparkSession
    order = [F.col("tree"), *keys, F.col("_salt")]
    salted = nodes.withColumn("_salt", F.monotonically_increasing_id() % SALTS)
    (salted.repartitionByRange(*order).sortWithinPartitions(*order).drop("_salt")
     .withColumn("_id", F.monotonically_increasing_id()).write.parquet(f"{folder}/sorted"))
    rows = spark.read.parquet(f"{folder}/sorted").withColumn(
        "_part", F.shiftright("_id", PART_BITS))
    tree = Window.partitionBy("tree")   # a row per task that holds some of the tree
    before = tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    (rows.groupBy("tree", "_part").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
     .select("tree", "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first"))
             .alias("_shift"), F.sum("_n").over(tree).alias("total"))
     .write.parquet(f"{folder}/spans"))
    spans = spark.read.parquet(f"{folder}/spans")
    return rows.join(spans, ["tree", "_part"]).withColumn(
        "pos", F.col("_id") + F.col("_shift")).drop("_id", "_part", "_shift")


def _levels(total: int, deep: int) -> int:
    """Levels of a tree of ``total`` nodes that one pass makes."""
    levels = 0
    while total > 1 and levels < deep:
        total, levels = -(-total // FAN), levels + 1
    return levels


def grow(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parents' digests, the state of its parent before each child)."""
    n = digests.shape[1]
    state = sha.start(-(-n // FAN))
    kept = np.empty((8, n), np.uint32)
    for slot in range(min(FAN, n)):
        at = np.arange(slot, n, FAN)    # only the last run can lack a slot
        kept[:, at] = state[:, :len(at)]
        state[:, :len(at)] = sha.step(state[:, :len(at)], sha.hex_block(digests[:, at]))
    sizes = np.minimum(FAN, n - np.arange(0, n, FAN))
    return sha.finish(state, sizes.astype(np.uint32)), kept


def _block(deep: int):
    width = FAN ** deep

    def block(table: pa.Table) -> pa.Table:
        """Consecutive nodes of a tree as one block."""
        table = table.sort_by("pos")
        total = table["total"][0].as_py()
        nodes = sha.from_bytes(b"".join(table["digest"].to_pylist()))
        digests, states = [], []
        for _ in range(_levels(total, deep)):
            above, kept = grow(nodes)
            digests.append(sha.to_bytes(nodes))
            states.append(sha.to_bytes(kept))
            nodes = above
        row = [table["tree"][0].as_py(), table["pos"][0].as_py() // width, -(-total // width),
               digests, states, sha.to_bytes(nodes)]
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, ARROW_BLOCKS)],
                                    schema=ARROW_BLOCKS)
    return block


def _passes(spark: SparkSession, folder: str) -> int:
    k = 0
    while path_exists(spark, f"{folder}/pass={k}"):
        k += 1
    return k


def _read(spark: SparkSession, folder: str, k: int) -> DataFrame:
    return spark.read.schema(BLOCKS).parquet(f"{folder}/pass={k}")


def _build(nodes: DataFrame, folder: str, deep: int) -> DataFrame:
    """Blocks of every pass over ``nodes`` (tree, pos, total, digest) in
    ``folder``; returns (tree, digest) of the trees' last nodes."""
    spark = nodes.sparkSession
    most, k, width = nodes.agg(F.max("total")).first()[0] or 0, 0, FAN ** deep
    while True:
        block = F.floor(F.col("pos") / width)
        (nodes.select("tree", "pos", "total", "digest").groupBy("tree", block.alias("block"))
         .applyInArrow(_block(deep), BLOCKS).write.parquet(f"{folder}/pass={k}"))
        blocks = _read(spark, folder, k)
        nodes = blocks.select("tree", F.col("block").alias("pos"), "total", F.col("root").alias("digest"))
        if most <= width:
            return nodes.select("tree", "digest")
        most, k = -(-most // width), k + 1


def build(docs: DataFrame, folder: str, extra: dict[str, Column] | None = None,
          deep: int = DEEP) -> None:
    """Write the manifest of ``docs`` into ``folder``; ``extra`` columns are
    computed with the leaves and kept in the ``leaves`` table."""
    rows = docs.select(tree_of(F.col("lang")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                       leaf().alias("digest"), *[c.alias(n) for n, c in (extra or {}).items()])
    # the range sort looks at its rows twice: texts are hashed before it, once
    rows.write.parquet(f"{folder}/hashed")
    spark = docs.sparkSession
    placed = place(spark.read.parquet(f"{folder}/hashed"),
                   [F.col("doc_id").asc_nulls_first(), F.col("digest")], f"{folder}/order")
    placed.write.parquet(f"{folder}/leaves")
    subroots = _build(spark.read.parquet(f"{folder}/leaves"), f"{folder}/trees", deep)
    named = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    place(named, [F.col("name")], f"{folder}/top-order").write.parquet(f"{folder}/subroots")
    _build(spark.read.parquet(f"{folder}/subroots"), f"{folder}/top", deep)


def _descend(deep: int):
    def ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ways to the root of the nodes of blocks, from the ways of the blocks."""
        for row in _rows(batches):
            levels = list(zip(row["digests"], row["kept"]))
            n = len(levels[0][0]) // 32 if levels else 1
            first = row["block"] * FAN ** deep
            slots, states, siblings = [], [], []
            for pos in range(n):
                own, before, others, at = [], [], [], pos
                for digests, kept in levels:
                    run = at - at % FAN
                    own.append(at % FAN)
                    before.append(kept[32 * at: 32 * at + 32])
                    others.append(digests[32 * run: 32 * at] + digests[32 * at + 32: 32 * (run + FAN)])
                    at //= FAN
                slots.append(own + row["slots"])
                states.append(before + row["states"])
                siblings.append(others + row["siblings"])
            columns = [[row["tree"]] * n, range(first, first + n), slots, states, siblings,
                       [row["subroot"]] * n, [row["top"]] * n]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, ARROW_PATHS)], schema=ARROW_PATHS)
    return ways


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _ways(spark: SparkSession, folder: str, ways: DataFrame, last: int, deep: int) -> DataFrame:
    """Ways of the blocks of pass ``last``, from those of the last pass."""
    for k in range(_passes(spark, folder) - 1, last, -1):
        ways = _with_ways(_read(spark, folder, k), ways).mapInArrow(_descend(deep), PATHS)
    return ways


def _with_ways(blocks: DataFrame, ways: DataFrame) -> DataFrame:
    """Blocks joined to their own way to the root."""
    ways = ways.select("tree", F.col("pos").alias("block"), "slots", "states", "siblings",
                       "subroot", F.col("root").alias("top"))
    return blocks.select("tree", "block", "digests", F.col("states").alias("kept"),
                         F.col("root").alias("own")).join(ways, ["tree", "block"])


def ways_to_root(spark: SparkSession, folder: str, deep: int = DEEP) -> DataFrame:
    """The way to the root of every block of leaves."""
    empty = [F.array().cast(t) for t in ("array<int>", "array<binary>", "array<binary>")]
    top_last = _passes(spark, f"{folder}/top") - 1
    last = _read(spark, f"{folder}/top", top_last).select(
        "tree", F.col("block").alias("pos"), empty[0].alias("slots"), empty[1].alias("states"),
        empty[2].alias("siblings"), F.lit(None).cast("binary").alias("subroot"), "root")
    top = _ways(spark, f"{folder}/top", last, -1, deep)
    names = spark.read.parquet(f"{folder}/subroots").select(
        F.col("tree").alias("t"), "pos", F.col("name").alias("tree"), F.col("digest").alias("sub"))
    ways = (top.drop("tree", "subroot").join(names, "pos")
            .select("tree", F.lit(0).cast("long").alias("pos"), "slots", "states", "siblings",
                    F.col("sub").alias("subroot"), "root"))
    return _ways(spark, f"{folder}/trees", ways, 0, deep)


def fold_level(digest: np.ndarray, state: np.ndarray, slot: np.ndarray, rights, sizes: np.ndarray
               ) -> np.ndarray:
    """Parents' digests after a child was replaced: the states before the
    children's slots, resumed with the replacements and right siblings.
    ``rights(j, rows)``: digests of the j-th right siblings of these rows."""
    state = sha.step(state, sha.hex_block(digest))
    for j in range(1, FAN):
        rows = np.flatnonzero(slot + j < sizes)
        if len(rows):
            state[:, rows] = sha.step(state[:, rows], sha.hex_block(rights(j, rows)))
    return sha.finish(state, sizes.astype(np.uint32))


def _fold(deep: int):
    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            pos = np.array(row["places"], np.int64) - row["block"] * FAN ** deep
            digest = sha.from_bytes(b"".join(row["new"]))
            # levels within the block: each row has its own slot and siblings
            texts, at, n = [], pos, len(pos)
            for raw, kept in zip(row["digests"], row["kept"]):
                nodes, states = sha.from_bytes(raw), sha.from_bytes(kept)
                slot = at % FAN
                sizes = np.minimum(FAN, nodes.shape[1] - (at - slot))
                digest = fold_level(digest, states[:, at], slot,
                                    lambda j, rows, nodes=nodes, at=at: nodes[:, at[rows] + j], sizes)
                texts.append((raw.hex(), at.tolist()))
                at = at // FAN
            # levels above: the same slot and siblings for all rows
            upper = []
            for slot, state, others in zip(row["slots"], row["states"], row["siblings"]):
                rights = sha.from_bytes(others[32 * slot:])
                sizes = np.full(n, len(others) // 32 + 1)
                digest = fold_level(
                    digest, np.repeat(sha.from_bytes(state), n, axis=1), np.full(n, slot),
                    lambda j, rows, r=rights: np.repeat(r[:, j - 1: j], len(rows), axis=1), sizes)
                upper.append(others.hex())
            tail = "".join(upper)
            proofs = []
            for k in range(n):
                parts = []
                for text, places in texts:
                    p = places[k]
                    run = p - p % FAN
                    parts += text[64 * run: 64 * p], text[64 * (p + 1): 64 * (run + FAN)]
                proofs.append(hashlib.sha256(("".join(parts) + tail).encode()).hexdigest())
            leaves = texts[0][0] if texts else row["own"].hex()
            roots = sha.to_bytes(digest).hex()
            columns = [[row["tree"]] * n, row["places"], row["ids"],
                       [leaves[64 * p: 64 * p + 64] for p in pos.tolist()],
                       [row["subroot"].hex()] * n, [row["top"].hex()] * n, proofs,
                       [roots[64 * k: 64 * k + 64] for k in range(n)]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, ARROW_FOLDED)], schema=ARROW_FOLDED)
    return folded


def fold(spark: SparkSession, folder: str, replaced: DataFrame, deep: int = DEEP) -> DataFrame:
    """The root that each replaced leaf alone would give.

    ``replaced``: (tree, pos, doc_id, digest), each place at most once.  Returns
    per row its original leaf, subroot, root, the hash of all its siblings up to
    the root (``proof_sha256``) and ``folded_root``."""
    groups = (replaced.groupBy("tree", F.floor(F.col("pos") / FAN ** deep).alias("block"))
              .agg(F.collect_list(F.struct("pos", "doc_id", "digest")).alias("r"))
              .select("tree", "block", F.col("r.pos").alias("places"), F.col("r.doc_id").alias("ids"),
                      F.col("r.digest").alias("new")))
    blocks = _with_ways(_read(spark, f"{folder}/trees", 0), ways_to_root(spark, folder, deep))
    return blocks.join(groups, ["tree", "block"]).mapInArrow(_fold(deep), FOLDED)


def tamper_check(docs: DataFrame, folder: str, deep: int = DEEP) -> DataFrame:
    """Manifest of ``docs`` in ``folder``; then every row's leaf, tampered or
    original, folded to a root and compared with the manifest's."""
    build(docs, folder, {"tampered": F.when(tampered_text().isNotNull(), leaf(tampered_text()))},
          deep)
    spark = docs.sparkSession
    leaves = spark.read.parquet(f"{folder}/leaves").select(
        "tree", "pos", "doc_id", F.coalesce("tampered", "digest").alias("digest"))
    return fold(spark, folder, leaves, deep).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def _crc32_sql(text: str) -> str:
    """DuckDB: unsigned crc32 of an ASCII text."""
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len({text})), "
            f"lambda i: ascii(substr({text}, i + 1, 1))::BIGINT)), lambda a, b: list_reduce(list_prepend("
            "xor(a, b), range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) "
            "ELSE x >> 1 END)), 4294967295)")


def _field_sql(value: str) -> str:
    return f"coalesce(strlen({value})::VARCHAR || ':' || {value}, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(
        _field_sql(text if n == "text" else f"{n}::VARCHAR") for n in FIELDS) + ")"


_LOWER = f"translate(text, '{UPPER}', '{UPPER.lower()}')"
_RISE = """
  SELECT tree, lvl + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), any_value((n + 7) // 8)
  FROM {nodes} WHERE n > 1 GROUP BY tree, lvl, idx // 8"""
MERKLE_SQL = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf_sql('text')} AS leaf,
    CASE WHEN {_crc32_sql('doc_id::VARCHAR')} % 3 = 0 THEN {_leaf_sql(_LOWER)} END AS changed
  FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY tree) AS total FROM l),
nodes AS (SELECT tree, 0 AS lvl, pos AS idx, leaf AS h, total AS n FROM p UNION ALL {_RISE.format(nodes='nodes')}),
subs AS (SELECT tree, h, row_number() OVER (ORDER BY tree::BLOB) - 1 AS pos, count(*) OVER () AS total
         FROM nodes WHERE n = 1),
tops AS (SELECT '' AS tree, 0 AS lvl, pos AS idx, h, total AS n FROM subs
         UNION ALL {_RISE.format(nodes='tops')}),
runs AS (
  SELECT 0 AS part, tree, lvl, idx // 8 AS run, list(h ORDER BY idx) AS hs FROM nodes WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT 1, tree, lvl, idx // 8, list(h ORDER BY idx) FROM tops WHERE n > 1 GROUP BY ALL),
up AS (
  SELECT doc_id, tree AS own, p.pos AS own_pos, 0 AS part, tree, 0 AS lvl, p.pos AS idx, p.total AS n,
    coalesce(changed, leaf) AS h, '' AS proof FROM p
  UNION ALL
  SELECT up.doc_id, up.own, up.own_pos,
    CASE WHEN up.n > 1 THEN up.part ELSE 1 END, CASE WHEN up.n > 1 THEN up.tree ELSE '' END,
    CASE WHEN up.n > 1 THEN up.lvl + 1 ELSE 0 END, CASE WHEN up.n > 1 THEN up.idx // 8 ELSE subs.pos END,
    CASE WHEN up.n > 1 THEN (up.n + 7) // 8 ELSE subs.total END,
    CASE WHEN up.n > 1 THEN sha256(array_to_string(list_slice(hs, 1, idx % 8), '') || up.h
                                   || array_to_string(list_slice(hs, idx % 8 + 2, 8), '')) ELSE up.h END,
    CASE WHEN up.n > 1 THEN proof || array_to_string(list_slice(hs, 1, idx % 8), '')
                            || array_to_string(list_slice(hs, idx % 8 + 2, 8), '') ELSE proof END
  FROM up LEFT JOIN runs ON up.n > 1 AND runs.part = up.part AND runs.tree = up.tree
      AND runs.lvl = up.lvl AND runs.run = up.idx // 8
    JOIN subs ON subs.tree = up.own
  WHERE up.n > 1 OR up.part = 0)
SELECT p.doc_id, p.leaf, subs.h AS subroot, root.h AS root, sha256(up.proof) AS proof_sha256,
  up.h AS folded_root, up.h = root.h AS verified
FROM up JOIN p ON p.tree = up.own AND p.pos = up.own_pos JOIN subs ON subs.tree = up.own,
  (SELECT h FROM tops WHERE n = 1) root
WHERE up.part = 1 AND up.n = 1
"""
