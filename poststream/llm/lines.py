"""Lines that many documents share are dropped, by probing hashed arrays.

A line's key is the line without ASCII blanks at its ends, A-Z lower-cased; its
hash has 128 bits (XXH3).  Keys of ``min_chars`` code points or more that stand in
``min_docs`` documents or more (a row of the table is a document, whatever its id)
lose all their lines.  The rest of the lines are joined by ``\\n`` again.

1. Tasks count each key once per document, merge by slice of text, and send
   (hash, count) pairs; lines themselves never cross a shuffle.
2. The distinct hashes are split into shards of about ``SHARD_KEYS``; each shard
   becomes a minimal perfect hash (levels of bits: a key that is alone on its bit
   stays, the others go on to the next level; its index is the rank of its bit)
   with a fingerprint and a count per index, in the least width that holds them:
   about six bytes a key.  No shard depends on another, so a lost one is made anew.
3. The documents' hashes go to their shards and probe the arrays as a stream,
   sorted behind their shard's row, so a task holds one shard and one batch.
   Hashes of ``HOT_DOCS`` documents or more that hold over a ``MOST_HOT``-th of all
   (at most ``MOST_HOT`` of them, a megabyte) don't travel: every task has their
   verdict.  What comes back is the hashes to drop, by document.
4. Documents meet their verdicts on (doc_id, hash of the text): Spark broadcasts
   the verdicts while they are small and else sorts both sides.

Every probed hash is in the index, so a verdict errs only if two different keys
agree in all 128 bits.  NULL and empty texts are one empty line and stay; the
empty key is never dropped with ``min_chars`` of 1 or more.  Repeated rows, and
rows of one id, count as documents of their own.  An empty table gives no rows.
Extra columns are ignored.  Texts of any length are split whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poststream.llm.arrowtext import release, slices, text_buffer, whole_texts
from poststream.llm.tables import stored

MIN_CHARS = 1
MIN_DOCS = 10
SHARD_KEYS = 4096
HOT_DOCS = 1000
MOST_HOT = 1 << 16
ROOM = 1.5      # bits of a level for each of its keys

COUNTS = "a long, b long, n long"
ARROW_COUNTS = pa.schema([(n, pa.int64()) for n in ("a", "b", "n")])
INDEX = ("shard long, keys long, docs long, sizes array<long>, bits binary, ranks binary, "
         "prints binary, counts binary, width int")
ARROW_INDEX = pa.schema([
    ("shard", pa.int64()), ("keys", pa.int64()), ("docs", pa.int64()), ("sizes", pa.list_(pa.int64())),
    ("bits", pa.binary()), ("ranks", pa.binary()), ("prints", pa.binary()), ("counts", pa.binary()),
    ("width", pa.int32())])
PROBES = "doc_id long, ta long, tb long, a long, b long"
ARROW_PROBES = pa.schema([(n, pa.int64()) for n in ("doc_id", "ta", "tb", "a", "b")])
KEPT = "doc_id long, n_lines long, n_dropped long, kept string"
ARROW_KEPT = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()),
                        ("kept", pa.string())])


def line_keys(text: bytes) -> list[bytes]:
    """The key of each line (bytes.lower and bytes.strip are ASCII only)."""
    return [line.strip() for line in text.lower().split(b"\n")]


def _digest(key: bytes, min_chars: int) -> bytes | None:
    if min_chars > len(key) or min_chars > 1 and min_chars > len(key.decode()):
        return None
    return xxhash.xxh3_128_digest(key)


def _digests(text: bytes, min_chars: int) -> set[bytes]:
    found = {_digest(key, min_chars) for key in set(line_keys(text))}
    found.discard(None)
    return found


def _texts(part: pa.RecordBatch) -> Iterator[bytes]:
    data, off = text_buffer(part.column(part.schema.get_field_index("text")))
    raw = data.tobytes()
    for begin, end in zip(off[:-1].tolist(), off[1:].tolist()):
        yield raw[begin:end]


def _words(digests: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _count(min_chars: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                docs: Counter[bytes] = Counter()
                for text in _texts(part):
                    docs.update(_digests(text, min_chars))
                a, b = _words(list(docs))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(b), pa.array(list(docs.values()), pa.int64())],
                    schema=ARROW_COUNTS)
        release()
    return task


def line_counts(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(a, b, n): both halves of each distinct key's hash and its documents."""
    return (whole_texts(docs).select("text").mapInArrow(_count(min_chars), COUNTS)
            .groupBy("a", "b").agg(F.sum("n").alias("n")))


def _mix(a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
    """A new 64-bit hash for each level, from both halves."""
    step = np.uint64(level * 0xD1B54A32D192ED03 % (1 << 64))
    x = a ^ (b * np.uint64(0x9E3779B97F4A7C15) + step)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shard:
    """Minimal perfect hash, fingerprints and counts of one shard."""

    def __init__(self, sizes, bits: np.ndarray, ranks: np.ndarray, prints: np.ndarray, counts: np.ndarray):
        self.sizes, self.bits, self.ranks, self.prints, self.counts = sizes, bits, ranks, prints, counts

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> Shard:
        a, b = a.astype(np.uint64), b.astype(np.uint64)
        place, rest, base, sizes = np.zeros(len(a), np.int64), np.arange(len(a)), 0, []
        while len(rest):    # distinct 128-bit keys part sooner or later
            size = 64 * -(-int(len(rest) * ROOM) // 64)
            at = (_mix(a[rest], b[rest], len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size)[at] == 1
            place[rest[alone]] = base + at[alone]
            rest, base = rest[~alone], base + size
            sizes.append(size)
        flags = np.zeros(base, np.uint8)
        flags[place] = 1
        bits = np.packbits(flags, bitorder="little").view("<u8")
        ranks = np.zeros(len(bits), "<u4")
        np.cumsum(np.bitwise_count(bits)[:-1], out=ranks[1:])
        order = np.argsort(place)   # the rank of its bit is a key's index
        return cls(sizes, bits, ranks, b[order].astype("<u4"),
                   n[order].astype(np.min_scalar_type(int(n.max(initial=0)))))

    @classmethod
    def read(cls, row: dict) -> Shard:
        return cls(row["sizes"], np.frombuffer(row["bits"], "<u8"), np.frombuffer(row["ranks"], "<u4"),
                   np.frombuffer(row["prints"], "<u4"), np.frombuffer(row["counts"], f"<u{row['width']}"))

    def count(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Documents of each key; 0 if its fingerprint isn't the stored one."""
        a, b = a.astype(np.uint64), b.astype(np.uint64)
        place, rest, base = np.full(len(a), -1), np.arange(len(a)), 0
        for level, size in enumerate(self.sizes):
            at = base + (_mix(a[rest], b[rest], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1) == 1
            place[rest[hit]] = at[hit]
            rest, base = rest[~hit], base + size
            if not len(rest):
                break
        out = np.zeros(len(a), np.int64)
        found = np.flatnonzero(place >= 0)
        at = place[found]
        below = self.bits[at >> 6] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        index = self.ranks[at >> 6].astype(np.int64) + np.bitwise_count(below)
        same = self.prints[index] == b[found].astype(np.uint32)
        out[found[same]] = self.counts[index[same]]
        return out


def _index(table: pa.Table) -> pa.Table:
    a, b, n = (table[c].to_numpy() for c in ("a", "b", "n"))
    s = Shard.build(a, b, n)
    row = [table["shard"][0].as_py(), len(a), int(n.sum()), s.sizes, s.bits.tobytes(), s.ranks.tobytes(),
           s.prints.tobytes(), s.counts.tobytes(), s.counts.itemsize]
    return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, ARROW_INDEX)],
                                schema=ARROW_INDEX)


def _shard(shards: int) -> Column:
    return F.pmod("b", F.lit(shards))


def build_index(counts: DataFrame, shards: int) -> DataFrame:
    """One row per shard of the distinct hashes ``counts`` (a, b, n)."""
    return (counts.withColumn("shard", _shard(shards)).groupBy("shard")
            .applyInArrow(_index, INDEX))


def _probes(min_chars: int, hot: frozenset[bytes]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                keys = [_digests(text, min_chars) - hot for text in _texts(part)]
                counts = np.array([len(k) for k in keys], np.int64)
                a, b = _words([d for k in keys for d in k])
                rows = pa.array(np.repeat(np.arange(len(keys)), counts))
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)).take(rows) for c in ("doc_id", "ta", "tb")]
                    + [pa.array(a), pa.array(b)], schema=ARROW_PROBES)
        release()
    return task


def _verdicts(min_docs: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = None
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            kind = batch.column("kind").to_numpy()
            cuts = np.flatnonzero((shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1])) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shard)]):
                part = batch.slice(begin, end - begin)
                if kind[begin] == 0:    # a shard's own row stands before its probes
                    arrays = Shard.read(part.select(["arrays"]).to_pylist()[0]["arrays"])
                    continue
                n = arrays.count(part.column("a").to_numpy(), part.column("b").to_numpy())
                rows = pa.array(np.flatnonzero(n >= min_docs))
                yield part.select(ARROW_PROBES.names).take(rows)
    return task


def probe(probes: DataFrame, index: DataFrame, shards: int, min_docs: int) -> DataFrame:
    """The ``probes`` whose key stands in ``min_docs`` documents or more."""
    own = F.struct("sizes", "bits", "ranks", "prints", "counts", "width")
    nothing = [F.lit(None).cast("long").alias(c) for c in ARROW_PROBES.names]
    arrays = index.select("shard", F.lit(0).alias("kind"), *nothing, own.alias("arrays"))
    rows = probes.select(_shard(shards).alias("shard"), F.lit(1).alias("kind"), *ARROW_PROBES.names,
                         F.lit(None).cast(arrays.schema["arrays"].dataType).alias("arrays"))
    return (arrays.unionByName(rows).repartition("shard").sortWithinPartitions("shard", "kind")
            .mapInArrow(_verdicts(min_docs), PROBES))


def _keep(min_chars: int, hot: frozenset[bytes]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                drops = part.column(part.schema.get_field_index("drops")).to_pylist()
                lines, dropped, kept = [], [], []
                for text, own in zip(_texts(part), drops):
                    gone = {int(a).to_bytes(8, "little", signed=True)
                            + int(b).to_bytes(8, "little", signed=True)
                            for a, b in ((k["a"], k["b"]) for k in own or ())}
                    rows = text.split(b"\n")
                    stay = [row for row, key in zip(rows, line_keys(text))
                            if (d := _digest(key, min_chars)) is None or d not in hot and d not in gone]
                    lines.append(len(rows))
                    dropped.append(len(rows) - len(stay))
                    kept.append(b"\n".join(stay))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64()),
                     pa.array(kept, pa.binary()).cast(pa.string())], schema=ARROW_KEPT)
        release()
    return task


def drop_common_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
                      shard_keys: int = SHARD_KEYS, hot_docs: int = HOT_DOCS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept) of every document."""
    min_chars = max(1, min_chars)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    named = whole_texts(docs, F.xxhash64("text").alias("ta"), F.xxhash64(F.lit(1), "text").alias("tb"))
    counts = stored(line_counts(docs, min_chars), "line-counts")
    keys, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    hot = counts.where((F.col("n") >= hot_docs) & (F.col("n") > total / MOST_HOT)).collect()
    known = {int(r["a"]).to_bytes(8, "little", signed=True) + int(r["b"]).to_bytes(8, "little", signed=True):
             r["n"] for r in hot}    # under MOST_HOT, since their documents add up to the total
    shards = max(1, -(-keys // shard_keys))
    index = stored(build_index(counts, shards), "line-index")
    probes = named.mapInArrow(_probes(min_chars, frozenset(known)), PROBES)
    drops = stored(probe(probes, index, shards, min_docs).groupBy("doc_id", "ta", "tb")
                   .agg(F.collect_set(F.struct("a", "b")).alias("drops")), "line-drops")
    drops = drops.withColumnsRenamed({"doc_id": "i", "ta": "ia", "tb": "ib"})
    both = named.join(drops, F.expr("doc_id <=> i and ta = ia and tb = ib"), "left")
    gone = frozenset(k for k, n in known.items() if n >= min_docs)
    return both.select("doc_id", "text", "drops").mapInArrow(_keep(min_chars, gone), KEPT)


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LINES_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines
           FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d),
k AS (SELECT *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
common AS (SELECT key FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key
           HAVING count(DISTINCT r) >= {MIN_DOCS})
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(common.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE common.key IS NULL), ''))
    AS kept_sha256
FROM k LEFT JOIN common ON common.key = k.key GROUP BY r
"""
