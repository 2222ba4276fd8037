"""Seen ledger: a durable set of ids already sent.

Two layouts.  A flat folder: each run appends its ids as Parquet files, and a
reader takes all of them (``read_ledger``, ``append_ledger``).  By buckets: a run
puts its ids into ``path/new/batch_id=N`` (``append_run``), and ``fold_ledger`` brings
the runs into ``path/ids``, laid out by the hash of the id, beside a Bloom filter
per bucket in ``path/filter``.  ``unseen`` asks the filters first: only ids that they
let through are joined, and only with the buckets that these fall in, so a run
reads about as many ids as it brings, however long the ledger is.

Appending only after the records are written keeps delivery at least
once; the keyed write downstream absorbs the rare repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path, list_folders, path_exists, stored
from . import buckets as bk

LEDGER_SCHEMA = T.StructType([T.StructField("id", T.StringType())])
BLOCK_BITS = 8 * 4096       # what a bitmap aggregate holds
BLOCK_IDS = 3000            # eleven bits an id: with HASHES, about one in 150 passes wrongly
HASHES = 6
FOLD_EVERY = 16             # runs


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ids in the ledger (empty when the ledger does not exist yet)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def append_ledger(sent: DataFrame, path: str, key: str = "id") -> None:
    """Append the ids of ``sent`` to the ledger."""
    sent.select(F.col(key).cast("string").alias("id")).write.mode("append").parquet(path)


def grow_ledger(ledger: DataFrame, sent: DataFrame, key: str = "id") -> DataFrame:
    """The ledger after a run: old ids plus the sent ones, distinct."""
    return (ledger.select(F.col("id").cast("string").alias("id"))
            .unionByName(sent.select(F.col(key).cast("string").alias("id")))
            .distinct())


def runs(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the runs that are not folded yet."""
    now = bk.state(spark, f"{path}/ids")
    names = [n.removeprefix("batch_id=") for n in list_folders(spark, f"{path}/new")]
    return sorted(int(n) for n in names if n.isdigit() and int(n) > (now.since if now else bk.NEVER))


def next_run(spark: SparkSession, path: str) -> int:
    now = bk.state(spark, f"{path}/ids")
    return 1 + max([now.since if now else bk.NEVER, *runs(spark, path)])


def append_run(sent: DataFrame, path: str, run: int | None = None, key: str = "id") -> int:
    """The ids of ``sent`` as run ``run`` (default: the next one); writing a run
    again replaces it."""
    run = next_run(sent.sparkSession, path) if run is None else run
    (sent.select(F.col(key).cast("string").alias("id")).write.mode("overwrite")
     .parquet(f"{path}/new/batch_id={run}"))
    return run


def _new_ids(spark: SparkSession, path: str, numbers: list[int]) -> DataFrame:
    if not numbers:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(*[f"{path}/new/batch_id={n}" for n in numbers])


def _block(blocks: str) -> Column:
    return F.pmod(F.xxhash64("id", F.lit(1)), F.col(blocks)).cast("int")


def _positions() -> list[Column]:
    """The bits of an id in its block."""
    return [F.pmod(F.xxhash64("id", F.lit(2 + i)), F.lit(BLOCK_BITS)) for i in range(HASHES)]


def build_filter(ids: DataFrame) -> DataFrame:
    """(bucket, blocks, block, bits) of ``ids`` (id, bucket): each bucket has as
    many blocks as its ids need; the bits are set by bitmap aggregates."""
    sizes = ids.groupBy(bk.BUCKET).agg(F.ceil(F.count(F.lit(1)) / BLOCK_IDS).alias("blocks"))
    return (ids.join(sizes, bk.BUCKET)
            .select(bk.BUCKET, "blocks", _block("blocks").alias("block"),
                    F.explode(F.array(*_positions())).alias("at"))
            .groupBy(bk.BUCKET, "blocks", "block").agg(F.bitmap_construct_agg("at").alias("bits")))


def may_hold(ids: DataFrame, filters: DataFrame) -> DataFrame:
    """The ``ids`` (id, bucket) that the filters let through: all that are in the
    ledger and a few that are not."""
    sizes = filters.groupBy(bk.BUCKET).agg(F.max("blocks").alias("blocks"))     # a row per bucket
    asked = ids.join(sizes, bk.BUCKET).withColumn("block", _block("blocks")).drop("blocks")
    hit = None
    for at in _positions():
        byte = F.conv(F.hex(F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10)
        one = F.getbit(byte.cast("long"), (at % 8).cast("int")) == 1
        hit = one if hit is None else hit & one
    return asked.join(filters.select(bk.BUCKET, "block", "bits"), [bk.BUCKET, "block"]).where(hit).select(
        "id", bk.BUCKET)


def seen(ids: DataFrame, path: str, before: int | None = None) -> DataFrame:
    """Those of ``ids`` (a column ``id``) that the ledger by buckets holds, in runs
    before ``before`` if given."""
    spark = ids.sparkSession
    numbers = [n for n in runs(spark, path) if before is None or n < before]
    known = ids.join(_new_ids(spark, path, numbers), "id", "left_semi").select("id")
    now = bk.state(spark, f"{path}/ids")
    if now is None:
        return known
    placed = ids.select("id").where("id IS NOT NULL").withColumn(
        bk.BUCKET, bk.bucket_of(["id"], now.buckets))
    maybe = stored(may_hold(placed, bk.read(spark, f"{path}/filter")), "maybe-seen")
    held = bk.read(spark, f"{path}/ids", bk.touched(maybe))
    return known.unionByName(maybe.join(held, ["id", bk.BUCKET], "left_semi").select("id"))


def unseen(rows: DataFrame, path: str, key: str = "id", before: int | None = None) -> DataFrame:
    """``rows`` whose id the ledger by buckets does not hold (NULL ids stay)."""
    ids = rows.select(F.col(key).cast("string").alias("id"))
    known = seen(ids, path, before).select(F.col("id").alias("_seen"))
    return rows.join(known, F.col(key).cast("string") == F.col("_seen"), "left_anti")


def fold_ledger(spark: SparkSession, path: str, buckets: int = bk.BUCKETS,
                before: int | None = None) -> int:
    """Bring the runs (before ``before``) into the buckets: only those that the new
    ids fall in are rewritten, and their filters.  The filters go first, so that
    one that stops in between lets too many ids through, never too few.  The
    folded runs are deleted.  Returns the last folded run."""
    ids, filters = f"{path}/ids", f"{path}/filter"
    bk.finish(spark, filters)
    bk.finish(spark, ids)
    now = bk.state(spark, ids)
    buckets = now.buckets if now else buckets
    numbers = [n for n in runs(spark, path) if before is None or n < before]
    last = max(numbers, default=now.since if now else bk.NEVER)
    if numbers:
        new = stored(_new_ids(spark, path, numbers).where("id IS NOT NULL").distinct()
                     .withColumn(bk.BUCKET, bk.bucket_of(["id"], buckets)), "ledger-new")
        rows = new
        if now:
            old = bk.read(spark, ids, bk.touched(new))
            rows = old.unionByName(new.join(old, ["id", bk.BUCKET], "left_anti"))
        bk.replace(spark, filters, build_filter(rows), last, buckets)
        bk.replace(spark, ids, rows, last, buckets)
    for name in list_folders(spark, f"{path}/new"):
        number = name.removeprefix("batch_id=")
        if number.isdigit() and int(number) <= last:
            delete_path(spark, f"{path}/new/{name}")
    return last
