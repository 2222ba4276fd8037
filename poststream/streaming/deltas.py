"""Panel counts kept by changes instead of being counted anew.

Each batch of the keyed log stores signed counts per (category, skill): the new
version of a post adds its pairs, the version that it replaces takes its own
away.  The row with NULL skill counts the posts of a category.  A refresh sums
these small tables; only rest buckets (posts with none of the top skills) still
need the posts themselves.  ``fold_deltas`` sums old batches into one table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path, list_folders
from ..sources import buckets as bk
from .stream import batches, latest_per_id, read_log, retire

COUNTS = T.StructType([T.StructField("category", T.StringType()),
                       T.StructField("skill", T.StringType()),
                       T.StructField("posts", T.LongType())])


def signed_counts(new: DataFrame, old: DataFrame, category: str = "category",
                  skills: str = "skills_array") -> DataFrame:
    """(category, skill, posts): what ``new`` versions add and ``old`` ones take
    away; pairs that come out even are left out."""
    both = new.select(category, skills, F.lit(1).alias("sign")).unionByName(
        old.select(category, skills, F.lit(-1).alias("sign")))
    post = F.array(F.lit(None).cast("string"))
    pairs = both.select(F.col(category).alias("category"), "sign", F.explode(F.concat(
        post, F.array_distinct(F.array_compact(F.col(skills))))).alias("skill"))
    return (pairs.groupBy("category", "skill").agg(F.sum("sign").cast("long").alias("posts"))
            .where("posts <> 0"))


def replaced_versions(spark: SparkSession, log: str, batch_id: int, keys: DataFrame,
                      columns: Sequence[str], base: str | None = None,
                      order: Sequence[str] = ("batch_id", "created_utc")) -> DataFrame:
    """The versions of ``keys`` that were current before batch ``batch_id``:
    from the buckets of the base that the keys fall in, and the log's newer
    batches (each key once in a batch, as ``delta_writer`` leaves it); narrow
    columns only."""
    names = list(keys.columns)
    now = bk.state(spark, base) if base else None
    wanted = list(dict.fromkeys([*names, *columns, *[c for c in order if c != "batch_id"]]))
    found = []
    if now:
        placed = keys.withColumn(bk.BUCKET, bk.bucket_of(names, now.buckets))
        old = bk.read(spark, base, bk.touched(placed)).select(*wanted, bk.BUCKET)
        found.append(old.drop(bk.BUCKET).withColumn("batch_id", F.lit(now.since).cast("long")))
    since = now.since if now else bk.NEVER
    if any(since < n < batch_id for n in batches(spark, log)):
        found.append(read_log(spark, log, since).where(F.col("batch_id") < batch_id)
                     .select(*wanted, "batch_id"))
    if not found:
        return spark.createDataFrame([], keys.sparkSession.read.parquet(
            f"{log}/batch_id={batch_id}").select(*wanted).schema)
    rows = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    mine = keys.toDF(*[f"_{k}" for k in names])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in names]
    return latest_per_id(rows.join(mine, same, "left_semi"), names, order).drop("batch_id")


def delta_writer(log: str, deltas: str, base: str | None = None, key: Sequence[str] | str = "id",
                 category: str = "category", skills: str = "skills_array",
                 order: Sequence[str] = ("batch_id", "created_utc")
                 ) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: the newest version of each key in the batch goes to
    ``log/batch_id=N`` and their signed counts to ``deltas/batch_id=N``, both overwritten, so a replayed batch
    writes the same again.  A batch that the base at ``base`` has folded is
    complete already and left alone."""
    keys = [key] if isinstance(key, str) else list(key)
    within = [c for c in order if c != "batch_id"]
    narrow = list(dict.fromkeys([*keys, category, skills, *within]))

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        now = bk.state(spark, base) if base else None
        if now and now.since >= batch_id:
            return
        latest_per_id(batch, keys, within).write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")
        new = spark.read.parquet(f"{log}/batch_id={batch_id}").select(*narrow)
        old = replaced_versions(spark, log, batch_id, new.select(*keys), [category, skills], base, order)
        signed_counts(new, old, category, skills).write.mode("overwrite").parquet(
            f"{deltas}/batch_id={batch_id}")
    return write


def read_counts(spark: SparkSession, deltas: str, sums: str | None = None) -> DataFrame:
    """(category, skill, posts) of all current posts: the newest sums and the
    deltas after them.  A skill of NULL stands for the posts themselves."""
    at = bk.newest(spark, sums) if sums else None
    parts = read_log(spark, deltas, bk.NEVER if at is None else at, COUNTS).select(*COUNTS.names)
    if at is not None:
        parts = parts.unionByName(spark.read.schema(COUNTS).parquet(f"{sums}/at={at}"))
    return (parts.groupBy("category", "skill").agg(F.sum("posts").alias("posts"))
            .where("posts <> 0"))


def fold_deltas(spark: SparkSession, deltas: str, sums: str) -> int:
    """Sum all deltas into ``sums/at=N`` (N: the last batch), then delete the
    summed batches and older sums."""
    at = bk.newest(spark, sums)
    last = max([bk.NEVER if at is None else at, *batches(spark, deltas)])
    if last != at and last != bk.NEVER:
        read_counts(spark, deltas, sums).write.mode("overwrite").parquet(f"{sums}/at={last}")
    retire(spark, deltas, last)
    for name in list_folders(spark, sums):
        if name != f"at={last}":
            delete_path(spark, f"{sums}/{name}")
    return last
