"""Top-n rows per group that survives a hot group.

A plain ``row_number() OVER (PARTITION BY g ...)`` sends every row of a group
to one task; if one source holds a third of all posts that task sorts a third
of the data.  Here the group is first split by a hash salt: each
(group, salt) keeps its own n best rows (Spark also applies a partial
WindowGroupLimit before that shuffle), then the group keeps the n best of at
most ``salt_buckets * n`` survivors.  Exact: the overall top n lies inside the
union of the per-salt top n.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

DEFAULT_SALT_BUCKETS = 64


def top_n_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int,
                    salt_on: Sequence[str] | None = None,
                    salt_buckets: int = DEFAULT_SALT_BUCKETS,
                    rank_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows of each group under ``order`` (which should
    be a total order, e.g. ending in a key, for repeatable results)."""
    if n <= 0:
        raise ValueError("n must be positive")
    salt_cols = list(salt_on) if salt_on else df.columns
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_cols), F.lit(salt_buckets)))
    w1 = Window.partitionBy(*groups, "_salt").orderBy(*order)
    stage1 = (salted.withColumn("_rn", F.row_number().over(w1))
              .where(F.col("_rn") <= n).drop("_rn", "_salt"))
    w2 = Window.partitionBy(*groups).orderBy(*order)
    out = stage1.withColumn("_rn", F.row_number().over(w2)).where(F.col("_rn") <= n)
    return out.withColumnRenamed("_rn", rank_col) if rank_col else out.drop("_rn")


def global_rank(df: DataFrame, order: Sequence[Column], rank_col: str = "position"
                ) -> DataFrame:
    """1-based consecutive position of every row under ``order`` (a total
    order), without pulling all rows into one task.

    The rows are range-partitioned and sorted by ``order`` (Spark samples the
    ranges, so a heavy key range is split like any other), each row gets its
    partition id and index inside the partition, and the sorted result is
    checkpointed so those ids stay fixed.  Per-partition counts -- one row
    per partition -- give each partition's offset, which a broadcast join
    adds back.
    """
    ids = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    # reliable checkpoint: recomputation must not re-sample the range bounds
    ids = materialize(ids)
    mask = (1 << 33) - 1
    ids = ids.select("*", F.shiftright("_mid", 33).alias("_part"),
                     (F.col("_mid").bitwiseAND(F.lit(mask))).alias("_local"))
    sizes = ids.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    # one row per partition: a single ordered window over them is small
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0))
                           .alias("_offset"))
    ranked = ids.join(F.broadcast(offsets), "_part")
    return ranked.select(*df.columns, (F.col("_offset") + F.col("_local") + 1)
                         .cast("long").alias(rank_col))
