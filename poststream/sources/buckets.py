"""Tables laid out in folders by the hash of a key, changed folder by folder.

``path/rows/bucket=b`` holds the rows whose key hashes to ``b``; the one-row
table ``path/state/at=N`` beside it says up to which batch they are folded, the
number of buckets and the rows' schema (the newest ``at`` counts).  A change
brings all rows of the buckets that it touches: they are written to
``path/_pending`` first, laid out the same way, then those folders and no others are
moved into their places: no row is read, shuffled or written again.  A run that
stops in between leaves what it has not moved in ``_pending``, and the next one
begins by finishing it, so no row is lost with a half-replaced folder.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path, list_folders, move_folder, path_exists

BUCKET = "bucket"
BUCKETS = 64
NEVER = -1


class State(NamedTuple):
    since: int
    buckets: int
    schema: T.StructType


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The folder that a key belongs to."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int").alias(BUCKET)


def newest(spark: SparkSession, path: str) -> int | None:
    """The largest N of the complete folders ``path/at=N``."""
    found = [int(n.removeprefix("at=")) for n in list_folders(spark, path) if n.startswith("at=")]
    done = [n for n in found if path_exists(spark, f"{path}/at={n}/_SUCCESS")]
    return max(done, default=None)


def state(spark: SparkSession, path: str) -> State | None:
    """What the table says about itself; None: there is no such table yet."""
    at = newest(spark, f"{path}/state")
    if at is None:
        return None
    row = spark.read.schema("buckets int, schema string").parquet(f"{path}/state/at={at}").first()
    return State(at, row["buckets"], T.StructType.fromJson(json.loads(row["schema"])))


def _write_state(spark: SparkSession, path: str, now: State) -> None:
    (spark.createDataFrame([(now.buckets, now.schema.json())], "buckets int, schema string")
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/state/at={now.since}"))


def read(spark: SparkSession, path: str, only: Sequence[int] | None = None) -> DataFrame:
    """Rows with their ``bucket``; ``only`` the given buckets' folders are read."""
    now = state(spark, path)
    schema = T.StructType(now.schema.fields + [T.StructField(BUCKET, T.IntegerType())])
    if not list_folders(spark, f"{path}/rows"):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    return rows if only is None else rows.where(F.col(BUCKET).isin([int(b) for b in only]))


def touched(rows: DataFrame) -> list[int]:
    """The buckets that ``rows`` fall in (at most the table's number of buckets)."""
    return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())


def replace(spark: SparkSession, path: str, rows: DataFrame, since: int, buckets: int) -> None:
    """Make ``rows`` the whole content of the buckets that occur in them."""
    pending = f"{path}/_pending"
    delete_path(spark, pending)
    # one file per bucket, more for a bucket that is large
    rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{pending}/rows")
    fields = [f for f in rows.schema.fields if f.name != BUCKET]
    _write_state(spark, pending, State(since, buckets, T.StructType(
        [T.StructField(f.name, f.dataType) for f in fields])))
    finish(spark, path)


def finish(spark: SparkSession, path: str) -> bool:
    """Bring in what a ``replace`` has prepared; True if there was something."""
    pending = f"{path}/_pending"
    now = state(spark, pending)
    if now is None:             # not fully prepared: the table is as it was
        delete_path(spark, pending)
        return False
    for name in list_folders(spark, f"{pending}/rows"):
        if name.startswith(f"{BUCKET}="):
            move_folder(spark, f"{pending}/rows/{name}", f"{path}/rows/{name}")
    _write_state(spark, path, now)
    for name in list_folders(spark, f"{path}/state"):
        if name != f"at={now.since}":
            delete_path(spark, f"{path}/state/{name}")
    delete_path(spark, pending)
    return True
