"""Session settings and lineage cuts.

Everything runs in UTC so that epoch seconds, ISO text and hour buckets mean
the same on every executor.  AQE re-plans joins and coalesces small shuffle
partitions at run time; the window-group-limit threshold is raised so that the
per-source top-n (first run: 2,000 posts per source) still gets a partial limit
before its shuffle.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of lineage cuts are removed once nothing refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # stream state beyond the heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_SCRATCH: list[str] = []


def get_session(master: str | None = None, app: str = "poststream",
                shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """Build (or reuse) a session with the library's settings.

    On a cluster leave ``master`` as None so spark-submit decides; tests pass
    ``local[*]`` and a small shuffle width.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULTS, **extra}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    apply_runtime_settings(spark)
    return spark


def apply_runtime_settings(spark: SparkSession) -> None:
    """Set the SQL settings the library relies on in an existing session."""
    for k, v in DEFAULTS.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    On a cluster ``spark.checkpoint.dir`` is set by the deployment and points
    at shared storage; it is only read here.  Only when nothing is set and
    the master is local (tests) a private temp folder is chosen; a cluster
    without the setting is an error, since its machines share no temp folder.
    """
    sc = spark.sparkContext
    active = sc.getCheckpointDir()
    if active:
        return active
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="poststream-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint directory."""
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    _SCRATCH.append(path)
    return path


def clean_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders that this process has made (call it when no
    result that reads them is needed any more); returns how many."""
    gone = 0
    while _SCRATCH:
        gone += delete_path(spark, _SCRATCH.pop())
    return gone


def stored(df: DataFrame, name: str = "stored") -> DataFrame:
    """Write ``df`` as Parquet in scratch and read it back: a lineage cut
    whose real size the planner knows."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _fs_path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does a file or folder exist (on any Hadoop file system)?"""
    jpath, fs = _fs_path(spark, path)
    return bool(fs.exists(jpath))


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder (on any Hadoop file system)."""
    jpath, fs = _fs_path(spark, path)
    return bool(fs.delete(jpath, True))


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another (on any Hadoop file system)."""
    jsource, fs = _fs_path(spark, source)
    jtarget, _ = _fs_path(spark, target)
    fs.delete(jtarget, True)
    fs.mkdirs(jtarget.getParent())
    if not fs.rename(jsource, jtarget):
        raise OSError(f"cannot move {source} to {target}")


def list_folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders directly in a folder."""
    jpath, fs = _fs_path(spark, folder)
    if not fs.exists(jpath):
        return []
    return [st.getPath().getName() for st in fs.listStatus(jpath) if st.isDirectory()]


def count_files(spark: SparkSession, folder: str, suffix: str = ".parquet") -> int:
    """Number of data files directly in a folder (a metadata listing)."""
    jpath, fs = _fs_path(spark, folder)
    if not fs.exists(jpath):
        return 0
    return sum(1 for st in fs.listStatus(jpath) if st.getPath().getName().endswith(suffix))


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in ``spark.checkpoint.dir``.

    Used where one expensive projection (skill extraction over whole texts)
    feeds two passes, e.g. counts and the rest bucket; a lost executor then
    re-reads the written blocks instead of re-running the regex.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
