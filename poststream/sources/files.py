"""File readers for the batch side."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import list_folders


def read_training(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Training CSV with a header; every column text, no schema inference; a quote
    in a quoted field is doubled.  ``multi_line``: fields may hold line breaks (a
    file is then read by one task)."""
    return (spark.read.option("header", True).option("inferSchema", False).option("escape", '"')
            .option("multiLine", multi_line).csv(path))


def read_sources(spark: SparkSession, root: str, names: Sequence[str], by: str = "subreddit",
                 fmt: str = "parquet") -> tuple[list[DataFrame], dict[str, str]]:
    """The folders ``root/<by>=<name>`` of the configured sources, and which of them
    could not be read, with the reason: one broken source does not stop the others.

    Sources whose columns agree in type share one scan (partition discovery gives
    the source, schema merging the columns that only some have); one that differs in
    a type is a scan of its own with its columns cast.  ``ingest.union_sources``
    makes them one table."""
    broken: dict[str, str] = {}
    schemas = {}
    there = set(list_folders(spark, root))
    for name in names:                      # footers only
        folder = f"{by}={name}"
        try:
            if folder not in there:
                raise FileNotFoundError(f"no folder {folder}")
            schemas[name] = spark.read.format(fmt).option("mergeSchema", True).load(f"{root}/{folder}").schema
        except (PySparkException, Py4JError, OSError) as exc:
            broken[name] = str(exc).splitlines()[0]
    types, together, apart = {}, [], []
    for name, schema in schemas.items():
        fits = all(types.get(f.name, f.dataType) == f.dataType for f in schema)
        (together if fits else apart).append(name)
        if fits:
            types |= {f.name: f.dataType for f in schema}

    def scan(of: list[str]) -> DataFrame:
        return (spark.read.format(fmt).option("mergeSchema", True).option("basePath", root)
                .load([f"{root}/{by}={n}" for n in of]).withColumn(by, F.col(by).cast("string")))

    out = [scan(together)] if together else []
    for name in apart:
        own = scan([name])
        out.append(own.select(*[F.col(c).cast(types.get(c, own.schema[c].dataType)).alias(c)
                                for c in own.columns]))
    return out, broken
