"""Tables below the shared checkpoint folder: lineage cuts with known sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from poststream.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back.

    Executors that are lost later cost no recomputation, and the planner knows
    the real size, so small tables are broadcast only when they are small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
