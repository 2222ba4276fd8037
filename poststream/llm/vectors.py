"""Sums of count vectors that tasks have gathered."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poststream.llm.arrowtext import release

GROUPS = 512


def gather(df: DataFrame, width: int,
           add: Callable[[np.ndarray, pa.RecordBatch], None]) -> np.ndarray:
    """Sum over all rows of ``df`` of int64 vectors of ``width``.

    Each task calls ``add(vector, batch)`` for its batches and returns one
    vector; vectors are summed in ``GROUPS`` groups of tasks, and the group sums
    in one last task, so one vector reaches the driver.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(width, np.int64)
        for batch in batches:
            add(vector, batch)
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int64()),
             pa.array([vector.tobytes()], pa.binary())], ["task", "vector"])
        release()

    def total(rows):
        import pandas as pd
        out = np.zeros(width, np.int64)
        for raw in rows["vector"]:
            out += np.frombuffer(raw, np.int64)
        return pd.DataFrame({"task": [int(rows["task"].iloc[0])], "vector": [out.tobytes()]})

    vectors = df.mapInArrow(task, "task long, vector binary")
    some = vectors.groupBy((F.col("task") % GROUPS).alias("part")).applyInPandas(
        total, "task long, vector binary")
    rows = some.groupBy(F.lit(0).alias("all")).applyInPandas(
        total, "task long, vector binary").collect()
    return np.frombuffer(rows[0]["vector"], np.int64) if rows else np.zeros(width, np.int64)
