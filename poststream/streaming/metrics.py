"""Counts of each micro-batch, observed while it runs and kept in a table.

The counts ride along with the batch (``observe``: no pass of their own); a
listener gets them with the query's progress and writes a small table, a folder
per query and batch, so a batch that runs again replaces its own counts.  Progress
reaches the listener once, after the batch: if the driver stops in between, that
batch's counts are missing.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

METRICS = "source string, sent long"


def observe_sources(df: DataFrame, sources: Sequence[str], source: str = "subreddit",
                    name: str = "sent") -> DataFrame:
    """Attach counts per configured source, and of all other rows, to a plan."""
    of = F.col(source)
    counts = [F.count_if(of == s).alias(f"s{i}") for i, s in enumerate(sources)]
    other = F.count_if(of.isNull() | ~of.isin(list(sources))).alias("other")
    return df.observe(name, *counts, other)


class SentMetrics(StreamingQueryListener):
    """Writes the counts of ``observe_sources`` to ``path``."""

    def __init__(self, spark: SparkSession, path: str, sources: Sequence[str], name: str = "sent"):
        self.spark, self.path, self.sources, self.name = spark, path, list(sources), name
        self.errors: list[str] = []
        self._ended: dict[str, threading.Event] = {}

    def _end(self, run_id: str) -> threading.Event:
        return self._ended.setdefault(str(run_id), threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is None:
            return
        try:    # a listener that raises is only logged; the errors are kept here
            counts = [(s, row[f"s{i}"]) for i, s in enumerate(self.sources)] + [(None, row["other"])]
            (self.spark.createDataFrame(counts, METRICS).where("sent > 0").coalesce(1)
             .write.mode("overwrite")
             .parquet(f"{self.path}/query={event.progress.id}/batch_id={event.progress.batchId}"))
        except Exception as exc:  # noqa: BLE001
            self.errors.append(str(exc))

    def onQueryTerminated(self, event) -> None:
        self._end(event.runId).set()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> bool:
        """Wait until all progress of an ended query has been written."""
        return self._end(query.runId).wait(seconds)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(source, sent, query, batch_id) of all batches; source NULL: all others."""
    return spark.read.schema(METRICS + ", query string, batch_id long").option("basePath", path).parquet(
        f"{path}/query=*/batch_id=*")
