"""Counters of a running query: observed on the rows, read from its progress, or kept with its batches."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def observed(df: DataFrame, name: str, **counters: Column) -> DataFrame:
    """Attach named aggregates, e.g. ``readings_processed=F.count(F.lit(1))``; rows pass unchanged."""
    return df.observe(name, *[column.alias(counter) for counter, column in counters.items()])


class Counters(StreamingQueryListener):
    """Totals of every query started after :meth:`attached`, over all of its batches.

    Each batch's figures are added as they are reported, so totals do not depend on how many
    batches a query remembers.  They count from the start or restart of a query's run.
    """

    def __init__(self) -> None:
        self._lock = threading.Condition()
        self._totals: dict[str, dict[str, dict[str, int]]] = {}
        self._late: dict[str, int] = {}
        self._ended: set[str] = set()

    @classmethod
    def attached(cls, spark: SparkSession) -> Counters:
        counters = cls()
        spark.streams.addListener(counters)
        return counters

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        with self._lock:
            run = str(progress.runId)
            for name, row in progress.observedMetrics.items():
                totals = self._totals.setdefault(run, {}).setdefault(name, {})
                for counter, value in row.asDict().items():
                    totals[counter] = totals.get(counter, 0) + (value or 0)
            late = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
            self._late[run] = self._late.get(run, 0) + late

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 30) -> None:
        """Wait until the last report of a query that has ended is in; reports come behind the query."""
        with self._lock:
            if not self._lock.wait_for(lambda: query.runId in self._ended, seconds):
                raise TimeoutError(f"no end of query {query.runId} was reported")

    def totals(self, query: StreamingQuery, name: str) -> dict[str, int]:
        """The counters attached under ``name`` by :func:`observed`, summed over all batches so far."""
        with self._lock:
            return dict(self._totals.get(query.runId, {}).get(name, {}))

    def rows_dropped_late(self, query: StreamingQuery) -> int:
        """Rows that came behind the watermark and were left out, over all batches so far."""
        with self._lock:
            return self._late.get(query.runId, 0)


def state_rows(query: StreamingQuery) -> int:
    """Rows in the query's state store after its last batch."""
    progress = query.lastProgress
    return sum(op["numRowsTotal"] for op in progress["stateOperators"]) if progress else 0


def keeping(path: str, consume: Callable[[DataFrame, int], None], **counters: Column) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that delivers a batch and keeps its counters below ``path``.

    Each batch has a folder of its own with one row, written after the batch was delivered; a batch
    that is delivered again after a failure or a restart replaces its row.  So totals are exact
    over stops, replays and restarts, whichever driver runs the query.  Use one path for each
    query, beside its checkpoint, on storage that outlives the driver.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            consume(batch, batch_id)
            row = batch.agg(*[column.cast("bigint").alias(name) for name, column in counters.items()])
            row.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()

    return deliver


def kept_totals(spark: SparkSession, path: str, *names: str, upto: int | None = None) -> dict[str, int]:
    """Totals of the counters kept below ``path``, of all batches or those up to a batch id."""
    kept = spark.read.option("basePath", path).schema(", ".join([*[f"{n} bigint" for n in names], "batch bigint"])).parquet(path)
    kept = kept if upto is None else kept.where(F.col("batch") <= upto)
    row = kept.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).first()
    return row.asDict()
