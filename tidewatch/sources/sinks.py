"""Streaming sinks: labelled output, fan-out to several consumers, where checkpoints live."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

CHECKPOINT_CONF = "spark.checkpoint.dir"


def one_machine(master: str) -> bool:
    """Whether driver and tasks are one process, so that a local folder is seen by all."""
    return master == "local" or master.startswith("local[")


def checkpoint_folder(spark: SparkSession, name: str) -> str:
    """A folder for one query's offsets and state under the shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names shared storage.  Only a local master may
    fall back to a fresh temporary folder.
    """
    shared = spark.conf.get(CHECKPOINT_CONF, None)
    if shared:
        return f"{shared.rstrip('/')}/{name}"
    if not one_machine(spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    return f"{tempfile.mkdtemp(prefix='tidewatch-')}/{name}"


def write_labelled(
    df: DataFrame,
    label: str,
    checkpoint: str,
    form: str = "console",
    mode: str = "append",
    path: str | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Start one named sink.  ``interval`` is also the checkpoint interval; None drains and stops.

    The ``parquet`` form commits files through a log, so a restart neither loses nor
    repeats rows; console output may repeat after a restart.
    """
    writer = df.writeStream.format(form).queryName(label).outputMode(mode).option("checkpointLocation", checkpoint)
    if path:
        writer = writer.option("path", path)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def fan_out(
    df: DataFrame, label: str, checkpoint: str, consumers: dict[str, Callable[[DataFrame, int], None]], interval: str | None = None
) -> StreamingQuery:
    """Feed every micro-batch to several consumers; each sees every row.

    A consumer gets ``(rows, batch_id)`` and must be idempotent on the batch id, since a
    batch is delivered again after a failure.
    """

    def deliver(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for consume in consumers.values():
                consume(batch, batch_id)
        finally:
            batch.unpersist()

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    writer = df.writeStream.queryName(label).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).foreachBatch(deliver).start()


def overwrite_batch(path: str) -> Callable[[DataFrame, int], None]:
    """A file consumer that writes each batch to its own folder, so a repeat replaces it."""

    def consume(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return consume
