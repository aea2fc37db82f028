"""Bounded and streaming reads of the Parquet event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def read_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    table = spark.read.parquet(f"{folder}/{name}.parquet")
    return table.select(*columns) if columns else table


def read_events(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    delay: str | None = None,
    files_per_trigger: int | None = None,
    bytes_per_trigger: str | None = None,
) -> DataFrame:
    """The event table as rows with an instant ``ts`` (event time).

    ``delay`` declares how far out of order rows may come ("1 millisecond" for a source
    that never goes back); leave it out for a stream without event time.  The two
    ``per_trigger`` bounds limit how much one micro-batch takes in.
    """
    if not stream:
        return spark.read.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    rows = reader.parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))
    return rows.withWatermark("ts", delay) if delay else rows


def read_stream(spark: SparkSession, folder: str, name: str, *columns: str, files_per_trigger: int | None = None) -> DataFrame:
    """A table of the folder as a stream of its files; declare event time on it with ``withWatermark``."""
    # as a pattern the path may be one file or a directory of files; it matches this one name
    path = f"{folder}/{name[:-1]}[{name[-1]}].parquet"
    reader = spark.readStream.schema(read_table(spark, folder, name).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.parquet(path)
    return rows.select(*columns) if columns else rows


def stamp_ingest(df: DataFrame, name: str = "ingest_time") -> DataFrame:
    """Processing time of the row, for pipelines that run without event time."""
    return df.withColumn(name, F.current_timestamp())


def plain_times(df: DataFrame) -> DataFrame:
    """Instants as zone-less timestamps in UTC, the form results are compared in."""
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times}) if times else df
