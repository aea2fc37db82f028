"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

HOT_ROWS_CONF = "spark.tidewatch.hotRows"
DEFAULT_HOT_ROWS = 5_000_000

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(cores: str = "8", app: str = "tidewatch", **conf: str) -> SparkSession:
    """A single-JVM session for tests and the benchmark (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .config("spark.sql.streaming.metricsEnabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the one setting results depend on: event times are read and shown as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def hot_rows(spark: SparkSession) -> int:
    """Rows of one key that a single task may hold before the key's timeline is split."""
    return int(spark.conf.get(HOT_ROWS_CONF, str(DEFAULT_HOT_ROWS)))
