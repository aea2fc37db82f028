"""Words, hashes, Arrow pieces and shared tables used by the text operators.

Text operators run as ``mapInArrow`` stages: Spark splits and shuffles the rows, a task sees
Arrow batches, and numpy works on the UTF-8 bytes of a bounded piece of a batch at a time.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.sources.sinks import CHECKPOINT_CONF, one_machine

BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: bytes of text a task looks at together; a longer text is looked at alone, and whole
PIECE_BYTES = 1_000_000

#: rows of an Arrow batch where a row holds a text
TEXT_ROWS = 2_000

WORD_BYTES = np.ones(256, dtype=bool)
WORD_BYTES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (a new array)."""
    x = x + MULTIPLIER
    x ^= x >> np.uint64(30)
    x *= MIX_A
    x ^= x >> np.uint64(27)
    x *= MIX_B
    x ^= x >> np.uint64(31)
    return x


BYTE_HASH = mix64(np.arange(256, dtype=np.uint64))


def powers(n: int) -> np.ndarray:
    """1, P, P^2, ... modulo 2^64."""
    p = np.full(max(n, 1), MULTIPLIER, dtype=np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def segment_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs data[start:start + length], all of length 1 or more."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    before = np.cumsum(lengths) - lengths
    position = np.arange(int(before[-1] + lengths[-1])) - np.repeat(before, lengths)
    taken = BYTE_HASH[data[np.repeat(starts, lengths) + position]]
    taken *= powers(int(lengths.max()))[position]
    return mix64(np.add.reduceat(taken, before) + lengths.astype(np.uint64))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows and the n + 1 offsets of the rows in them; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each piece has at most ``limit`` bytes of text, or one row.

    At the end of the task's rows, memory that Arrow holds in reserve goes back to the system.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        total, start = np.cumsum(size.astype(np.int64)), 0
        while start < batch.num_rows:
            done = int(total[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(total, done + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    pa.default_memory_pool().release_unused()


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of the words, and the n + 1 bounds of each row's words among them.

    A word is a longest run without space, tab, line feed, vertical tab, form feed and
    carriage return, inside one row.
    """
    inside = WORD_BYTES[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(data))]
    first[borders] = inside[borders]
    last[borders - 1] = inside[borders - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts, np.searchsorted(starts, offsets)


def sums_between(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[i]:bounds[i + 1]]; whole numbers, so exact and order-free."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


#: folders made for applications on one machine that name none
OWN_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share; a fresh local one only where driver and tasks are one process."""
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or context.getConf().get(CHECKPOINT_CONF)
    if folder:
        return folder.rstrip("/")
    if not one_machine(context.master):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    if context.applicationId not in OWN_FOLDERS:
        OWN_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="tidewatch-llm-")
    return OWN_FOLDERS[context.applicationId]


def stored(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write the rows to the shared folder and read them back: cuts lineage, survives lost executors.

    ``batch_rows`` bounds the Arrow batches that Python workers get while the table is written,
    for rows that are wide.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tidewatch-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(BATCH_CONF)
    try:
        if batch_rows:
            spark.conf.set(BATCH_CONF, min(batch_rows, int(before)) if int(before) > 0 else batch_rows)
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(BATCH_CONF, before)
    back = spark.read.schema(df.schema).parquet(path)
    back._tidewatch_path = path
    return back


def dropped(*tables: DataFrame) -> None:
    """Remove tables made by :func:`stored` that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_tidewatch_path", None)
        if path:
            jvm = df.sparkSession.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def cleanup(spark: SparkSession) -> None:
    """Remove all intermediate tables in the shared folder that a job may have left.

    Results that were not written yet read some of them, so call it when results are written and
    no other job uses the folder.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for status in files.globStatus(jvm.org.apache.hadoop.fs.Path(folder, "tidewatch-*-*")) or []:
        files.delete(status.getPath(), True)


#: low bits that hold a row's place in its partition in a number from monotonically_increasing_id
PLACE_BITS = 33
#: a key with more than this share of the rows is a heavy one; there are at most so many
HEAVY = 1000


def numbered_within(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """The rows with their number in their group, from 0, in the order of ``order`` (nulls first).

    Rows are range-partitioned by group and order, with the input's row number as the last tie, so
    no group has to fit into a task.  Only the first group of a partition can have rows in an
    earlier one, so what is carried over has at most a row per partition.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [*group, *order, "__tie"]
    ranged = rows.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(parts, *by).sortWithinPartitions(*by)
    placed = stored(ranged.drop("__tie").withColumn("__place", F.monotonically_increasing_id()), "placed").withColumn("__part", F.shiftright("__place", PLACE_BITS))
    held = placed.groupBy(*group, "__part").agg(F.count("*").alias("__n"))
    earlier = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    spread = held.withColumn("__before", F.sum("__n").over(earlier)).where("__before > 0")
    spread = spread.select(*[F.col(g).alias(f"__c_{g}") for g in group], F.col("__part").alias("__in"), "__before")
    inside = F.row_number().over(Window.partitionBy(*group, "__part").orderBy("__place")) - 1
    on = F.col("__part") == F.col("__in")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"__c_{g}"))
    counted = placed.withColumn("__inside", inside).join(F.broadcast(spread), on, "left")
    return counted.select(*rows.columns, (F.col("__inside") + F.coalesce("__before", F.lit(0))).cast("long").alias(name))


def looked_up(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``rows`` left-joined to a table whose ``key`` is unique; null keys find nothing.

    Keys of more than a thousandth of the rows, of which there are at most a thousand, are looked
    up in a broadcast; their rows are not gathered in one task.  Both inputs are read more than once.
    """
    counts = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__k")).agg(F.count("*").alias("__n"))
    limit = max(rows.count() // HEAVY, 100)
    names = [c for c in table.columns if c != key]
    heavy = table.join(counts.where(F.col("__n") > limit), F.col(key) == F.col("__k"), "left_semi")
    heavy = F.broadcast(heavy.select(F.col(key).alias("__hot"), F.struct(*names).alias("__found")))
    first = rows.join(heavy, F.col(key) == F.col("__hot"), "left")
    at_heavy = first.where("__hot is not null").select(*rows.columns, *[F.col(f"__found.{n}").alias(n) for n in names])
    rest = first.where("__hot is null").select(*rows.columns)
    keyed = rest.where(F.col(key).isNotNull()).join(table, key, "left").select(*rows.columns, *names)
    unkeyed = rest.where(F.col(key).isNull()).select(*rows.columns, *[F.lit(None).cast(table.schema[n].dataType).alias(n) for n in names])
    return at_heavy.union(keyed).union(unkeyed)


def held_out_share(column: str, parts: int) -> F.Column:
    """crc32 of the id as text, modulo ``parts``; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(parts), F.lit(0))


def lowest_share(column: str) -> F.Column:
    """Where the id's hash lies among all hashes, from 0 to 1."""
    return F.xxhash64(column).cast("double") / F.lit(2.0**64) + F.lit(0.5)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
