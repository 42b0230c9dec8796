"""What the operators of this subpackage share: tables, the shared folder and written steps."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import shared
from ..shared import drop_path, new_path

__all__ = ["drop_path", "give_back", "near", "new_path", "numbered", "release", "slices", "small_batches", "table", "written"]

#: Rows of a few numbers or digests that may be broadcast; larger tables are joined by a shuffle.
BROADCAST_ROWS = 500_000


#: Rows of an Arrow batch of texts: a batch is held on both sides of the pipe to Python, and texts may be long.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"


def small_batches(spark: SparkSession) -> None:
    """From here on the session's Arrow batches have few rows, unless it has set their size itself. The setting is read when a plan runs, so it stays."""
    key, default, few = BATCH_ROWS
    if spark.conf.get(key, default) == default:
        spark.conf.set(key, few)


def release() -> None:
    """Gives memory that a worker no longer uses back to the system: the worker lives on and serves other tasks."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def give_back(spark: SparkSession) -> bool:
    """The driver's JVM gives memory that it no longer uses back to the system, as release() does for Python.

    Every plan's code is compiled in the driver, in memory of the C library that stays with the process when it is free again. The
    heap is collected only once more than half of what it may have is taken: a full collection makes it smaller. Whether the JVM could.
    """
    jvm, new = spark.sparkContext._jvm, spark.sparkContext._gateway.new_array
    runtime = jvm.java.lang.Runtime.getRuntime()
    if runtime.totalMemory() * 2 > runtime.maxMemory():
        jvm.java.lang.System.gc()
    with suppress(Py4JError):  # another JVM or C library may not have the command
        # by the interface's method: Py4J doesn't see those of the server's own class
        kinds, values = new(jvm.Class, 4), new(jvm.Object, 4)
        kinds[0], kinds[1], kinds[2], kinds[3] = (jvm.Class.forName(c) for c in ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;"))
        values[0], values[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        return bool(jvm.Class.forName("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(server, values))
    return False


def written(df: DataFrame, name: str, *, sort: list[str] | None = None) -> DataFrame:
    """shared.written(), after which the driver gives memory back: an operator may take a hundred such steps in one session."""
    out = shared.written(df, name, sort=sort)
    give_back(df.sparkSession)
    return out


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches' rows in slices of about `most` bytes of a string or binary column; a longer row is in a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // most, prepend=-1)).tolist()
        for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(a, b - a)
    release()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def near(df: DataFrame, rows: int) -> DataFrame:
    """df, broadcast where its number of rows, that has been counted, is small: what stands on the other side then stays where it is."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def drop_written(df: DataFrame) -> None:
    """Deletes a table that written() made, once nothing reads it any more."""
    files = df.inputFiles()
    if files:
        drop_path(df.sparkSession, files[0].rsplit("/", 1)[0])


def empty_if_null(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """df with a column of gapless numbers from 0 within each key, in the given order; no key is gathered in one task.

    Rows are dealt out by ranges of (key, order) and written; only the counts of (part, key) are summed up over parts.
    """
    parts = written(
        df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
        .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at")),
        "numbered",
    )
    from pyspark.sql import Window

    counts = parts.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", *keys, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return parts.join(starts, ["_part", *keys]).withColumn(name, F.col("_before") + F.col("_at") - F.col("_first")).drop(
        "_part", "_at", "_first", "_before"
    )
