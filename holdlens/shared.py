"""Steps written to the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def root(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a local session (tests, a notebook) gets a folder of its own and a cluster an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = _own.setdefault("dir", f"file://{tempfile.mkdtemp(prefix='holdlens-')}")
        spark.sparkContext.setCheckpointDir(found)
    return f"{found.rstrip('/')}/holdlens"


def new_path(spark: SparkSession, name: str) -> str:
    """A path that isn't taken, below a folder of this application that goes when Python ends."""
    folder = f"{root(spark)}/{spark.sparkContext.applicationId}"
    if folder not in _own:
        _own[folder] = ""
        atexit.register(_drop_quietly, spark, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *, sort: list[str] | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    path = new_path(df.sparkSession, name)
    (df.sortWithinPartitions(*sort) if sort else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def drop_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _drop_quietly(spark: SparkSession, path: str) -> None:
    with suppress(Exception):  # the session may have ended
        drop_path(spark, path)
