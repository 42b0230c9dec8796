"""Optional streaming ingest: files of holdings are upserted into a history, the last loaded row of a key staying."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import keep_last
from ..schema import HOLDINGS, KEY


def stream_history(spark: SparkSession, source: str, target: str, checkpoint: str, *, max_files: int | None = None) -> None:
    """Takes in the new CSV files of source and appends them, with a load sequence, to target. A batch that is run again replaces itself."""
    reader = spark.readStream.schema(HOLDINGS).option("header", True)
    reader = reader.option("maxFilesPerTrigger", max_files) if max_files else reader

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("load_seq", F.monotonically_increasing_id()).write.mode("overwrite").parquet(f"{target}/load={batch_id}")

    reader.csv(source).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(save).start().awaitTermination()


def read_history(spark: SparkSession, target: str) -> DataFrame:
    """The history with the last loaded row of each key."""
    rows = spark.read.option("basePath", target).parquet(target)
    return keep_last(rows.withColumn("at", F.struct("load", "load_seq")), list(KEY), "at").drop("at", "load", "load_seq")
