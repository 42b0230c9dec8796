"""Sinks: Parquet, JSON documents, idempotent appends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import shared
from ..operators.ingest import keep_last, new_only


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; nulls are written, not left out."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_document(df: DataFrame, path: str) -> None:
    """Each row as one JSON text."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def append_new(df: DataFrame, path: str, keys: list[str]) -> None:
    """Appends the rows whose keys the table at path doesn't have: running it twice changes nothing."""
    spark = df.sparkSession
    there = shared.exists(spark, path)
    (new_only(df, spark.read.schema(df.schema).parquet(path), keys) if there else df).write.mode("append").parquet(path)


def archive_day(df: DataFrame, root: str, day: str, *, backup: DataFrame | None = None) -> None:
    """A day's load: latest/ by fund (funds that are loaded are replaced), history/ and backups/ by day (the day is replaced)."""
    funds = lambda rows: rows.repartition("ETF_Ticker").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ETF_Ticker")
    funds(df).parquet(f"{root}/latest")
    for name, rows in (("history", df), ("backups", backup)):
        if rows is not None:
            rows.withColumn("loaded", F.lit(day).cast("date")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("loaded").parquet(f"{root}/{name}")


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old and new together, the row of new staying where keys meet."""
    both = old.withColumn("load_seq", F.lit(0)).unionByName(new.withColumn("load_seq", F.lit(1)))
    return keep_last(both, keys, "load_seq").drop("load_seq")
