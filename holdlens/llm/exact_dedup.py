"""Exact deduplication over a stream, with keyed state on disk.

The state has one row per digest and never expires: digest, the stable identifier that stays
(the smallest), a content locator (file and row) and the group's size. It lives in RocksDB state
stores whose change files are in the shared checkpoint folder, so a lost executor's part is read
again from there. A digest seen before is only a *hit*: the hit's full normalised text is compared with
the text at the state's locator; rows that differ in spite of an equal digest are grouped by text.

Main path: DataFrame and Structured Streaming functions only.

Defined results
- null text counts as the empty text; texts are equal when identical after each run of
  [\\x20\\x09-\\x0D] became one space (no trimming).
- ties: among rows of one text the smallest identifier stays; a null identifier comes after all others;
  of repeated rows with that identifier exactly one is kept.
- empty input: no rows. Further columns, whatever their names, are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..shared import exists
from .common import drop_path, drop_written, near, new_path, written

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Settings while the stream runs: state on disk, in bounded native memory, saved as change logs.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "4",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}
#: A locator, which has a path, counts as so many rows of a few numbers.
WIDE = 8
#: Rows of a hot group that one task compares with the text that stays.
ROWS_PER_SALT = 256


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def located(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, file, row) with the content locator of each row; writes docs first if it doesn't come from files."""

    def rows(df: DataFrame) -> DataFrame:
        return df.select(
            F.col(id_col).cast("long").alias("id"),
            F.col(text_col).cast("string").alias("text"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("row"),
        )

    try:
        return rows(docs)
    except AnalysisException:
        return rows(written(docs.select(id_col, text_col), "dedup-input"))


def stateful_stream(records: DataFrame, checkpoint: str, out: str) -> None:
    """Folds a stream of (digest, id, file, row) into the keyed state; each micro-batch's changed keys go to out.

    Running it again with the same checkpoint takes in only new files: the state is kept for ever.
    """
    spark = records.sparkSession
    state = records.groupBy("digest").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "file", "row")).alias("stays"),
        F.count(F.lit(1)).alias("group_size"),
    )

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        query = (
            state.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).foreachBatch(save).start()
        )
        query.awaitTermination()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def read_state(spark: SparkSession, out: str) -> DataFrame:
    """The state's last row of each digest: the identifiers only fall and the sizes only grow."""
    schema = "digest binary, stays struct<none: boolean, id: bigint, file: string, `row`: bigint>, group_size bigint, batch int"
    return (
        spark.read.schema(schema).parquet(out)
        .groupBy("digest").agg(F.min("stays").alias("stays"), F.max("group_size").alias("group_size"))
    )


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_files_per_trigger: int | None = None) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256 (and file, row: its locator)."""
    spark = docs.sparkSession
    source = located(docs, id_col, text_col)
    found = source.select(F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"), "id", "file", "row")
    folder = new_path(spark, "dedup-digests")
    found.write.parquet(folder)
    digests = spark.read.schema(found.schema).parquet(folder)
    reader = spark.readStream.schema(found.schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    checkpoint, out = new_path(spark, "dedup-state"), new_path(spark, "dedup-changes")
    stateful_stream(reader.parquet(folder), checkpoint, out)
    if exists(spark, out):
        state = read_state(spark, out)
    else:  # no file had a row
        state = digests.groupBy("digest").agg(
            F.min(F.struct(F.col("id").isNull().alias("none"), "id", "file", "row")).alias("stays"), F.count(F.lit(1)).alias("group_size")
        )
    # written apart, so that a digest of very many rows can be split between tasks of the join
    state = written(state, "dedup-groups")
    rows = written(digests.join(state, "digest"), "dedup-rows")
    drop_path(spark, checkpoint)
    drop_path(spark, out)
    drop_path(spark, folder)
    drop_written(state)

    # hits: groups of more than one row; full texts are fetched by locator and compared
    stays = (F.col("file") == F.col("stays.file")) & (F.col("row") == F.col("stays.row"))
    hits = rows.filter("group_size > 1").select(
        "digest", "file", "row", stays.alias("is_kept"), F.ceil(F.col("group_size") / ROWS_PER_SALT).alias("salts")
    )
    # few hits are sent to where the texts are read
    texts = source.join(near(hits, WIDE * hits.count()), ["file", "row"]).select("digest", "id", "file", "row", "is_kept", "salts", normalised(F.col("text")).alias("norm"))
    texts = written(texts, "dedup-hits")
    first = texts.filter("is_kept").select("digest", F.explode(F.sequence(F.lit(0), (F.col("salts") - 1).cast("int"))).alias("salt"), F.col("norm").alias("first"))
    rest = texts.filter("not is_kept").withColumn("salt", F.pmod(F.xxhash64("file", "row"), F.col("salts")).cast("int"))
    other = written(rest.join(first, ["digest", "salt"]).filter("norm != first").select("digest", "id", "file", "row", "norm"), "dedup-other")

    # an equal digest with another text: such rows form groups by their text
    by_text = other.groupBy("digest", "norm").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "file", "row")).alias("own_stays"), F.count(F.lit(1)).alias("own_size")
    )
    own = other.join(by_text, ["digest", "norm"]).select("file", "row", "own_stays", "own_size")
    fewer = other.groupBy("digest").agg(F.count(F.lit(1)).alias("others"))
    result = (
        rows.join(own, ["file", "row"], "left").join(F.broadcast(fewer) if other.isEmpty() else fewer, "digest", "left")
        .withColumn("keeper", F.coalesce("own_stays", "stays"))
        .withColumn("size", F.coalesce("own_size", F.col("group_size") - F.coalesce("others", F.lit(0))))
    )
    return result.select(
        F.col("id").alias("doc_id"),
        F.col("keeper.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        ((F.col("file") == F.col("keeper.file")) & (F.col("row") == F.col("keeper.row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "file",
        "row",
    )


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with all their columns. docs comes from files."""
    gone = written(exact_dedup(docs, id_col=id_col, text_col=text_col).filter("NOT kept").select("file", "row"), "dedup-gone")
    names = docs.columns
    file, row = (next(n for n in (f"{'_' * i}{name}" for i in range(99)) if n not in names) for name in ("kept_file", "kept_row"))
    here = docs.select(*[F.col(f"`{c}`") for c in names], F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))
    places = near(gone.select(F.col("file").alias(file), F.col("row").alias(row)), WIDE * gone.count())
    return here.join(places, [file, row], "left_anti").drop(file, row)
