"""Incremental bronze loading: only files that were not loaded before, and only keys that were not loaded before.

The typed scan and lineage columns of the batch loader, as a file stream that processes what
is available and stops.  A full reload stays the default way to load (see ``medallion``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.schemas import TableSpec
from starmart.sources.delimited import CORRUPT
from starmart.sources.scratch import dropped_shuffles

KEPT_BATCHES = "spark.sql.streaming.numRecentProgressUpdates"
EVENT_TIME = "_event_time"
# Keys of ``load_distinct`` are kept on the executors' disks and a batch writes its own changes only; by default each batch
# copies all keys of all earlier ones in memory.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
MOST_BATCHES = 100_000  # of one load; their progress is a few hundred bytes each


def stream_csv(spark: SparkSession, folder: str, spec: TableSpec, files_per_batch: int | None = None) -> DataFrame:
    schema = T.StructType(spec.raw_schema.fields).add(CORRUPT, "string")
    reader = spark.readStream.option("header", True).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        reader.option("columnNameOfCorruptRecord", CORRUPT).schema(schema).csv(folder)
        .select(
            "*",
            F.col("_metadata.file_path").alias("_source_file"),
            F.current_timestamp().alias("_ingestion_ts"),
            F.lit(spec.name).alias("_file_name"),
        )
    )


def load_new_files(spark: SparkSession, folder: str, spec: TableSpec, target: str, checkpoint: str,
                   files_per_batch: int | None = None) -> int:
    """Append rows of new files below ``folder`` to the parquet folder ``target``; return the
    rows added.  The checkpoint remembers the files, so a rerun adds nothing twice.  A row that does not parse keeps its
    text, as in the batch scan.  ``files_per_batch`` cuts a large backlog into micro-batches."""
    before = spark.conf.get(KEPT_BATCHES)
    spark.conf.set(KEPT_BATCHES, str(MOST_BATCHES))
    try:
        query = (
            stream_csv(spark, folder, spec, files_per_batch).writeStream.format("parquet").option("path", target)
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        progress = query.recentProgress
    finally:
        spark.conf.set(KEPT_BATCHES, before)
    if len(progress) >= MOST_BATCHES:
        raise RuntimeError("more micro-batches than are counted; load more files in each")
    return sum(p["numInputRows"] for p in progress)


def load_distinct(spark: SparkSession, folder: str, spec: TableSpec, target: str, checkpoint: str, delay: str = "1 day",
                  event_time: Column | None = None, files_per_batch: int | None = None) -> None:
    """Add the rows of new files below ``folder`` to ``target``, the first of each key only.

    Keys are remembered until the watermark, ``delay`` behind the latest ``event_time`` (by default when a row came in), has
    passed them, so state stays bounded; a repeat that comes later than that is a row of its own.  Each micro-batch is a
    folder named by its number and replaces what an earlier try of the same batch left, so a run that dies while
    writing leaves no row twice and none out.
    """
    rows = stream_csv(spark, folder, spec, files_per_batch).withColumn(
        EVENT_TIME, F.col("_ingestion_ts") if event_time is None else event_time
    ).withWatermark(EVENT_TIME, delay).dropDuplicatesWithinWatermark([spec.pk]).drop(EVENT_TIME)

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    try:
        for k, v in STATE_STORE.items():
            spark.conf.set(k, v)
        with dropped_shuffles(spark):
            query = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
            query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored_batches(spark: SparkSession, target: str) -> DataFrame:
    """All rows that ``load_distinct`` stored."""
    return spark.read.option("basePath", target).parquet(target).drop("batch")
