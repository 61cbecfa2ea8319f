"""Incremental monthly load as a file-source stream.

New month folders dropped into the landing area are picked up by a file
stream source (the stream's checkpoint remembers which files were seen, so
it is the high-water mark).  A micro-batch only records the files it saw,
with their months and rows, as the partition of its epoch in a small table
inside the checkpoint.  ``publish`` then reads all landing files of the months
recorded since the last publication and replaces those months in the raw
table (dynamic partition overwrite).  So a month may arrive in several files,
batches and runs, no row is lost, and a month is rewritten once a run, however
many files and batches brought it.  A re-played batch replaces its own records,
a repeated publication writes the same months with the same rows, and what a
crash left unpublished is published by the next run.  Run it with the
``availableNow`` trigger for the monthly schedule (process what has
arrived, publish once, stop) or with a processing-time trigger to follow the
landing area continuously (published after every batch).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costindex.sources.loader import PARTITION_COL, folder_values, without_nan
from costindex.sources.meta import RunBook

LANDED = T.StructType([
    T.StructField(PARTITION_COL, T.StringType()),
    T.StructField("file", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("epoch", T.LongType()),
])


def landing_stream(spark: SparkSession, landing_dir: str, schema: T.StructType,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream over ``landing_dir/_month_partition=YYYY-MM/*.parquet``.

    ``schema`` must include the ``_month_partition`` column; its value comes
    from the folder name.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(landing_dir)


def _landed(checkpoint_dir: str) -> str:
    """Files seen per epoch; inside the checkpoint, so that a new checkpoint starts without records."""
    return f"{checkpoint_dir.rstrip('/')}/months/landed"


def _published(checkpoint_dir: str) -> str:
    """The last published epoch, one row a version."""
    return f"{checkpoint_dir.rstrip('/')}/months/published"


def publish(book: RunBook, source_name: str, landing_dir: str, schema: T.StructType, checkpoint_dir: str,
            at: datetime) -> list[str]:
    """Replace every month that has files recorded since the last publication; returns those months."""
    wh, spark = book.wh, book.spark
    if not folder_values(wh, _landed(checkpoint_dir), "epoch"):
        return []
    marker = _published(checkpoint_dir)
    done = wh.read_at(marker).first()[0] if wh.has_table_at(marker) else -1
    # folder names prune the epochs; a row per month with new files comes back
    dirty = spark.read.schema(LANDED).parquet(_landed(checkpoint_dir)).where(F.col("epoch") > done).groupBy(PARTITION_COL) \
        .agg(F.max("epoch").alias("epoch")).orderBy(PARTITION_COL).collect()
    if not dirty:
        return []
    months, epoch = [r[0] for r in dirty], max(r[1] for r in dirty)
    whole = spark.read.schema(schema).option("basePath", landing_dir).parquet(
        *[f"{landing_dir.rstrip('/')}/{PARTITION_COL}={m}" for m in months])
    wh.replace_partitions("raw", source_name, without_nan(whole), PARTITION_COL)
    table = wh.read_partitioned("raw", source_name)
    total = table.count()  # from parquet footers
    new_rows = table.where(F.col(PARTITION_COL).isin(months)).count()
    wm = book.watermark(source_name)
    last = max([months[-1]] + ([wm.last_max_date] if wm and wm.last_max_date else []))
    with book.batch():
        book.upsert_watermark(source_name, at, total, last)
        # publications of one run share its time
        book.log_run(f"{source_name}/{epoch}", at, "success", rows_loaded=total, new_rows=new_rows,
                     notes=f"batches {done + 1}..{epoch}: {months[0]}..{months[-1]}")
    wh.write_at(marker, spark.range(1).select(F.lit(epoch).cast("long").alias("epoch")))
    return months


def run_incremental_stream(book: RunBook, source_name: str, landing_dir: str, schema: T.StructType,
                           checkpoint_dir: str, at: datetime, available_now: bool = True,
                           max_files_per_trigger: int | None = None):
    """Start the load; returns the streaming query (already finished and published with availableNow)."""
    stream = landing_stream(book.spark, landing_dir, schema, max_files_per_trigger)
    seen = stream.select(PARTITION_COL, F.col("_metadata.file_path").alias("file"))

    def record(batch: DataFrame, epoch_id: int) -> None:
        # no data column is read: months and paths come from the file list, rows from the footers
        rows = batch.groupBy(PARTITION_COL, "file").agg(F.count(F.lit(1)).alias("rows"))
        (rows.withColumn("epoch", F.lit(epoch_id).cast("long")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(_landed(checkpoint_dir)))
        if not available_now:
            publish(book, source_name, landing_dir, schema, checkpoint_dir, at)

    writer = seen.writeStream.foreachBatch(record).option(
        "checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    q = writer.start()
    if available_now:
        q.awaitTermination()
        publish(book, source_name, landing_dir, schema, checkpoint_dir, at)
    return q
