"""Device readings as a stream: Bronze ingest and incremental Silver."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strandline.operators.clean import clean, typed
from strandline.schemas import Table
from strandline.session import child_folders, delete_path, keep, move_path, path_exists, settings
from strandline.sources.zones import csv_read, write_csv

# Partition columns of the streamed Silver files, and a row's hashes, beside the columns of the table.
DAY, QUERY, BATCH = "stream_day", "stream_query", "stream_batch"
HASHES = ("stream_hash_1", "stream_hash_2")
NO_DAY_PARTS = 64  # rows without an event time are dealt over so many partitions


def arriving(
    spark: SparkSession, path: str, table: Table, files_per_batch: int | None = None
) -> DataFrame:
    """New CSV files of a folder and the folders below it, as text columns."""
    reader = spark.readStream.options(**csv_read(table.multiline))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.schema(table.bronze_schema).csv(path)


def query_id(spark: SparkSession) -> str:
    """The id of the stream whose batch is running; a new checkpoint has a new one."""
    own = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if own is None:
        raise ValueError("no stream runs in this thread")
    return own


def ingest(stream: DataFrame, bronze: str, checkpoint: str, multiline: bool = False) -> StreamingQuery:
    """Append what has arrived to the Bronze table in folder ``bronze``, then stop.

    Nothing is cast or dropped here: Bronze keeps the text as it came. Each batch
    has a folder of its own, named after the stream and the batch, beside the files
    that were loaded in bulk. A batch that runs again replaces its folder, and no
    stream touches the folders of another. A stream that lost its checkpoint brings
    all its files once more; Silver drops the copies.
    """

    def append(batch: DataFrame, number: int) -> None:
        own = query_id(batch.sparkSession)
        write_csv(batch, f"{bronze}/batch-{own}-{number:010d}", multiline)

    return (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def silver_exact(stream: DataFrame, table: Table, silver: str, checkpoint: str) -> StreamingQuery:
    """Clean what has arrived and append the rows Silver does not hold yet.

    The result is that of the batch job on the same rows, however late a copy
    comes. Equal rows have an equal event time, so a batch is compared only with
    the days it touches: the join on the day prunes the stored partitions when it
    runs. Rows are compared by two 64-bit hashes that are stored with them, so no other
    column of a day is read. There is no state that grows with the stream.

    Files are written per day, stream and batch. A batch that runs again is compared
    with all but its own files and replaces these. Several streams may feed one table at
    the same time: batches that do not see each other may both write a row, and reading
    and compaction keep one of the copies.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        own = query_id(spark)
        fresh = rows = _with_hashes(_with_day(clean(batch, table), table), table)
        if path_exists(spark, silver):
            # the files are parsed again for the days, without dedupe: storing the batch costs more
            days = _with_day(typed(batch, table), table).select(DAY).where(F.col(DAY) > "").distinct()
            stored = _stored(spark, table, silver).join(days, DAY, "left_semi")
            stored = stored.where((F.col(QUERY) != own) | (F.col(BATCH) != number)).select(DAY, *HASHES)
            fresh = rows.join(stored, [DAY, *HASHES], "left_anti")
        (
            fresh.withColumns({QUERY: F.lit(own), BATCH: F.lit(number).cast("long")})
            .hint("rebalance", F.col(DAY))  # few files per day, none too large
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DAY, QUERY, BATCH)
            .parquet(silver)
        )

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def silver_files(spark: SparkSession, silver: str) -> DataFrame:
    """The files of a streamed Silver table: day, stream, path. Only the folders are read."""
    listing = {"recursiveFileLookup": "true", "pathGlobFilter": "*.parquet"}
    files = spark.read.format("binaryFile").options(**listing).load(silver).select("path")
    # a task per core lists its share, whatever the files' sizes
    files = files.coalesce(spark.sparkContext.defaultParallelism)

    def folder(name: str):
        return F.regexp_extract("path", f"/{name}=([^/]*)/", 1).alias(name)

    return files.select(folder(DAY), folder(QUERY), "path")


def read_silver_stream(spark: SparkSession, table: Table, silver: str) -> DataFrame:
    """Silver rows written by ``silver_exact``, in the table's columns, each once."""
    return day_rows(spark, table, silver).select(*table.silver_schema.names)


def streams_per_day(files: DataFrame) -> DataFrame:
    return files.groupBy(DAY).agg(F.countDistinct(QUERY).alias("streams"))


def day_rows(
    spark: SparkSession,
    table: Table,
    silver: str,
    days: Sequence[str] | None = None,
    shared: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of a streamed Silver table, or of some days of it, with the column of the day.

    The batches of one stream follow one another and see what is stored, so copies can
    only be in days that several streams wrote to, the ``shared`` ones. Only these are
    deduplicated.
    """
    stored = _stored(spark, table, silver)
    if days is not None:
        stored = stored.where(F.col(DAY).isin(list(days)))
    if shared is None:
        # days, of which the table has a partition each
        several = streams_per_day(silver_files(spark, silver)).where("streams > 1")
        shared = [r[DAY] for r in several.select(DAY).collect()]
    columns = [*table.silver_schema.names, DAY]
    if not shared:
        return stored.select(*columns)
    inside = F.col(DAY).isin(list(shared))
    once = stored.where(inside).dropDuplicates([DAY, *HASHES])
    return stored.where(~inside).select(*columns).unionByName(once.select(*columns))


def compact_silver(spark: SparkSession, table: Table, silver: str) -> int:
    """Merge the files of days that several batches wrote, one copy of each row; gives the number of days.

    No stream may write to the table meanwhile. The merged days are written beside the
    table first; only then their old folders go and the new ones take their place. A run
    that was interrupted in between is finished by the next one. A batch that runs again
    later finds its rows in the merged files and adds none.
    """
    staging = f"{silver}-merged"
    if not path_exists(spark, f"{staging}/_SUCCESS"):
        if not path_exists(spark, silver):
            return 0
        stored = _stored(spark, table, silver)
        # reads no column of the table
        parts = stored.select(DAY, QUERY, BATCH).distinct()
        days = keep(parts.groupBy(DAY).count().where("count > 1").select(DAY), "days")
        merged = stored.join(days, DAY, "left_semi").dropDuplicates([DAY, *HASHES]).withColumns(
            {QUERY: F.lit(f"merged-{uuid.uuid4().hex}"), BATCH: F.lit(0).cast("long")}
        )
        merged.hint("rebalance", F.col(DAY)).write.mode("overwrite").partitionBy(DAY, QUERY, BATCH).parquet(staging)
    days = child_folders(spark, staging)
    for day in days:
        new = child_folders(spark, f"{staging}/{day}")
        # a day without a new folder has taken its place before the run was interrupted
        for old in child_folders(spark, f"{silver}/{day}") if new else []:
            if old not in new:
                delete_path(spark, f"{silver}/{day}/{old}")
        for name in new:
            if not path_exists(spark, f"{silver}/{day}/{name}"):
                move_path(spark, f"{staging}/{day}/{name}", f"{silver}/{day}/{name}")
    delete_path(spark, staging)
    return len(days)


#: State on the executors' disks, so that its size is not bound by their memory.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


def silver_bounded(stream: DataFrame, table: Table, delay: str) -> DataFrame:
    """Clean a stream with bounded state: copies within ``delay`` are removed.

    Unlike ``silver_exact`` and the batch job, it drops rows that arrive later
    than the watermark, and copies further apart than ``delay`` both remain, as do
    copies without an event time that come in different batches. Use it where the
    sources keep that bound and latency matters.
    """
    rows = typed(stream, table).withWatermark(table.time, delay)
    return rows.dropDuplicatesWithinWatermark(table.silver_schema.names)


def append_bounded(stream: DataFrame, table: Table, silver: str, checkpoint: str, delay: str) -> StreamingQuery:
    """Append ``silver_bounded`` of what has arrived to the Parquet table ``silver``, then stop.

    Started again with its checkpoint it goes on where it stopped, with the rows it has
    seen and the watermark it had. The sink lists the files of finished batches, so a batch
    that runs again adds none twice; read the table with Spark, which follows the list.
    """
    rows = silver_bounded(stream, table, delay)
    with settings(stream.sparkSession, ROCKSDB):
        return (
            rows.writeStream.format("parquet")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(silver)
        )


def _with_day(rows: DataFrame, table: Table) -> DataFrame:
    """Partition by the day of the event time; rows without one are dealt by a hash of all they hold."""
    part = F.pmod(F.xxhash64(*table.silver_schema.names), F.lit(NO_DAY_PARTS))
    day = F.coalesce(F.date_format(table.time, "yyyy-MM-dd"), F.format_string("none-%02d", part))
    return rows.withColumn(DAY, day)


def _with_hashes(rows: DataFrame, table: Table) -> DataFrame:
    """Two 64-bit hashes of a row's columns; which of them are null counts as well."""
    names = table.silver_schema.names
    nulls = [F.col(c).isNull() for c in names]
    return rows.withColumns({h: F.xxhash64(F.lit(h), *names, *nulls) for h in HASHES})


def _stored(spark: SparkSession, table: Table, silver: str) -> DataFrame:
    layout = T.StructType(
        [
            *table.silver_schema.fields,
            *[T.StructField(h, T.LongType()) for h in HASHES],
            T.StructField(DAY, T.StringType()),
            T.StructField(QUERY, T.StringType()),
            T.StructField(BATCH, T.LongType()),
        ]
    )
    return spark.read.schema(layout).parquet(silver)
