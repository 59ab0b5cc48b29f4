"""Continuous ingest of chat, polls and weather."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from streamtide import schemas

# fixed values: file roll interval, default lateness (two polls), records of a transaction
ROLL_EVERY = "10 minutes"
LATENESS = "20 minutes"
MAX_RECORDS = 1100
# queries that work off a buffer side by side
LANES = 12


def file_stream(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    fmt: str = "json",
    max_files: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """A stream over landed files.

    ``max_files`` bounds a micro-batch (T7). ``archive`` moves files there once
    their batch is done; an empty folder is simply an empty batch (K7, T8).
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path)


def chat_messages(spark: SparkSession, path: str, **options) -> DataFrame:
    """Raw chat messages; rows without text are dropped."""
    return file_stream(spark, path, schemas.RAW_CHAT_MESSAGE, **options).where("msg is not null")


def write_rolled(
    rows: DataFrame, path: str, checkpoint: str, every: str = ROLL_EVERY, until_done: bool = False,
    max_records: int | None = None,
) -> StreamingQuery:
    """Append to Parquet, one set of files per interval, exactly once.

    ``until_done`` works off what has landed and stops: one scheduled run.
    ``max_records`` bounds the rows of a file.
    """
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if max_records is not None:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer = writer.trigger(availableNow=True) if until_done else writer.trigger(
        processingTime=every
    )
    return writer.outputMode("append").start(path)


def buffered(
    spark: SparkSession, rows: DataFrame, buffer: str, checkpoint: str, max_records: int = MAX_RECORDS, max_files: int = 1
) -> DataFrame:
    """The stream again, in micro-batches of at most ``max_records * max_files`` records.

    A file source can only bound the files of a batch, and landed files have any length. So the
    rows go through a buffer of files of at most ``max_records`` records each: written exactly
    once, as the buffer's own log says, and read by that log, so neither a restart of the one
    query nor of the other repeats or loses a row. Works off what has landed now; the caller
    starts a query on the result, which goes on where it stopped.
    """
    write_rolled(rows, buffer, checkpoint, until_done=True, max_records=max_records).awaitTermination()
    return file_stream(spark, buffer, rows.schema, fmt="parquet", max_files=max_files)


def buffered_lanes(
    spark: SparkSession, rows: DataFrame, buffer: str, checkpoint: str, max_records: int = MAX_RECORDS, max_files: int = 1,
    lanes: int = LANES,
) -> list[DataFrame]:
    """The stream again as ``lanes`` streams, each in micro-batches as those of ``buffered``.

    A bounded micro-batch takes its time however few records it has, so one query after another
    is as slow as the number of batches; queries on the lanes run side by side, each with a
    checkpoint of its own. Every ``max_records`` rows the next lane has its turn. A micro-batch
    of the buffer that is run again replaces its own folder, before any lane is read.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        turn = F.floor(F.monotonically_increasing_id() / max_records) + F.spark_partition_id()
        dealt = batch.withColumn("lane__", F.pmod(turn, F.lit(lanes)))
        writer = dealt.write.option("maxRecordsPerFile", max_records).partitionBy("lane__").mode("overwrite")
        writer.parquet(f"{buffer}/batch={batch_id}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return [
        file_stream(spark, f"{buffer}/batch=*/lane__={k}", rows.schema, fmt="parquet", max_files=max_files) for k in range(lanes)]


def work_off(writers: list[DataStreamWriter]) -> None:
    """Runs the queries side by side until each has worked off what has landed. If one fails,
    the others are stopped; every query goes on where it was when it is started again."""
    queries = []
    try:
        for writer in writers:
            queries.append(writer.trigger(availableNow=True).start())
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()
