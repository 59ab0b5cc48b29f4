"""Delimited and plain text, and the older sequence files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamtide import schemas
from streamtide.functions import text, times


def _options(sep: str, recursive: bool) -> dict:
    return {"sep": sep, "quote": "", "escape": "", "recursiveFileLookup": recursive}


def _delimited(spark: SparkSession, path, schema: str, sep: str, recursive: bool) -> DataFrame:
    return spark.read.schema(schema).options(**_options(sep, recursive)).csv(path)


def stream_sample_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """The same polls as a stream: each landed file is read once."""
    reader = spark.readStream.schema(schemas.STREAM_SAMPLE).options(**_options(";", True), **options)
    return reader.csv(path)


def read_stream_samples(spark: SparkSession, path, recursive: bool = False) -> DataFrame:
    """Polls as ``;`` text, nine typed columns (S2, with ``recursive`` S14).

    Missing trailing fields and values of the wrong type are null, extra fields
    are ignored, quotes are ordinary characters. ``path`` may be a list (E2).
    """
    return _delimited(spark, path, schemas.STREAM_SAMPLE, ";", recursive)


def checked_samples(spark: SparkSession, path, recursive: bool = False) -> DataFrame:
    """The same lines with the file each is from and, if it is malformed, the line itself.

    Malformed are lines with fewer or more fields than declared, or with a value that is not of
    its column's type; ``read_stream_samples`` reads these as far as it can. One parse of a stored
    result gives both ``good_lines`` and ``delimited_quarantine``.
    """
    rows = _delimited(spark, path, f"{schemas.STREAM_SAMPLE}, _corrupt_record string", ";", recursive)
    return rows.withColumn("file", F.col("_metadata.file_path"))


def good_lines(checked: DataFrame) -> DataFrame:
    return checked.where("_corrupt_record is null").drop("_corrupt_record", "file")


def delimited_quarantine(checked: DataFrame) -> DataFrame:
    """file, line: every malformed line as it landed."""
    return checked.where("_corrupt_record is not null").select("file", F.col("_corrupt_record").alias("line"))


def read_sessions(spark: SparkSession, path, recursive: bool = False) -> DataFrame:
    """Session rows as tab text, start time parsed."""
    rows = _delimited(spark, path, schemas.SESSION, "\t", recursive)
    return rows.withColumn("starttime", times.parse_iso(F.col("starttime")))


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Untyped text of files, folders or globs."""
    return spark.read.text(path)


def read_training_lines(spark: SparkSession, path) -> DataFrame:
    """Training rows stored as ``id,text,target`` lines."""
    return parse_training_lines(read_lines(spark, path))


def parse_training_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Typed training rows; lines with fewer than three fields are dropped (P10)."""
    row_id, body, target = text.fields(F.col(column), ",", 3)
    return lines.select(
        row_id.try_cast("long").alias("id"),
        body.alias("text"),
        target.try_cast("double").alias("target"),
    ).dropna()


def read_places(spark: SparkSession, path) -> DataFrame:
    """One place per line."""
    return (
        spark.read.text(path)
        .select(F.trim("value").alias("place"))
        .where(F.col("place") != "")
    )


def read_sequence_chat(spark: SparkSession, path: str) -> DataFrame:
    """Older chat files: sequence files of epoch ms and ``channel,msg,code``.

    The Hadoop input format is only reachable through the RDD reader, so this
    needs a classic session. New data should land as JSON or Parquet.
    """
    rows = spark.sparkContext.sequenceFile(path)
    return parse_chat_values(spark.createDataFrame(rows, "key long, value string", verifySchema=False))


def parse_chat_values(rows: DataFrame) -> DataFrame:
    """``key, value`` to typed chat rows."""
    channel, msg, code = text.fields(F.col("value"), ",", 3)
    return rows.select(
        times.from_epoch_ms(F.col("key")).alias("ts"),
        channel.alias("channel"),
        msg.alias("msg"),
        code.try_cast("int").alias("sentiment"),
    )


def chat_value() -> Column:
    """Typed chat columns back to the ``channel,msg,code`` text."""
    return F.concat_ws(
        ",",
        text.channel_name(F.col("channel")),
        text.message_text(F.col("msg")),
        F.col("sentiment").cast("string"),
    )
