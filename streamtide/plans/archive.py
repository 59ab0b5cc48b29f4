"""Compaction of processed input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from streamtide.sources import files


def archive_text(spark: SparkSession, source, target: str, parts: int | None = None) -> None:
    """Many small text files as one bzip2 data set.

    Spark packs small files into read partitions of
    ``spark.sql.files.maxPartitionBytes``; each becomes one output file, there
    is no shuffle. ``parts`` lowers the number of files further. The write
    fails if the target exists; the input is left to ``cleanSource`` or to the
    caller, after the write has been committed.
    """
    _write(files.read_lines(spark, source), target, parts)


def archive_rows(rows: DataFrame, target: str, sep: str = "\t", parts: int | None = None) -> None:
    """Typed rows, for example older binary chat files, as bzip2 text."""
    rows = rows if parts is None else rows.coalesce(parts)
    rows.write.option("sep", sep).option("compression", "bzip2").csv(target)


def _write(lines: DataFrame, target: str, parts: int | None) -> None:
    lines = lines if parts is None else lines.coalesce(parts)
    lines.write.option("compression", "bzip2").text(target)
