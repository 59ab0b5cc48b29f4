"""Table writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Rows that one group of a Parquet file holds are skipped or read together.
ROW_GROUP_BYTES = 16 * 1024 * 1024


def write_stream_day(rows: DataFrame, path: str, run: str, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """A run of the wide table, below ``run=<stamp>`` by day, clustered by stream.

    Rows are dealt by ranges of day, name and part and sorted, so a stream's rows of a day lie
    together: in one file, or in neighbours if they are many. Footers have the least and the
    greatest name of each row group and a Bloom filter over its names; a read of one stream
    opens the groups that have it and skips the others. Writing the run again replaces all of it,
    days that it no longer has included; other runs stay.
    """
    order = [c for c in ("day", "name", "part") if c in rows.columns]
    (
        rows.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("day")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.bloom.filter.enabled#name", "true")
        .mode("overwrite")
        .parquet(f"{path}/run={run}")
    )


def append_weather(obs: DataFrame, path: str, batch: str) -> None:
    """Observations to the log behind the upsert, by day of the hour (K2).

    Readers resolve the latest. A batch that is written again replaces its own
    folders.
    """
    day = F.to_date(F.substring("hour_key", 1, 8), "yyyyMMdd")
    replace_partitions(obs.withColumns({"day": day, "batch": F.lit(batch)}), path, "day", "batch")


def write_run(rows: DataFrame, path: str, run: str, *keys: str) -> None:
    """The rows of one run below ``run=<stamp>``, in folders by ``keys`` if any, in place of what
    it wrote before (K3)."""
    rows.hint("rebalance", *keys).write.partitionBy(*keys).mode("overwrite").parquet(f"{path}/run={run}")


def replace_partitions(rows: DataFrame, path: str, *keys: str) -> None:
    """Idempotent publish: only the partitions present in ``rows`` are replaced (K4).

    The rebalance hint gathers each partition into well-sized files; AQE splits
    a partition that is too large for one task.
    """
    (
        rows.hint("rebalance", *[F.col(k) for k in keys])
        .write.partitionBy(*keys)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(path)
    )


def write_delimited(rows: DataFrame, path: str, sep: str = ";") -> None:
    """Plain delimited text without quoting (K5)."""
    (
        rows.write.option("sep", sep)
        .option("quote", "")
        .option("escapeQuotes", False)
        .option("emptyValue", "")
        .mode("errorifexists")
        .csv(path)
    )
