"""Row filters, defaults and quarantine."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamtide.functions import text, times

REQUIRED = ("game", "name", "status")


def clean_samples(samples: DataFrame) -> DataFrame:
    """Drop polls stamped in ISO form (F1, P1) and parse the poll time."""
    kept = samples.where(~text.full_match(F.col("created"), ".*T.*"))
    return kept.select(
        "channel_id", "viewers", "game", "name", "status",
        times.parse_poll_time(F.col("created")).alias("created"),
        "mature", "fps",
    )


def rated_samples(samples: DataFrame, min_viewers: int = 500) -> DataFrame:
    """Polls with a frame rate and more than ``min_viewers`` viewers (F2)."""
    return samples.where(F.col("fps").isNotNull() & (F.col("viewers") > min_viewers))


def not_null(rows: DataFrame, *columns: str) -> DataFrame:
    """F3"""
    return rows.dropna(subset=list(columns))


def required_fields(rows: DataFrame, columns: Iterable[str] = REQUIRED) -> DataFrame:
    """Rows in which none of the columns is null or the text ``null``."""
    for name in columns:
        rows = rows.where(F.nullif(F.col(name), F.lit("null")).isNotNull())
    return rows


def default_mature(rows: DataFrame) -> DataFrame:
    """F5"""
    return rows.withColumn("mature", F.coalesce("mature", F.lit(False)))


def only_channels(rows: DataFrame, channels: Iterable[str], column: str = "channel") -> DataFrame:
    """Allow-list; for a list kept as a table use ``known_names``."""
    return rows.where(F.col(column).isin(*channels))


def split_valid(rows: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """The rows that satisfy a rule, and the quarantine of all others."""
    ok = F.coalesce(valid, F.lit(False))
    return rows.where(ok), rows.where(~ok)
