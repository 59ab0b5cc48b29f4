"""Time parsing, keys and differences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: key and timestamp formats
POLL_TIME = "yyyy-MM-dd HH:mm:ss"
MINUTE_KEY = "yyyyMMddHHmm"
HOUR_KEY = "yyyyMMddHH"
DAY_KEY = "yyyyMMdd"
RUN_SUFFIX = "'#'HHmm"
RUN_STAMP = "yyyy-MM-dd'T'HH-mm-ss"


def parse_poll_time(c: Column) -> Column:
    """X16; unreadable text becomes null."""
    return F.try_to_timestamp(c, F.lit(POLL_TIME))


def parse_iso(c: Column) -> Column:
    """X17"""
    return c.try_cast("timestamp")


def from_epoch_ms(c: Column) -> Column:
    """X18"""
    return F.timestamp_millis(c)


def minute_key(ts: Column) -> Column:
    """X19"""
    return F.date_format(ts, MINUTE_KEY)


def hour_key(ts: Column) -> Column:
    """X19"""
    return F.date_format(ts, HOUR_KEY)


def day_key(ts: Column) -> Column:
    """X19"""
    return F.date_format(ts, DAY_KEY)


def run_suffix(run_ts: Column) -> Column:
    """The #HHmm mark of the run that wrote a row."""
    return F.date_format(run_ts, RUN_SUFFIX)


def run_stamp(run_ts: Column) -> Column:
    """Run mark for folder and partition names."""
    return F.date_format(run_ts, RUN_STAMP)


def run_time(run_ts: str | None = None) -> Column:
    """The run's time as a column: an argument, or now."""
    return F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")


def from_minute_key(key: Column) -> Column:
    """X21"""
    return F.try_to_timestamp(key, F.lit(MINUTE_KEY))


def bucket_start(ts: Column, width: str = "1 minute") -> Column:
    """Start of the tumbling bucket of ``ts``.

    Calendar units are a plain truncation in the session's zone; grouping by it
    hashes eight bytes instead of a formatted key.
    """
    count, unit = width.split()
    if count == "1" and unit in ("minute", "hour", "day"):
        return F.date_trunc(unit, ts)
    return F.window(ts, width)["start"]


def minutes_between(start: Column, end: Column) -> Column:
    """Whole seconds between two times, in minutes."""
    micros = F.unix_micros(end) - F.unix_micros(start)
    return F.floor(micros / 1_000_000).cast("double") / F.lit(60.0)


def next_day(day: Column) -> Column:
    """X37"""
    return F.date_add(day, 1)
