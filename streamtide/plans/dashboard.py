"""The dashboard query: one stream, one day, by minute."""

from __future__ import annotations

from pyspark.sql import DataFrame

from streamtide.operators import joins, series, wide
from streamtide.sources import tables


def day_series(table: DataFrame, name: str, day: str, merge: bool = True) -> DataFrame:
    """Viewer and sentiment series of a stream and day, in time order.

    ``merge`` combines the runs of the day; without it their rows are
    concatenated and a minute may appear more than once (E1).
    """
    rows = tables.prefix_scan(table, name, day)
    viewers = wide.merged_viewers(rows) if merge else wide.flatten(rows, "viewerspermin")
    chat = wide.merged_chat(rows) if merge else wide.flatten(rows, "chatspermin")
    return series.time_ordered(
        series.viewer_series(viewers).unionByName(series.sentiment_series(chat))
    )


def minute_details(table: DataFrame, name: str, day: str) -> DataFrame:
    """The viewer series with the metadata shown for each minute."""
    rows = tables.prefix_scan(table, name, day)
    minutes = wide.merged_viewers(rows).select("name", "minute", "viewers")
    return joins.minute_lookup(minutes, wide.flatten(rows, "metadata"))
