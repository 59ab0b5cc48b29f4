"""Landing data to typed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamtide.functions import text
from streamtide.operators import joins, quality, rollups
from streamtide.session import stored
from streamtide.sources import documents


def ingest_metadata(
    pages: DataFrame, polled_at: str = "landed_at", latest_only: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Listing pages to polls, and the quarantine of unreadable pages and elements.

    The parsed elements are stored, so both come from one parse.
    """
    kept = [c for c in pages.columns if c not in ("body", "element", "stream")]
    elements = stored(documents.page_elements(pages, *kept), "elements")
    rows = quality.default_mature(
        quality.required_fields(documents.stream_rows(elements, polled_at))
    )
    if latest_only:
        rows = rollups.latest_per_key(rows, ["channel_id"], ["created", "updated_at"])
    return rows, documents.page_quarantine(elements)


def ingest_chat(messages: DataFrame, scores: DataFrame, key: str = "msg_id") -> DataFrame:
    """Messages, batch or stream, with their sentiment code (C2: S13, J3, X10)."""
    spoken = messages.where("msg is not null")
    named = spoken.withColumn("channel", text.channel_name(F.col("channel")))
    return joins.attach_sentiment(named, scores, key).select("ts", "channel", "msg", "sentiment")


def ingest_weather(pages: DataFrame, obs_ts: str = "landed_at") -> DataFrame:
    """Weather documents to the observation log (C3); ``latest_weather`` resolves it."""
    return documents.weather_rows(documents.weather_parts(pages, obs_ts))


def latest_weather(obs: DataFrame, *tie_break: str) -> DataFrame:
    """The last observation of each hour and place (K2)."""
    return rollups.latest_per_key(obs, ["hour_key", "place"], ["obs_ts", *tie_break])


def minute_rollups(samples: DataFrame, chat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Viewer and chat minute tables of raw polls and typed chat (C4)."""
    return (
        rollups.viewers_per_bucket(quality.clean_samples(samples)),
        rollups.chat_per_bucket(chat),
    )


def sessions_of(
    samples: DataFrame, min_viewers: int = 500, batch: Sequence[str] = ()
) -> DataFrame:
    """Sessions of cleaned polls: F2, X1 on the names, A3."""
    rated = quality.rated_samples(samples, min_viewers)
    named = rated.withColumns({c: text.clean_name(F.col(c)) for c in ("name", "game")})
    return rollups.session_summary(named, *batch)
