"""Weather observations as a stream.

The stream only appends parsed observations; the latest one per hour and place
is resolved when reading (``plans.ingest.latest_weather``). Overwriting a day
per batch would lose the day's earlier rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from streamtide.plans.ingest import ingest_weather
from streamtide.streaming.chat import file_stream, write_rolled

LANDED_DOCUMENT = "body string, place string, landed_at timestamp"


def weather_documents(spark: SparkSession, path: str, **options) -> DataFrame:
    """Landed responses as JSON lines of document text, place and landing time."""
    return file_stream(spark, path, LANDED_DOCUMENT, **options)


def write_observations(
    documents: DataFrame, path: str, checkpoint: str, until_done: bool = False
) -> StreamingQuery:
    return write_rolled(
        ingest_weather(documents), path, checkpoint, every="1 hour", until_done=until_done
    )
