"""Which streams are not tracked yet (C11)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from streamtide.operators import joins, quality, rollups


def new_channels(
    samples: DataFrame, active: DataFrame, batch: str = "run",
    allowed: Iterable[str] | None = None, newest: str | None = None,
) -> DataFrame:
    """Names of the newest batch without a running capture.

    ``batch`` is the column that marks a poll's batch; its pages carry different
    times. On a table partitioned by it only the newest folder is read. ``newest``
    is that batch where a catalogue has it, so that the table is read once.
    """
    latest = rollups.newest_batch(samples, batch, newest)
    if allowed is not None:
        latest = quality.only_channels(latest, allowed, "name")
    return joins.new_names(latest, active)
