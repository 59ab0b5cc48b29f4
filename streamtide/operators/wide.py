"""The wide stream-day row: building it and taking it apart again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamtide import schemas
from streamtide.operators import rollups

GROUP = ["name", "day"]
#: Slices of an hour: with 24 hours, the parts of a stream and day.
SLICES = 4
BAGS = {
    "metadata": schemas.METADATA_ENTRY,
    "viewerspermin": schemas.VIEWERS_ENTRY,
    "chatspermin": schemas.CHAT_ENTRY,
}


def metadata_entries(samples: DataFrame) -> DataFrame:
    """Distinct metadata samples per stream and day with their number of polls (A5).

    Equal samples are counted before the shuffle instead of being carried one
    by one; ``repeat_polls`` restores them.
    """
    rows = samples.where(F.col("name").isNotNull() & F.col("created").isNotNull())
    return rows.groupBy(
        "name", F.to_date("created").alias("day"), "created", "game", "status", "mature", "fps"
    ).agg(F.count(F.lit(1)).alias("polls"))


def part_of(at: Column, *values: Column | str) -> Column:
    """The part an entry goes to, from its own values alone: its hour, and one of SLICES by hash.

    The rule is the same for all lists, streams and days, whatever their size, so the parts of
    a stream and day number 24 * SLICES at most and no row holds more than one of them.
    """
    return F.hour(at) * SLICES + F.pmod(F.xxhash64(at, *values), F.lit(SLICES)).cast("int")


def _as_bag_rows(rows: DataFrame, bag: str) -> DataFrame:
    """Rows as (name, day, part) plus three entry columns, of which one is set."""
    own = [c for c in rows.columns if c not in GROUP]
    at, *rest = [c for c in own if c in ("created", "minute")] + [c for c in own if bag == "metadata" and c not in ("created", "polls")]
    cells = [
        (F.struct(*own) if name == bag else F.lit(None)).cast(dtype).alias(name)
        for name, dtype in BAGS.items()
    ]
    return rows.where("name is not null and day is not null").select(
        *GROUP, part_of(F.col(at), *rest).alias("part"), *cells
    )


def _polled(minutes: DataFrame) -> DataFrame:
    """The minutes of streams and days that have viewers: a window over their minutes only."""
    has_viewers = F.max(F.col("viewerspermin").isNotNull()).over(Window.partitionBy(*GROUP))
    return minutes.withColumn("polled", has_viewers).where("polled").drop("polled")


def stream_day(
    samples: DataFrame,
    viewers: DataFrame,
    chat: DataFrame,
    run_ts: Column,
    how: str = "left",
) -> DataFrame:
    """Nested rows per stream, day and part.

    ``viewers`` and ``chat`` are minute tables, at most 1,440 entries per
    stream and day, ``viewers`` that of ``samples``. With ``how='left'`` only
    streams and days with polls remain, ``how='full'`` keeps all. The inputs are
    concatenated and grouped once, so the cogroup needs no join.
    """
    if how not in ("left", "full"):
        raise ValueError(f"how must be 'left' or 'full', not {how!r}")
    minutes = _as_bag_rows(
        viewers.select(*GROUP, "minute", "viewers_sum", "viewers_cnt", "viewers"), "viewerspermin"
    ).unionAll(_as_bag_rows(
        chat.select(*GROUP, "minute", "positive", "negative", "neutral"), "chatspermin"
    ))
    if how == "left":
        minutes = _polled(minutes)
    bags = _as_bag_rows(metadata_entries(samples), "metadata").unionAll(minutes)
    rows = bags.groupBy(*GROUP, "part").agg(
        *[F.sort_array(F.collect_list(name)).alias(name) for name in BAGS]
    )
    return rows.select(*GROUP, run_ts.alias("run_ts"), "part", *BAGS)


def row_key(suffix: Column) -> Column:
    """The text key of a wide row: name, day and the run's mark."""
    return F.concat(F.col("name"), F.date_format("day", "yyyyMMdd"), suffix)


def flatten(table: DataFrame, bag: str) -> DataFrame:
    """One nested column back to rows, runs concatenated."""
    return table.select(*GROUP, F.inline(bag))


def repeat_polls(entries: DataFrame, block: int = 100_000) -> DataFrame:
    """Metadata entries repeated ``polls`` times, in blocks, so that no list is longer."""
    columns = [c for c in entries.columns if c != "polls"]
    one, size = F.lit(1).cast("long"), F.lit(block).cast("long")
    blocks = entries.select("*", F.explode(F.sequence(one, "polls", size)).alias("first"))
    last = F.least(F.col("polls"), F.col("first") + size - 1)
    return blocks.select(*columns, F.explode(F.sequence("first", last)).alias("copy")).drop("copy")


def project_entries(items: Column, *fields: str) -> Column:
    """Selected fields of every entry of a nested column."""
    return F.transform(items, lambda x: F.struct(*[x[f].alias(f) for f in fields]))


def merged_viewers(table: DataFrame) -> DataFrame:
    """Minute table of the viewers, runs merged by sum and count."""
    return rollups.merge_viewers(flatten(table, "viewerspermin"))


def merged_chat(table: DataFrame) -> DataFrame:
    """Minute table of the chat, runs merged."""
    return rollups.merge_chat(flatten(table, "chatspermin"))


def day_rollup(table: DataFrame) -> DataFrame:
    """Mean viewers over the minutes, and sentiment sums, per stream and day.

    Both lists go through one pass as entries of the same shape; each entry
    only carries values of its own list, so neither multiplies the other. The
    first grouping merges the runs of a minute.
    """
    none = F.lit(None).cast("long")
    viewers = F.transform("viewerspermin", lambda x: F.struct(
        x["minute"].alias("minute"), x["viewers_sum"].alias("viewers_sum"),
        x["viewers_cnt"].alias("viewers_cnt"), none.alias("positive"), none.alias("negative"),
        none.alias("neutral"),
    ))
    chat = F.transform("chatspermin", lambda x: F.struct(
        x["minute"].alias("minute"), none.alias("viewers_sum"), none.alias("viewers_cnt"),
        x["positive"].alias("positive"), x["negative"].alias("negative"),
        x["neutral"].alias("neutral"),
    ))
    counts = ["viewers_sum", "viewers_cnt", "positive", "negative", "neutral"]
    minutes = (
        table.select(*GROUP, F.inline(F.concat(viewers, chat)))
        .groupBy(*GROUP, "minute")
        .agg(*[F.sum(c).alias(c) for c in counts])
    )
    return minutes.groupBy(*GROUP).agg(
        F.avg(rollups.viewer_mean()).alias("viewers"),
        *[F.sum(c).alias(c) for c in ("positive", "negative", "neutral")],
    )
