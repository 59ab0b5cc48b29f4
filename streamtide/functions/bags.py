"""Import of nested lists that were stored as text: ``{(a,b),(c,d)}``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _records(c: Column) -> Column:
    body = F.regexp_replace(c, r"\A\{\(?|\)?\}\z", "")
    return F.when(c.isNull(), F.lit(None)).when(
        body == "", F.array().cast("array<string>")
    ).otherwise(F.split(body, r"\),\("))


def _split_records(c: Column) -> Column:
    """Every record as its list of fields, so that each is split only once."""
    return F.transform(_records(c), lambda record: F.split(record, ","))


def parse_bag(c: Column, columns: dict[str, str]) -> Column:
    """Bag text to an array of structs; ``columns`` maps field name to type.

    ``{}`` is an empty array, a field that does not fit its type is null.
    """

    def record(parts: Column) -> Column:
        return F.struct(*[
            F.get(parts, F.lit(i)).try_cast(dtype).alias(name)
            for i, (name, dtype) in enumerate(columns.items())
        ])

    return F.transform(_split_records(c), record)


def parse_metadata_bag(c: Column) -> Column:
    """Bag of (key, name, game, status, mature, fps, created).

    The status may hold commas: the first three and the last three fields are
    fixed, whatever lies between them is the status.
    """

    def record(parts: Column) -> Column:
        size = F.size(parts)
        status = F.array_join(F.slice(parts, F.lit(4), F.greatest(size - 6, F.lit(0))), ",")
        return F.struct(
            F.get(parts, F.lit(1)).alias("name"),
            F.get(parts, F.lit(2)).alias("game"),
            status.alias("status"),
            F.get(parts, size - 3).try_cast("boolean").alias("mature"),
            F.get(parts, size - 2).try_cast("double").alias("fps"),
            F.get(parts, size - 1).try_cast("timestamp").alias("created"),
        )

    return F.transform(_split_records(c), record)


def bag_text(items: Column, *fields: str) -> Column:
    """The reverse: an array of structs as bag text, fields in the given order."""
    rows = F.transform(items, lambda x: F.concat(
        F.lit("("), F.concat_ws(",", *[F.coalesce(x[f].cast("string"), F.lit("")) for f in fields]), F.lit(")")
    ))
    return F.concat(F.lit("{"), F.array_join(rows, ","), F.lit("}"))
