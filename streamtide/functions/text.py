"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_name(c: Column) -> Column:
    """One token per name: blanks and commas become underscores."""
    return F.translate(c, " ,", "__")


def commas_to_blanks(c: Column) -> Column:
    """X2"""
    return F.translate(c, ",", " ")


def strip_separator(c: Column, sep: str = ";") -> Column:
    """Remove the field separator from a value."""
    return F.replace(c, F.lit(sep), F.lit(""))


def message_text(c: Column) -> Column:
    """Chat text with commas turned into semicolons."""
    return F.replace(c, F.lit(","), F.lit(";"))


def channel_name(c: Column) -> Column:
    """Channel without the leading hash sign."""
    return F.replace(c, F.lit("#"), F.lit(""))


def join_key(*cols: Column) -> Column:
    """Concatenation that is null as soon as one part is null."""
    return F.concat(*cols)


def day_part(key: Column) -> Column:
    """The yyyyMMdd head of a minute or hour key."""
    return F.substring(key, 1, 8)


def fields(c: Column, pattern: str, count: int) -> list[Column]:
    """The first ``count`` fields of a split; missing ones are null."""
    parts = F.split(c, pattern)
    return [F.get(parts, F.lit(i)) for i in range(count)]


def full_match(c: Column, pattern: str) -> Column:
    """Regex match over the whole value."""
    return c.rlike(rf"\A(?:{pattern})\z")


def empty_if_null(c: Column) -> Column:
    """X15"""
    return F.coalesce(c, F.lit(""))


def decode_cell(c: Column) -> Column:
    """Base64 transport text to plain text."""
    return F.unbase64(c).cast("string")


def drop_last_char(c: Column) -> Column:
    """X32"""
    return F.when(F.length(c) > 0, c.substr(F.lit(1), F.length(c) - 1)).otherwise(c)


def cut_text(c: Column, limit: int, wordwise: bool = False, tail: str = " …") -> Column:
    """Text cut to ``limit`` characters plus a tail; shorter text is unchanged."""
    text = empty_if_null(c)
    if not limit:
        return text
    head = F.substring(text, 1, limit)
    if wordwise:
        last_word = F.substring_index(head, " ", -1)
        head = F.when(
            F.instr(head, " ") > 0,
            head.substr(F.lit(1), F.length(head) - F.length(last_word) - 1),
        ).otherwise(head)
    return F.when(F.length(text) > limit, F.concat(head, F.lit(tail))).otherwise(text)


def hours_to_time(hours: Column) -> Column:
    """Decimal hours as HH:mm; rounded minutes carry into the hour."""
    minutes = F.floor(hours) * 60 + F.floor((hours - F.floor(hours)) * 60 + 0.5)
    whole = F.floor(minutes / 60).cast("string")
    rest = (minutes % 60).cast("string")
    return F.concat(
        F.when(F.length(whole) < 2, F.lpad(whole, 2, "0")).otherwise(whole),
        F.lit(":"),
        F.lpad(rest, 2, "0"),
    )
