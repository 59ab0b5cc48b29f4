"""License scans: phrases word for word, and notices by an exact set-similarity join.

A notice (template) is a set of words. A text block is as many consecutive words as the
notice has (a shorter text is one block), and meets it if it holds ``threshold`` of the
notice's distinct words. All blocks that do are found:

* words are ordered by their count over all documents, the rarest first; of a notice with
  ``n`` words of which ``need`` must be met, a block must hold one of the first
  ``n - need + 1`` (prefix);
* a text with fewer than ``need`` words cannot meet it (length);
* around each such word, the distinct notice words in reach must number ``need``
  (position); only there do blocks slide, word by word, with exact counts.

The templates are a parameter and small; documents are never exchanged.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamtide.llm.common import in_tasks

# Phrases that name a license when their words stand consecutively.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Usual wording of notices.
TEMPLATES = {
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
           "and associated documentation files, to deal in the software without restriction",
    "apache-2": "Licensed under the Apache License, Version 2.0; you may not use this file except in "
                "compliance with the license",
    "gpl-3": "This work is licensed under the GNU General Public License, version 3",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted "
           "provided that the following conditions are met",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc": "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License",
}
THRESHOLD = 0.8

SPLIT = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words: digits, letters and all signs outside ASCII."""
    return (text or "").encode().translate(SPLIT).split()


@dataclass(frozen=True)
class Notice:
    label: str
    length: int
    words: frozenset[bytes]
    need: int
    prefix: frozenset[bytes]


def counts_of(docs: DataFrame, vocabulary: frozenset[bytes], text: str) -> dict[bytes, int]:
    """How often each of these words stands in all documents; the result is as small as they."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for value in batch.column(0):
                total.update(filter(vocabulary.__contains__, words_of(value.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())], ["word", "n"])

    rows = in_tasks(docs.select(text), count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in rows.collect()}


def notices(templates: dict[str, str], counts: dict[bytes, int], threshold: float) -> list[Notice]:
    found = []
    for label, body in templates.items():
        words = words_of(body)
        order = sorted(set(words), key=lambda w: (counts.get(w, 0), w))
        need = math.ceil(threshold * len(order) - 1e-9)
        found.append(Notice(label, len(words), frozenset(order), need, frozenset(order[:len(order) - need + 1])))
    return found


def reach(places: list[int], length: int) -> Iterator[tuple[int, int]]:
    """The unions of the ranges that blocks over these places can cover."""
    begin = end = None
    for at in places:
        if end is not None and at - length + 1 <= end:
            end = at + length
            continue
        if end is not None:
            yield begin, end
        begin, end = max(at - length + 1, 0), at + length
    if end is not None:
        yield begin, end


def blocks(words: list[bytes], notice: Notice) -> Iterator[tuple[int, int, float]]:
    """Start, end and best containment of each run of blocks that meet the notice."""
    if len(words) < notice.need or not words:
        return
    length = min(notice.length, len(words))
    for begin, end in reach([i for i, w in enumerate(words) if w in notice.prefix], notice.length):
        part = words[begin:end]
        if len(notice.words.intersection(part)) < notice.need:
            continue
        held: Counter[bytes] = Counter()
        run = None
        for i, word in enumerate(part):
            if word in notice.words:
                held[word] += 1
            if i >= length and (old := part[i - length]) in notice.words:
                held[old] -= 1
                if not held[old]:
                    del held[old]
            if i + 1 < length or len(held) < notice.need:
                continue
            start, share = begin + i + 1 - length, len(held) / len(notice.words)
            if run and start <= run[1]:
                run = run[0], start + length, max(run[2], share)
            else:
                if run:
                    yield run
                run = start, start + length, share
        if run:
            yield run


def phrase_places(words: list[bytes], phrases: dict[tuple[bytes, ...], str]) -> list[tuple[int, str]]:
    joined = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in phrases.items():
        pattern = b"(?=" + re.escape(b" " + b" ".join(phrase) + b" ") + b")"
        if phrase[0] in joined:
            found += [(joined.count(b" ", 0, m.start()), label) for m in re.finditer(pattern, joined)]
    return sorted(found)


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), phrases: dict[str, str] = PHRASES,
         templates: dict[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """The kept columns, n_words, phrases (start, label) and notices (label, start, end, containment).

    Places count words from 0, ends are exclusive. Null is an empty text and has neither; each
    row is judged for itself; an empty table gives an empty result. Kept columns must not have
    the names of the added ones; others are not read.
    """
    vocabulary = frozenset(w for body in templates.values() for w in words_of(body))
    wanted = notices(templates, counts_of(docs, vocabulary, text), threshold)
    sought = {tuple(words_of(p)): label for p, label in phrases.items()}
    prefixes = frozenset().union(*(n.prefix for n in wanted)) if wanted else frozenset()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, exact, similar = [], [], []
            for value in batch.column(text):
                words = words_of(value.as_py())
                sizes.append(len(words))
                exact.append([{"start": s, "label": x} for s, x in phrase_places(words, sought)])
                near = [] if prefixes.isdisjoint(words) else [
                    {"label": n.label, "start": s, "end": e, "containment": c} for n in wanted for s, e, c in blocks(words, n)]
                similar.append(near)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(sizes, pa.int64()), pa.array(exact, EXACT), pa.array(similar, SIMILAR)],
                [*keep, "n_words", "phrases", "notices"])

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    added = "n_words long, phrases array<struct<start:long,label:string>>, " \
            "notices array<struct<label:string,start:long,end:long,containment:double>>"
    return in_tasks(docs.select(*keep, *([] if text in keep else [text])), run, ", ".join([*fields, added]))


EXACT = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
SIMILAR = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())]))


def digest(docs: DataFrame) -> DataFrame:
    base = F.array_sort(F.array_distinct(F.col("phrases.label")))
    every = F.array_sort(F.array_distinct(F.concat(F.col("phrases.label"), F.col("notices.label"))))
    return scan(docs).select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"),
        F.array_min("phrases.start").alias("first_word"), F.array_max("phrases.start").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(every, ",").alias("labels"),
        F.when(F.size("phrases") > 0, 1.0).otherwise(F.coalesce(F.array_max("notices.containment"), F.lit(0.0))).alias("score"),
        F.size("notices").cast("long").alias("n_notices"))
