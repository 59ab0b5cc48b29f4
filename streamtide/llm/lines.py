"""Line dedup: repeated runs of lines, by prefix doubling over line names.

The corpus is a sequence of line names (128-bit hashes), documents one after the other by id;
no run crosses documents. Doubling names runs of 1, 2, 4, ... lines: the name of twice as many
lines is made of two names of the last round, and only places whose name stands elsewhere too
stay. Places with one name share a prefix of that many lines: they are an interval of the
suffix array. A prefix of any other length is two overlapping runs of the largest power of two
within it, so two names identify it.

A repeated run counts from ``min_words`` words on. A run that long is a union of least windows,
those that go forward from a line (as many lines as reach ``min_words``) and those that go back
from one; the forward windows alone leave out the lines after the last of them that ends within
the run. Each window of a repeated run is repeated itself; so the windows whose interval has an
earlier place make up exactly the later copies of the maximal repeated runs. A window back to a
line holds the forward window from it and ends before that of the next line, so the windows of
a line have all lengths between two bounds, and a text has at most two windows a line.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamtide.llm.common import DARK, as_bytes, free_name, in_tasks, slices, stored

MIN_WORDS = 50
#: Documents with deletions and their runs up to these numbers are broadcast, below 64 MB.
BROADCAST_ROWS = 400_000
BROADCAST_RUNS = 1_600_000


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc (id and a hash of the text: repeated rows are one document) and text."""
    return docs.select(F.struct(F.col(doc_id).alias("id"), F.xxhash64(text).alias("tie")).alias("doc"), F.col(text).alias("text"))


def names_of(data: bytes, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A 128-bit hash of each byte range, as two longs."""
    view = memoryview(data)
    signs = b"".join(hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist()))
    halves = np.frombuffer(signs, np.int64).reshape(-1, 2)
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(halves[:, k])) for k in (0, 1)], ["a", "b"])


def name_of_two(first: str, second: str) -> Column:
    """The name of two runs put together: two hashes of both names, from different beginnings."""
    return F.struct(*(F.xxhash64(F.lit(k), first, second).alias(half) for k, half in enumerate("ab")))


def line_names(docs: DataFrame, min_words: int) -> DataFrame:
    """doc, line, name, length, most: every line, and the fewest and most lines of the least windows that start with it (0: none)."""

    def names(part: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = as_bytes(part.column("text"))
        cut = data == 10
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        breaks = np.flatnonzero(cut)
        owner_of_break = np.searchsorted(offsets, breaks, side="right") - 1
        known = part.column("text").is_valid().to_numpy(zero_copy_only=False)
        n = np.where(known, np.bincount(owner_of_break, minlength=part.num_rows) + 1, 0)
        owner = np.repeat(np.arange(part.num_rows), n)
        line = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        starts = np.sort(np.concatenate([offsets[:-1][known], breaks + 1]), kind="stable")
        ends = np.sort(np.concatenate([offsets[1:][known], breaks]), kind="stable")
        inside = DARK[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:-1]
        words = np.concatenate([[0], np.cumsum(first)])
        before, after = words[starts], words[ends]
        to = np.searchsorted(after, before + min_words)
        last = np.repeat(np.cumsum(n), n)
        at = np.arange(len(owner))
        length = np.where(to < last, to - at + 1, 0)
        most = np.where(length > 0, np.maximum(length, np.minimum(np.append(to[1:], len(owner)), last) - at), 0)
        return pa.RecordBatch.from_arrays(
            [part.column("doc").take(pa.array(owner)), pa.array(line.astype(np.int32)),
             names_of(data.tobytes(), starts, ends), pa.array(length.astype(np.int32)),
             pa.array(most.astype(np.int32))], ["doc", "line", "name", "length", "most"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield names(part)

    return in_tasks(docs, run, "doc struct<id:long,tie:long>, line int, name struct<a:long,b:long>, length int, most int")


def repeated(named: DataFrame) -> DataFrame:
    """The places whose name stands at another place as well."""
    names = named.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    return named.join(names, "name")


def with_second(first: DataFrame, second: DataFrame, ahead: Column) -> DataFrame:
    """Each place with the name that stands ``ahead`` lines further on, where one does."""
    other = second.select("doc", F.col("line").alias("at"), F.col("name").alias("second"))
    return first.withColumn("at", F.col("line") + ahead).join(other, ["doc", "at"]).drop("at")


def windows(docs: DataFrame, min_words: int) -> DataFrame:
    """doc, line, length, name, second: the least windows that may be repeated, by their names."""
    level = repeated(line_names(docs, min_words)).dropDuplicates(["doc", "line"])
    size, found = 1, None
    while True:
        level = stored(level, "names")
        whole = level.where((F.col("length") > 0) & (F.col("most") >= size) & (F.col("length") < 2 * size))
        lengths = F.sequence(F.greatest("length", F.lit(size)), F.least("most", F.lit(2 * size - 1)))
        whole = whole.withColumn("length", F.explode(lengths))
        here = whole.withColumn("second", F.col("name")) if size == 1 else with_second(whole, level, F.col("length") - size)
        here = here.select("doc", "line", "length", "name", "second")
        found = here if found is None else found.union(here)
        if level.where(F.col("most") >= 2 * size).isEmpty():
            return found
        doubled = with_second(level, level, F.lit(size))
        level = repeated(doubled.select("doc", "line", name_of_two("name", "second").alias("name"), "length", "most"))
        size *= 2


def later_copies(docs: DataFrame, min_words: int) -> DataFrame:
    """doc, runs: for each document with deletions, the runs of lines (from, to) that go."""
    place = F.struct("doc", "line")
    every = stored(windows(docs, min_words), "windows")
    intervals = every.groupBy("name", "second", "length").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = every.join(intervals, ["name", "second", "length"]).where(place > F.col("first"))
    order = Window.partitionBy("doc").orderBy("line")
    reach = F.max(F.col("line") + F.col("length")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = (
        later.select("doc", "line", "length").withColumn("reach", F.coalesce(reach, F.lit(-1)))
        .withColumn("island", F.sum((F.col("line") > F.col("reach")).cast("int")).over(order))
        .groupBy("doc", "island").agg(F.min("line").alias("from"), F.max(F.col("line") + F.col("length")).alias("to"))
    )
    return islands.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("runs"))


def kept_text(text: Column, runs: Column) -> Column:
    """The lines outside the runs, which are in order and do not meet."""
    lines = F.split(text, "\n", -1)

    def stretch(i: Column) -> Column:
        begin = F.when(i == 0, 0).otherwise(F.get(runs, i - 1)["to"])
        end = F.coalesce(F.get(runs, i)["from"], F.size(lines))
        return F.slice(lines, begin + 1, end - begin)

    kept = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(runs)), stretch)), "\n")
    return F.when(runs.isNull(), text).otherwise(kept)


def dedup(docs: DataFrame, min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` with the kept text in place of the text, and ``removed_runs``.

    The first copy of a run, by id and line, stays; runs within one document count too. A null
    text has no lines and stays null, an empty one has one empty line. Rows that repeat an id
    and its text are one document and get the same answer; null ids come first; a column named
    removed_runs is replaced. Columns with other names pass through.
    """
    goes = stored(later_copies(keyed(docs, doc_id, text), min_words), "later-copies")
    rows, runs = goes.agg(F.count("*"), F.coalesce(F.sum(F.size("runs")), F.lit(0))).first()
    if rows <= BROADCAST_ROWS and runs <= BROADCAST_RUNS:
        goes = F.broadcast(goes)
    names = [c for c in docs.columns if c != "removed_runs"]
    doc = free_name("doc", docs)
    key = F.struct(F.col(doc_id).cast("long").alias("id"), F.xxhash64(text).alias("tie"))
    joined = docs.select(*names, key.alias(doc)).join(goes.select(F.col("doc").alias(doc), F.col("runs").alias("removed_runs")), doc, "left")
    return joined.select(*(kept_text(F.col(c), F.col("removed_runs")).alias(c) if c == text else c for c in names), "removed_runs")


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, lines before, lines removed, removed runs, and the hash of the text that is left."""
    found = dedup(docs.select("doc_id", F.col("text").alias("whole"), "text"))
    runs = F.coalesce("removed_runs", F.array().cast("array<struct<from:int,to:int>>"))
    n_removed = F.aggregate(runs, F.lit(0).cast("long"), lambda n, r: n + r["to"] - r["from"])
    return found.select(
        "doc_id", F.when(F.col("whole").isNull(), 0).otherwise(F.length(F.regexp_replace("whole", "[^\n]+", "")) + 1).cast("long").alias("n_lines"),
        n_removed.alias("n_removed"), F.size(runs).cast("long").alias("n_runs"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
