"""Document fingerprints: one-permutation MinHash.

Each five-word shingle is hashed once. The top bits choose one of ``BINS`` bins, the rest is
the value, and a bin keeps its least value. Empty bins are filled by optimal densification:
each draws bins by a hash of its own number and attempt until it meets a filled one. The low
``BITS`` bits of the values are packed into the fingerprint. Two unrelated bins agree with
probability ``2 ** -BITS``, so the agreement is corrected by it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamtide.llm.common import CHUNK, DARK, LOWER, as_bytes, in_tasks, mixed, shingle_hashes, slices, span_hashes, stored, word_spans

BINS = 256
BITS = 4
WIDTH = 5
#: The fingerprint of a text without words.
NO_WORDS = ""


def draws() -> np.ndarray:
    """For each empty bin, the bins it asks in turn; the same for every document."""
    tries = 4 * BINS
    grid = np.arange(BINS, dtype=np.uint64)[:, None] * np.uint64(1 << 20) + np.arange(tries, dtype=np.uint64)
    return (mixed(grid + np.uint64(1)) >> np.uint64(64 - 8)).astype(np.int64) % BINS


DRAWS = draws()


def signatures(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The low bits of all bins for each text, and which texts have words."""
    data, offsets = as_bytes(texts)
    data = LOWER[data]
    starts, ends, firsts = word_spans(data, offsets, DARK)
    hashes, owner = shingle_hashes(span_hashes(data, starts, ends), firsts, WIDTH)
    n = len(texts)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    least = np.full(n * BINS, empty)
    slot = owner * BINS + (hashes >> np.uint64(56)).astype(np.int64) % BINS
    np.minimum.at(least, slot, hashes & np.uint64((1 << 56) - 1))
    least = least.reshape(n, BINS)
    some = np.diff(firsts) > 0
    filled = least != empty
    out = least.copy()
    row, bin_ = np.nonzero(~filled & some[:, None])
    for attempt in range(DRAWS.shape[1]):
        if not len(row):
            break
        source = DRAWS[bin_, attempt]
        hit = filled[row, source]
        out[row[hit], bin_[hit]] = least[row[hit], source[hit]]
        row, bin_ = row[~hit], bin_[~hit]
    out[row, bin_] = least[row, filled[row].argmax(axis=1)]
    return (out & np.uint64((1 << BITS) - 1)).astype(np.uint8), some


def packed(low: np.ndarray, some: np.ndarray) -> list[str]:
    pairs = (low[:, 0::2] << 4) | low[:, 1::2]
    return [row.tobytes().hex() if full else NO_WORDS for row, full in zip(pairs, some)]


def likeness(a: np.ndarray, some_a: np.ndarray, b: np.ndarray, some_b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity, from 0 to 1; two texts without words are alike."""
    chance = 2.0 ** -BITS
    agree = (a == b).mean(axis=1)
    value = np.clip((agree - chance) / (1 - chance), 0.0, 1.0)
    return np.where(some_a & some_b, value, np.where(some_a == some_b, 1.0, 0.0))


def fingerprint(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (default: all) with ``fingerprint``; a column of that name is replaced.

    Each row is judged for itself; texts without words, null among them, share one fingerprint.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != "fingerprint"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                prints = packed(*signatures(part.column(text)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(prints, pa.string())], [*keep, "fingerprint"])

    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + ["fingerprint string"]
    return in_tasks(docs.select(*keep, *([] if text in keep else [text])), run, ", ".join(fields))


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
         "near_edited double, near_next double"
FIELDS = [x.split()[0] for x in SCHEMA.split(", ")]
ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}
EDGES = pa.schema([(name, ARROW[kind]) for name, kind in map(
    str.split, f"{SCHEMA}, edge string, part int, text string".split(", "))])


def compared(ids: list, texts: list[str], following: list[str], chained: bool) -> pa.RecordBatch:
    """One output row for each text, given the text that follows it.

    ``chained``: each following text but the last is the next of ``texts``.
    """
    edited = [t[:len(t) - len(t) // 4] + f[:len(t) // 4] for t, f in zip(texts, following)]
    own, some = signatures(pa.array(texts, pa.string()))
    changed, some_changed = signatures(pa.array(edited, pa.string()))
    after, some_after = signatures(pa.array(following[-1:] if chained else following, pa.string()))
    if chained:
        after, some_after = np.concatenate([own[1:], after]), np.concatenate([some[1:], some_after])
    return pa.RecordBatch.from_arrays([
        pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
        pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited], pa.string()),
        pa.array(packed(own, some), pa.string()), pa.array(packed(changed, some_changed), pa.string()),
        pa.array(likeness(own, some, changed, some_changed)), pa.array(likeness(own, some, after, some_after))], FIELDS)


def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares each row of a sorted partition with the next one.

    The first and the last text of the partition come out as they are, as ``edge`` rows: their
    neighbours lie in other partitions.
    """
    def edge(kind: str) -> pa.RecordBatch:
        rows = {**dict.fromkeys(FIELDS), "doc_id": ids[-1], "edge": kind, "part": part, "text": texts[-1]}
        return pa.RecordBatch.from_pylist([rows], EDGES)

    def inner() -> pa.RecordBatch:
        rows = compared(ids[:-1], texts[:-1], texts[1:], chained=True)
        n = rows.num_rows
        return pa.RecordBatch.from_arrays([*rows.columns, *(pa.nulls(n, f.type) for f in list(EDGES)[len(FIELDS):])], schema=EDGES)

    ids, texts, size, part = [], [], 0, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("part", "doc_id", "text")]
        for here, doc, text in zip(*columns):
            if size + len(text) > CHUNK and len(texts) > 1:
                yield inner()
                ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
            ids.append(doc)
            texts.append(text)
            size += len(text)
            if part is None:
                part = here
                yield edge("first")
    if texts:
        if len(texts) > 1:
            yield inner()
        yield edge("last")


def edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document against its edited text and the next document, by ascending id.

    The texts are dealt out once, by ranges of the id, and sorted there; what lies on either
    side of a border is one row for each partition, joined with its neighbour afterwards. Null
    texts are empty. Null ids come first, rows with one id in the order of their texts; the
    last row is followed by the first, and a single row by itself. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    dealt = dealt.select(F.spark_partition_id().alias("part"), "doc_id", "text")
    found = stored(in_tasks(dealt, in_order, f"{SCHEMA}, edge string, part int, text string"), "edits")
    first = found.where("edge = 'first'").select("part", F.col("text").alias("following"))
    last = found.where("edge = 'last'").select("part", "doc_id", "text")
    order = Window.orderBy("part")  # a row for each partition
    around = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    follows = first.select("part", F.coalesce(F.lead("part").over(order), F.first("part").over(around)).alias("after"))
    border = last.join(follows, "part").join(first.withColumnRenamed("part", "after"), "after").select("doc_id", "text", "following")

    def at_border(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield compared(*(part.column(c).to_pylist() for c in ("doc_id", "text", "following")), chained=False)

    return found.where("edge is null").select(*FIELDS).unionByName(border.mapInArrow(at_border, SCHEMA))
