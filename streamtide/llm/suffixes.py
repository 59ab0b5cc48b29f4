"""Repeated byte strings: which suffixes share their first WINDOW bytes with another one.

The suffixes that matter are sorted in runs, the sorted runs are front-coded (each entry
without the bytes it has in common with the one before) and exchanged by range, and loser trees
that never look at known common bytes merge them; entries with equal keys mark their suffixes.
A suffix stands in its run by the 64-bit fingerprint of its first WINDOW bytes: the bytes
themselves, however coded, would be some hundred bytes for each suffix that has no near
neighbour in its own run.

1. Texts with exact copies are found by their digest; one of them represents the rest.
2. In each window of WINDOW bytes the least hash of its grams of GRAM bytes is the same
   wherever the window stands. Only windows whose least gram stands at two places, over all
   documents, can be repeated; the others, by far the most, end here.
3. The remaining stretches of text are written in packets. A packet's suffixes make one run.
4. The runs are cut into ranges of the key; a range holds about RANGE entries of all runs, and
   a key once for each packet, so a string that a third of the documents have is no load. In a
   range, the trees of many narrower ranges (lanes) are played side by side.
5. The marks, one bit for each entry, go back to the packet and become places in the texts.

Passages are found in the same way, with words (between white space) in place of bytes: 50
words have fewer than 400 bytes in most texts. They are counted, not removed.

Two different windows have one fingerprint with probability 2**-64.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamtide.llm.common import BASE, DARK, INVERSE, as_bytes, in_tasks, mixed, powers, prefix_sums, slices, span_hashes, stored, word_spans

WINDOW = 400
GRAM = 200
#: Words of a passage; a word.
PASSAGE = 50
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text hashed at once and in a packet, unless one document has more; entries in a range.
PART = 1_000_000
PACKET = 1_000_000
RANGE = 1_000_000
LEAST_RANGES = 32
#: Tables of ids up to these sizes (rows, and entries of their lists) are broadcast.
BROADCAST_ROWS = 400_000
BROADCAST_ENTRIES = 4_000_000


def units_of(column: pa.Array, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts, or the 64-bit hashes of their words, end to end, and the offsets."""
    data, offsets = as_bytes(column)
    if not words:
        return data, offsets
    starts, ends, firsts = word_spans(data, offsets, DARK)
    return span_hashes(data, starts, ends), firsts


def hashes_at(data: np.ndarray, places: np.ndarray | None, size: int) -> np.ndarray:
    """The hash of the ``size`` bytes (or words) from each place, by default from every one."""
    if data.dtype == np.uint8:
        sums = prefix_sums(data)
    else:
        sums = np.append(np.uint64(0), np.cumsum(data * powers(BASE, len(data)), dtype=np.uint64))
    back = powers(INVERSE, len(data) + 1)
    if places is None:
        return mixed((sums[size:] - sums[:len(data) - size + 1]) * back[:len(data) - size + 1])
    return mixed((sums[places + size] - sums[places]) * back[places])


def sliding(x: np.ndarray, width: int, best: np.ufunc, last: int) -> np.ndarray:
    """The least or greatest of each ``width`` neighbours, from blocks summed up both ways."""
    rows = -(-len(x) // width)
    blocks = np.full(rows * width, last, x.dtype)
    blocks[:len(x)] = x
    blocks = blocks.reshape(rows, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - width + 1
    return best(behind[:n], ahead[width - 1:width - 1 + n])


def least_grams(data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """The gram hash of every place, the least one of every window, and which windows lie
    within one text."""
    grams = np.maximum(hashes_at(data, None, gram), np.uint64(1))
    least = sliding(grams, window - gram + 1, np.minimum, np.iinfo(np.uint64).max)
    inside = np.zeros(len(data) + 1, np.int32)
    sizes = np.diff(offsets)
    begin, end = offsets[:-1][sizes >= window], offsets[1:][sizes >= window] - window + 1
    np.add.at(inside, begin, 1)
    np.add.at(inside, end, -1)
    return grams, least, np.cumsum(inside)[:len(least)] > 0


def chosen_grams(data: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """Text, hash and number of places of the grams that are the least of a window."""
    grams, least, inside = least_grams(data, offsets, window, gram)
    width = window - gram + 1
    around = np.concatenate([np.zeros(width - 1, np.uint64), np.where(inside, least, np.uint64(0)), np.zeros(width - 1, np.uint64)])
    places = np.flatnonzero(sliding(around, width, np.maximum, 0)[:len(grams)] == grams)
    owner, found = np.searchsorted(offsets, places, side="right") - 1, grams[places]
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    first = np.ones(len(order), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])
    return owner[first], found[first], np.diff(np.append(np.flatnonzero(first), len(order)))


def grams_of(docs: DataFrame, window: int, gram: int, words: bool) -> DataFrame:
    """doc, gram, n: the least grams of each text and the number of their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=PART):
                data, offsets = units_of(part.column("text"), words)
                if len(data) >= window:
                    owner, found, n = chosen_grams(data, offsets, window, gram)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc").take(pa.array(owner)), pa.array(found.view(np.int64)), pa.array(n.astype(np.int32))], ["doc", "gram", "n"])

    return in_tasks(docs, run, "doc struct<id:long,tie:long>, gram long, n int")


PACKET_FIELDS = pa.schema([
    ("packet", pa.string()), ("docs", pa.list_(pa.struct([("id", pa.int64()), ("tie", pa.int64())]))),
    ("owner", pa.list_(pa.int32())), ("start", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())), ("data", pa.binary())])


def packets_of(docs: DataFrame, window: int, gram: int, words: bool) -> DataFrame:
    """packet; docs; for each stretch its document, first place and number of windows; data.

    ``docs`` has the grams that stand at two places: ``shared``.
    """

    def stretches(part: pa.RecordBatch):
        data, offsets = units_of(part.column("text"), words)
        if len(data) < window:
            return
        _, least, inside = least_grams(data, offsets, window, gram)
        for k, (doc, shared) in enumerate(zip(part.column("doc").to_pylist(), part.column("shared"))):
            begin, end = int(offsets[k]), int(offsets[k + 1]) - window + 1
            if end <= begin:
                continue
            hit = np.isin(least[begin:end], shared.values.to_numpy().view(np.uint64))
            edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]))).reshape(-1, 2)
            yield doc, edges, [data[begin + a:begin + b + window - 1].tobytes() for a, b in edges]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def packet() -> pa.RecordBatch:
            edges = [e for _, e, _ in held]
            row = {
                "packet": uuid.uuid4().hex, "docs": [d for d, _, _ in held],
                "owner": np.repeat(np.arange(len(held)), [len(e) for e in edges]).tolist(),
                "start": np.concatenate(edges)[:, 0].tolist(), "n": np.diff(np.concatenate(edges), axis=1)[:, 0].tolist(),
                "data": b"".join(x for _, _, texts in held for x in texts)}
            return pa.RecordBatch.from_pylist([row], PACKET_FIELDS)

        for batch in batches:
            for part in slices(batch, limit=PART):
                for doc, edges, texts in stretches(part):
                    more = sum(map(len, texts))
                    if held and size + more > PACKET:
                        yield packet()
                        held, size = [], 0
                    if len(edges):
                        held.append((doc, edges, texts))
                        size += more
        if held:
            yield packet()

    return in_tasks(docs, run, "packet string, docs array<struct<id:long,tie:long>>, owner array<int>, start array<long>, n array<long>, data binary")


def run_of(data: bytes, n: np.ndarray, window: int, words: bool):
    """The sorted keys of a packet's suffixes, their numbers, and the key of each suffix."""
    text = np.frombuffer(data, np.uint64 if words else np.uint8)
    begins = np.cumsum(n + window - 1) - (n + window - 1)
    places = np.repeat(begins - (np.cumsum(n) - n), n) + np.arange(n.sum())
    return np.unique(hashes_at(text, places, window), return_inverse=True, return_counts=True)


def front_coded(keys: np.ndarray) -> bytes:
    """Sorted keys without the leading bytes each shares with the one before: the numbers of
    these, then what is left."""
    signs = keys.astype(">u8").view(np.uint8).reshape(-1, 8)
    same = np.zeros(len(keys), np.uint8)
    differs = signs[1:] != signs[:-1]
    same[1:] = differs.argmax(axis=1)
    return same.tobytes() + signs[np.arange(8) >= same[:, None]].tobytes()


def front_decoded(run: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys, and how many leading bytes each shares with the one before."""
    same = np.frombuffer(run, np.uint8, n)
    own = np.arange(8) >= same[:, None]
    signs = np.zeros((n, 8), np.uint8)
    signs[own] = np.frombuffer(run, np.uint8, offset=n)
    for k in range(8):  # a shared byte is that of the last entry which has its own there
        last = np.maximum.accumulate(np.where(own[:, k], np.arange(n), 0))
        signs[:, k] = signs[last, k]
    return signs.reshape(-1).view(">u8").astype(np.uint64), same


#: Bytes that two keys share, by the size of their difference.
STEPS = np.array([1 << (8 * k) for k in range(8)], np.uint64)


class LoserTrees:
    """Merges sorted runs, in many lanes (ranges of the key) at once.

    Each lane has a tree over the runs; a node holds the run that lost there. Every run's head
    knows how many bytes it shares with the key put out last in its lane. Of two heads the one
    that shares more is the smaller, and no byte is looked at; if they share as many, the bytes
    after these decide, and the loser then knows what it shares with the winner. A run's next
    head shares with the key put out what its front coding says.
    """

    def __init__(self, runs: list[tuple[np.ndarray, np.ndarray]], first: int, bits: int):
        """``runs``: keys and shared bytes; all keys begin with the ``bits`` bits ``first``."""
        sizes = [len(k) for k, _ in runs]
        self.keys = np.concatenate([*(k for k, _ in runs), np.zeros(1, np.uint64)])
        self.same = np.concatenate([*(s for _, s in runs), np.zeros(1, np.uint8)]).astype(np.int8)
        more = min(12, max(0, (sum(sizes) // 512).bit_length()))
        self.n_lanes, self.width = 1 << more, max(2, 1 << (len(runs) - 1).bit_length())
        shift = 64 - bits - more
        borders = ((np.arange(self.n_lanes, dtype=np.uint64) + np.uint64(first << more)) << np.uint64(shift))
        self.at = np.zeros((self.n_lanes, self.width), np.int64)
        self.end = self.at.copy()
        for r, (begin, (keys, _)) in enumerate(zip(np.cumsum(sizes) - sizes, runs)):
            edges = begin + np.append(np.searchsorted(keys, borders), len(keys))
            self.at[:, r], self.end[:, r] = edges[:-1], edges[1:]
        self.at, self.end = self.at.ravel(), self.end.ravel()
        self.shared = np.where(self.at < self.end, 0, -1).astype(np.int8)  # -1: the run is used up
        self.head = self.keys[np.where(self.at < self.end, self.at, len(self.keys) - 1)]

    def play(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The smaller and the larger of two heads in each lane; places are lane times width plus run."""
        known_x, known_y = self.shared[x], self.shared[y]
        key_x, key_y = self.head[x], self.head[y]
        tied = known_x == known_y
        x_wins = np.where(tied, key_x <= key_y, known_x > known_y)
        winner, loser = np.where(x_wins, x, y), np.where(x_wins, y, x)
        tied &= known_x >= 0
        self.shared[loser[tied]] = 8 - np.searchsorted(STEPS, (key_x ^ key_y)[tied], side="right")
        return winner, loser

    def equal_keys(self) -> np.ndarray:
        """For each entry of the runs, whether another run has its key."""
        width, marks = self.width, np.zeros(len(self.keys), bool)
        lanes = np.arange(self.n_lanes) * width
        best = [None] * width + [lanes + r for r in range(width)]
        losers = np.zeros((width, self.n_lanes), np.int64)
        for node in range(width - 1, 0, -1):
            best[node], losers[node] = self.play(best[2 * node], best[2 * node + 1])
        champion, last = best[1], np.full(self.n_lanes, len(self.keys) - 1)
        lane = np.arange(self.n_lanes)
        while True:
            alive = self.shared[champion] >= 0
            if not alive.all():
                champion, lane, last = champion[alive], lane[alive], last[alive]
            if not len(lane):
                return marks[:-1]
            out = self.at[champion]
            again = self.shared[champion] == 8
            marks[out[again]] = marks[last[again]] = True
            last = out
            self.at[champion] = out + 1
            left = out + 1 < self.end[champion]
            self.head[champion] = self.keys[out + 1]
            self.shared[champion] = np.where(left, self.same[out + 1], -1)
            node = (champion % width + width) >> 1
            while node[0]:
                champion, losers[node, lane] = self.play(champion, losers[node, lane])
                node >>= 1


def marked(packets: DataFrame, ranges: int, window: int, words: bool) -> DataFrame:
    """packet, marks: for each packet the marks of its run, in pieces by range."""
    bits = ranges.bit_length() - 1

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, n, data in zip(batch.column("packet"), batch.column("n"), batch.column("data")):
                keys = run_of(data.as_py(), n.values.to_numpy(), window, words)[0]
                which = (keys >> np.uint64(64 - bits)).astype(np.int64)
                edges = np.searchsorted(which, np.arange(ranges + 1))
                rows = [(k, a, b) for k, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
                yield pa.RecordBatch.from_arrays([
                    pa.array([k for k, _, _ in rows], pa.int32()), pa.array([name.as_py()] * len(rows), pa.string()),
                    pa.array([b - a for _, a, b in rows], pa.int32()), pa.array([front_coded(keys[a:b]) for _, a, b in rows], pa.binary())],
                    ["range", "packet", "n", "run"])

    def merge(table: pa.Table) -> pa.Table:
        runs = [front_decoded(r.as_py(), n.as_py()) for r, n in zip(table["run"], table["n"])]
        twice = LoserTrees(runs, table["range"][0].as_py(), bits).equal_keys()
        marks = [np.packbits(m).tobytes() for m in np.split(twice, np.cumsum([len(k) for k, _ in runs])[:-1])]
        return pa.table({"range": table["range"], "packet": table["packet"], "marks": pa.array(marks, pa.binary())})

    sent = in_tasks(packets.select("packet", "n", "data"), send, "range int, packet string, n int, run binary")
    found = sent.groupBy("range").applyInArrow(merge, "range int, packet string, marks binary")
    return found.groupBy("packet").agg(F.sort_array(F.collect_list(F.struct("range", "marks"))).alias("marks"))


def union_of(starts: np.ndarray, window: int) -> list[dict]:
    """The maximal runs of bytes that the windows from these places, in order, cover."""
    first = np.ones(len(starts), bool)
    first[1:] = starts[1:] > starts[:-1] + window
    last = np.append(first[1:], True)
    return [{"from": int(a), "to": int(b) + window} for a, b in zip(starts[first], starts[last])]


def spans_in(packets: DataFrame, ranges: int, window: int, words: bool) -> DataFrame:
    """doc, removed: the ranges (bytes or words) of each document that marked windows cover. ``packets``
    has the marks."""
    bits = ranges.bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                n = batch.column("n")[row].values.to_numpy()
                keys, each, counts = run_of(batch.column("data")[row].as_py(), n, window, words)
                which = (keys >> np.uint64(64 - bits)).astype(np.int64)
                twice = counts > 1
                for piece in batch.column("marks")[row].as_py():
                    a, b = np.searchsorted(which, [piece["range"], piece["range"] + 1])
                    twice[a:b] |= np.unpackbits(np.frombuffer(piece["marks"], np.uint8), count=b - a).astype(bool)
                start, owner = (batch.column(c)[row].values.to_numpy() for c in ("start", "owner"))
                places = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
                hit = twice[each]
                places, whose = places[hit], np.repeat(owner, n)[hit]
                docs = batch.column("docs")[row].as_py()
                edges = np.searchsorted(whose, np.arange(len(docs) + 1))
                rows = [{"doc": d, "removed": union_of(places[a:b], window)} for d, a, b in zip(docs, edges, edges[1:]) if b > a]
                yield pa.RecordBatch.from_pylist(rows, SPANS)

    return in_tasks(packets, run, "doc struct<id:long,tie:long>, removed array<struct<from:long,to:long>>")


SPANS = pa.schema([("doc", pa.struct([("id", pa.int64()), ("tie", pa.int64())])),
                   ("removed", pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())])))])


def small(frame: DataFrame, entries: str | None = None) -> DataFrame:
    """The stored table, to be broadcast if its rows and list entries are few."""
    rows, held = frame.agg(F.count("*"), F.coalesce(F.sum(F.size(entries)) if entries else F.lit(0), F.lit(0))).first()
    return F.broadcast(frame) if rows <= BROADCAST_ROWS and held <= BROADCAST_ENTRIES else frame


def spans_of(texts: DataFrame, window: int, gram: int, words: bool = False) -> DataFrame:
    """doc, removed: the ranges of each text that repeated strings of ``window`` bytes or words
    cover; ``texts`` (doc, text) has no copies. Stored, a row for each text with ranges."""
    grams = stored(grams_of(texts, window, gram, words), "grams")
    twice = grams.groupBy("gram").agg(F.sum("n").alias("places")).where("places > 1").select("gram")
    shared = stored(grams.join(twice, "gram").groupBy("doc").agg(F.collect_set("gram").alias("shared")), "shared")
    packets = stored(packets_of(texts.join(small(shared, "shared"), "doc"), window, gram, words), "packets")
    total = packets.agg(F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    ranges = max(LEAST_RANGES, 1 << (total // RANGE).bit_length())
    marks = stored(marked(packets, ranges, window, words), "marks")
    return stored(spans_in(packets.join(marks, "packet"), ranges, window, words).dropDuplicates(["doc"]), "spans")


def repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text", passage: int = 0) -> DataFrame:
    """doc_id, text, removed: the byte ranges (from, to) of each text that repeated strings of
    ``window`` bytes cover, in order, none touching the next; a row for each row of ``docs``.

    A string is repeated if it also starts at another place of any row's text, the same one
    included; repeated rows are copies of each other. A null text is empty; texts shorter than
    ``window`` bytes have none. Other columns are not read.

    With ``passage``, a column passages follows: the ranges of words, counted from 0, that
    repeated strings of so many words cover, whatever white space stands between them.
    """
    rows = docs.select(
        F.struct(F.col(doc_id).cast("long").alias("id"), F.xxhash64(text).alias("tie")).alias("doc"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = F.octet_length("text")
    least = min(window, 2 * passage - 1) if passage else window
    long = rows.where(size >= least)
    classes = long.groupBy(F.md5("text").alias("digest")).agg(F.min("doc").alias("first"), F.count("*").alias("copies"))
    copies = small(stored(classes.where("copies > 1").select("digest", "first"), "copies"))
    single = long.withColumn("digest", F.md5("text")).join(copies, "digest", "left").where(F.col("first").isNull() | (F.col("first") == F.col("doc")))
    single = single.select("doc", "text")

    def ranges(found: str, length: Column, least: int) -> Column:
        whole = F.array(F.struct(F.lit(0).cast("long").alias("from"), length.cast("long").alias("to")))
        return F.when(F.col("first").isNotNull() & (length >= least), whole).otherwise(F.coalesce(found, F.array().cast("array<struct<from:long,to:long>>")))

    found = rows.join(small(spans_of(single.where(size >= window), window, gram), "removed"), "doc", "left")
    columns = [F.col("doc.id").alias("doc_id"), "text", ranges("removed", size, window).alias("removed")]
    if passage:
        spans = spans_of(single, passage, max(1, passage // 2), words=True).withColumnRenamed("removed", "passages")
        found = found.join(small(spans, "passages"), "doc", "left")
        columns.append(ranges("passages", F.regexp_count("text", F.lit(WORD)), passage).alias("passages"))
    return found.withColumn("digest", F.when(size >= least, F.md5("text"))).join(copies, "digest", "left").select(*columns)


def outside(text: str, removed: list[dict]) -> bytes:
    """The bytes of the text outside the removed ranges."""
    data, at, parts = text.encode(), 0, []
    for span in removed:
        parts.append(data[at:span["from"]])
        at = span["to"]
    return b"".join([*parts, data[at:]])


def cut(found: DataFrame) -> DataFrame:
    """doc_id, kept: the bytes of each text that are left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=PART):
                kept = [outside(t.as_py(), r.as_py()) for t, r in zip(part.column("text"), part.column("removed"))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(kept, pa.binary())], ["doc_id", "kept"])

    return in_tasks(found, run, "doc_id long, kept binary")


def digest(docs: DataFrame, passage: int = 0) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, and the hash of the bytes that are left; with
    ``passage``, also the number of repeated passages of so many words or more and of their words."""
    counts = ["n_passages", "n_passage_words"] if passage else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=PART):
                kept = [outside(t.as_py(), r.as_py()) for t, r in zip(part.column("text"), part.column("removed"))]
                yield pa.RecordBatch.from_arrays([
                    *(part.column(c) for c in ("doc_id", "n_bytes", "n_spans", *counts)), pa.array([len(x) for x in kept], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())], ["doc_id", "n_bytes", "n_spans", *counts, "n_kept", "kept_sha256"])

    found = repeats(docs, passage=passage) if passage else repeats(docs)
    found = found.withColumns({"n_bytes": F.octet_length("text").cast("long"), "n_spans": F.size("removed").cast("long")})
    if passage:
        n_words = F.aggregate("passages", F.lit(0).cast("long"), lambda a, x: a + x["to"] - x["from"])
        found = found.withColumns({"n_passages": F.size("passages").cast("long"), "n_passage_words": n_words}).drop("passages")
    left = in_tasks(found, run, f"doc_id long, n_bytes long, n_spans long, {''.join(f'{c} long, ' for c in counts)}n_kept long, kept_sha256 string")
    return left.select("doc_id", "n_bytes", (F.col("n_bytes") - F.col("n_kept")).alias("n_removed"), "n_spans", "kept_sha256", *counts)
