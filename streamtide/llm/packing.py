"""Packing of tokenised documents: harmonic classes, and cut documents in what they leave free.

A document is its ids and an end id. Full sequences are cut from its front; what remains, of
length r, is of class j = capacity // r, so that j remainders of a class fit into one sequence,
and each sequence of class j takes exactly j of them, whichever they are. (The last class has
all shorter remainders, so many a sequence as its number says.) A class leaves up to a j+1-th of
its sequences free. That is filled by cutting: the remainders of the first classes, which would
leave most free themselves, are laid end to end along the free places, and what is over along
new sequences. As few classes are cut as are needed to fill all that the others leave. The very
last sequence is laid out as sequences whose lengths are powers of two, which need no padding.

Nothing is compared between workers: a task packs its own documents, ``BLOCK`` ids at a time,
and numbers its sequences in a range of its own. There is no shuffle. The same rows in the same
partitions give the same sequences, so a task that runs again returns what it did before.

Tokenising costs most. Ids depend on words alone, so a text is split where the tokenizer is sure
to split it, each different word is encoded once, and a worker remembers them, up to ``WORDS``.
Where the tokenizer lower-cases, words of ASCII and Latin-1 letters are lower-cased first, and of
those that are all letters its model makes the ids: the rules before it leave them as they are.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from typing import TYPE_CHECKING, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamtide.llm.common import LOWER, as_bytes, in_tasks, slices, span_hashes

if TYPE_CHECKING:
    from tokenizers import Tokenizer

CAPACITY = 2048
CLASSES = 32
#: Ids that are packed together: 4 bytes each, and as much again for the texts.
BLOCK = 4_000_000
#: Words that a worker remembers, some 200 bytes each; then it begins anew.
WORDS = 400_000
#: New words are encoded as one text, so many at a time, with this sign between them: a call and
#: its result for each word cost as much as the encoding.
TOGETHER = 256
MARK = b"|"

#: Rules under which words of ASCII and Latin-1 letters have the ids of their lower case, and words
#: of small letters of these reach the model unchanged and whole.
LOWERING = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTING = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

#: Kinds of bytes: blank, letter, digit, other sign; the rest (control characters, bytes outside
#: ASCII) is never parted from its neighbours: it may join them, or a class that they have.
BLANK, LETTER, DIGIT, SIGN, GLUE = range(5)


def kinds() -> np.ndarray:
    kind = np.full(256, GLUE, np.uint8)
    kind[33:127] = SIGN
    kind[48:58] = DIGIT
    kind[65:91] = kind[97:123] = LETTER
    kind[[9, 10, 13, 32]] = BLANK
    return kind


KIND = kinds()
#: The letters of Latin-1 outside ASCII are the byte LEAD and one of SECOND, two signs left out.
LEAD = 0xC3
SECOND = np.zeros(256, bool)
SECOND[0x80:0xC0] = True
SECOND[[0x97, 0xB7]] = False
SMALL = re.compile(rb"(?:[a-z]|\xc3[\x9f\xa0-\xb6\xb8-\xbf])+")
APOSTROPHE = 39


class Pieces(NamedTuple):
    """Of each piece the document, the first id and the number of ids, its sequence and place."""

    doc: np.ndarray
    start: np.ndarray
    length: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def powers_of_two(n: int) -> list[int]:
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def cut_classes(of_class: np.ndarray, rest: np.ndarray, capacity: int, classes: int) -> int:
    """The least number of first classes whose ids fill what the sequences of the others leave."""
    members = np.bincount(of_class, minlength=classes + 1)
    ids = np.bincount(of_class, rest, minlength=classes + 1).astype(np.int64)
    number = np.arange(classes + 1)
    sequences = -(-members // np.maximum(number, 1))
    free = sequences * capacity - ids
    for last in range(classes + 1):
        if ids[1:last + 1].sum() >= free[last + 1:].sum():
            return last
    return classes


def pack_lengths(lengths: np.ndarray, capacity: int = CAPACITY, classes: int = CLASSES) -> Pieces:
    """Packs documents of these lengths (1 at least); every sequence is full but for the last
    ones, whose lengths are powers of two."""
    lengths = lengths.astype(np.int64)
    docs = np.arange(len(lengths))
    full = lengths // capacity
    doc = np.repeat(docs, full)
    first = np.cumsum(full) - full
    start = (np.arange(len(doc)) - np.repeat(first, full)) * capacity
    parts = [Pieces(doc, start, np.full(len(doc), capacity), np.arange(len(doc)), np.zeros(len(doc), np.int64))]
    used = len(doc)

    docs = docs[lengths % capacity > 0]
    rest = lengths[docs] % capacity
    begin = lengths[docs] - rest
    of_class = np.minimum(capacity // np.maximum(rest, 1), classes)
    last = cut_classes(of_class, rest, capacity, classes)

    holes = []  # sequence, place, size
    for j in range(last + 1, classes + 1):
        own = np.flatnonzero(of_class == j)
        if not len(own):
            continue
        sequence = np.arange(len(own)) // j
        ends = np.cumsum(rest[own])
        before = ends - rest[own]
        offset = before - before[sequence * j]
        parts.append(Pieces(docs[own], begin[own], rest[own], used + sequence, offset))
        filled = np.bincount(sequence, rest[own]).astype(np.int64)
        holes.append((used + np.arange(len(filled)), filled, capacity - filled))
        used += len(filled)

    cut = np.flatnonzero((of_class <= last) & (rest > 0))
    left = int(rest[cut].sum()) - sum(int(size.sum()) for _, _, size in holes)
    new = [capacity] * (left // capacity) + powers_of_two(left % capacity)
    holes.append((used + np.arange(len(new)), np.zeros(len(new), np.int64), np.array(new, np.int64)))
    hole, place, size = (np.concatenate(x) for x in zip(*holes))
    some = size > 0
    parts.append(laid(docs[cut], begin[cut], rest[cut], hole[some], place[some], size[some]))
    return Pieces(*(np.concatenate(x) for x in zip(*parts)))


def laid(doc: np.ndarray, begin: np.ndarray, length: np.ndarray, hole: np.ndarray, place: np.ndarray, size: np.ndarray) -> Pieces:
    """The documents end to end along the holes, which they fill exactly; cut where either ends."""
    doc_ends, hole_ends = np.cumsum(length), np.cumsum(size)
    ends = np.union1d(doc_ends, hole_ends)
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1]])[:len(ends)]
    d = np.searchsorted(doc_ends, starts, side="right")
    h = np.searchsorted(hole_ends, starts, side="right")
    return Pieces(doc[d], begin[d] + starts - (doc_ends - length)[d], ends - starts, hole[h], place[h] + starts - (hole_ends - size)[h])


class Encoder:
    """Ids of texts, as the tokenizer with this definition gives them without special tokens."""

    known: dict[int, Encoder] = {}

    def __init__(self, definition: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(definition)
        self.marks = [str(t).encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words: dict[bytes, bytes] = {}
        mark = self.ids(MARK.decode())
        self.mark = mark[0] if len(mark) == 1 else None
        rules = json.loads(definition)
        self.letters = None
        if rules["normalizer"] == LOWERING and rules["pre_tokenizer"] == SPLITTING:
            self.letters = Tokenizer.from_str(definition)  # for words of small letters
            self.letters.normalizer = None
            self.letters.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])

    @classmethod
    def of(cls, definition: str) -> Encoder:
        key = zlib.crc32(definition.encode()) << 32 | len(definition)
        if key not in cls.known:
            cls.known[key] = cls(definition)
        return cls.known[key]

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def kinds_of(self, data: np.ndarray) -> np.ndarray:
        """The kind of each byte; letters of Latin-1 are letters if the rules are known."""
        kind = KIND[data]
        if self.letters is not None:
            lead = np.flatnonzero(data[:-1] == LEAD)
            lead = lead[SECOND[data[lead + 1]]]
            kind[lead] = kind[lead + 1] = LETTER
        return kind

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where words begin and end: at blanks, at the borders of texts, and between two signs
        of ASCII of different kinds, but for an apostrophe and the letters after it."""
        kind = self.kinds_of(data)
        dark = kind != BLANK
        parted = np.zeros(len(data) + 1, bool)
        parted[offsets] = True
        one, two = kind[:-1], kind[1:]
        between = (one != two) & (one != GLUE) & (two != GLUE) & ~((data[:-1] == APOSTROPHE) & (two == LETTER))
        parted[1:-1] |= between | (one == BLANK) | (two == BLANK)
        starts = np.flatnonzero(dark & parted[:-1])
        ends = np.flatnonzero(dark & parted[1:]) + 1
        return starts, ends

    def lowered(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The bytes with the words of ASCII and Latin-1 letters in lower case, if they have the same
        ids so; in other words an accent may join a capital and not its small letter."""
        if self.letters is None:
            return data
        letter = self.kinds_of(data) == LETTER
        others = np.concatenate([np.zeros(1, np.int64), np.cumsum((data >= 128) & ~letter)])
        kept = others[ends] > others[starts]
        inside = np.zeros(len(data) + 1, np.int8)
        inside[starts[kept]] += 1
        inside[ends[kept]] -= 1
        low = LOWER[data]
        low[letter & (data >= 0x80) & (data <= 0x9E)] += 0x20
        return np.where(np.cumsum(inside[:-1]) > 0, data, low)

    def pieces_of(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, 4 bytes each."""
        if len(self.words) > WORDS:
            self.words.clear()
        new = [w for w in words if w not in self.words]
        for tokenizer, fits in ((self.letters, SMALL.fullmatch), (self.tokenizer, lambda w: MARK not in w)):
            if tokenizer is None or self.mark is None:
                continue
            some = [w for w in new if fits(w)]
            for at in range(0, len(some), TOGETHER):
                self.words.update(self.together(some[at:at + TOGETHER], tokenizer))
            new = [w for w in new if w not in self.words]
        for word, found in zip(new, self.tokenizer.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)):
            self.words[word] = np.array(found.ids, np.uint32).tobytes()
        return [self.words[w] for w in words]

    def together(self, words: list[bytes], tokenizer: Tokenizer | None = None) -> dict[bytes, bytes]:
        """The ids of words encoded as one text, with marks between them; none if the ids do not
        have just these marks."""
        text = (b" " + MARK + b" ").join(words).decode()
        ids = np.array((tokenizer or self.tokenizer).encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        marks = np.flatnonzero(ids == self.mark)
        if len(marks) != len(words) - 1:
            return {}
        raw = ids.tobytes()
        begins, ends = [0, *(4 * marks + 4).tolist()], [*(4 * marks).tolist(), len(raw)]
        return {w: raw[a:b] for w, a, b in zip(words, begins, ends)}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and the number of each; null is empty."""
        data, offsets = as_bytes(texts)
        raw = data.tobytes()
        if any(mark in raw for mark in self.marks):  # such a text may hold what stands for one id
            each = [self.ids(t or "") for t in texts.to_pylist()]
            return np.concatenate([np.zeros(0, np.uint32), *each]), np.array([len(x) for x in each], np.int64)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        starts, ends = self.spans(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        data = self.lowered(data, starts, ends)
        raw = data.tobytes()
        _, first, back = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        sizes = ends - starts
        flat = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        like = flat + np.repeat(starts[first[back]] - starts, sizes)
        if (sizes == sizes[first[back]]).all() and (data[flat] == data[like]).all():
            words = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        else:  # two words have one hash
            words, back = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())], np.arange(len(starts))
        found = self.pieces_of(words)
        pool = np.frombuffer(b"".join(found), np.uint32)
        counts = np.array([len(x) // 4 for x in found], np.int64)
        begins, counts = (np.cumsum(counts) - counts)[back], counts[back]
        total = np.cumsum(counts)
        ids = pool[np.repeat(begins - (total - counts), counts) + np.arange(total[-1])]
        before = np.concatenate([np.zeros(1, np.int64), total])[np.searchsorted(starts, offsets)]
        return ids, np.diff(before)


def blocks(batches: Iterator[pa.RecordBatch], encoder: Encoder, end_id: int):
    """Document ids, token ids end to end and lengths, up to BLOCK token ids or one document."""
    names, ids, lengths, size = [], [], [], 0
    for batch in batches:
        for part in slices(batch):
            own, counts = encoder.encode(part.column("text"))
            with_end = np.insert(own, np.cumsum(counts), end_id).astype(np.uint32)
            names.append(part.column("doc_id"))
            ids.append(with_end)
            lengths.append(counts + 1)
            size += len(with_end)
            if size >= BLOCK:
                yield pa.concat_arrays(names), np.concatenate(ids), np.concatenate(lengths)
                names, ids, lengths, size = [], [], [], 0
    if names:
        yield pa.concat_arrays(names), np.concatenate(ids), np.concatenate(lengths)


def checksums(ids: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    raw = memoryview(np.ascontiguousarray(ids.astype("<u4"))).cast("B")
    return np.array([zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist())], np.int64)


PIECES = "doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, classes: int = CLASSES, end_id: int = 1,
         doc_id: str = "doc_id", text: str = "text", with_ids: bool = True) -> DataFrame:
    """One row for each piece: doc_id, start, length, doc_tokens, sequence_id, offset, and ids or,
    if these are not wanted, ids_crc32 (of the ids as little-endian unsigned 32-bit numbers).

    ``tokenizer_file`` is read by the driver and travels with the tasks; its tokenizer must
    split words as the one of this module's queries does (blanks, letters, single digits, other
    signs). Null and empty texts are the end id alone. Repeated rows, and rows without an id,
    are documents of their own. No rows give no rows. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    with open(tokenizer_file, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = TaskContext.get().partitionId() << 33
        for names, ids, lengths in blocks(batches, Encoder.of(definition.value), end_id):
            pieces = pack_lengths(lengths, capacity, classes)
            first = (np.cumsum(lengths) - lengths)[pieces.doc] + pieces.start
            for at in range(0, len(first), 10_000):
                some = Pieces(*(x[at:at + 10_000] for x in pieces))
                yield piece_batch(names, ids, lengths, some, first[at:at + 10_000], next_id, with_ids)
            next_id += int(pieces.sequence.max()) + 1

    kind = rows.schema["doc_id"].dataType.simpleString()
    return in_tasks(rows, run, PIECES.format(kind=kind) + (", ids array<int>" if with_ids else ", ids_crc32 long"))


def piece_batch(names: pa.Array, ids: np.ndarray, lengths: np.ndarray, pieces: Pieces, first: np.ndarray, next_id: int, with_ids: bool) -> pa.RecordBatch:
    columns = {
        "doc_id": names.take(pa.array(pieces.doc)), "start": pa.array(pieces.start), "length": pa.array(pieces.length),
        "doc_tokens": pa.array(lengths[pieces.doc]), "sequence_id": pa.array(next_id + pieces.sequence), "offset": pa.array(pieces.offset),
    }
    if with_ids:
        ends = np.cumsum(pieces.length)
        flat = np.repeat(first - (ends - pieces.length), pieces.length) + np.arange(ends[-1] if len(ends) else 0)
        columns["ids"] = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids[flat].astype(np.int32)))
    else:
        columns["ids_crc32"] = pa.array(checksums(ids, first, pieces.length))
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def sequences(pieces: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """sequence_id, n_ids, ids: the pieces of ``pack`` put together, padded to the capacity unless
    their length is a power of two. A sequence has at most ``capacity`` pieces."""
    own = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = pieces.groupBy("sequence_id").agg(own.alias("own")).select("sequence_id", F.flatten("own.ids").alias("ids"))
    n = F.size("ids")
    padding = F.when(F.bit_count(n) == 1, 0).otherwise(F.lit(capacity) - n)
    return joined.select("sequence_id", n.cast("long").alias("n_ids"), F.concat("ids", F.array_repeat(F.lit(pad_id), padding)).alias("ids"))


def digest(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    return pack(docs, tokenizer_file, with_ids=False).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
