"""SentencePiece encoding and decoding as a weighted finite-state transducer.

The machine is the normaliser (a leading space, spaces as piece marks), then the pieces as
weighted arcs from bytes to ids, and arcs for the bytes of characters without a piece.
Composed with a text it is a lattice over the text's bytes, and the encoding is the path of
least total cost (tropical semiring); costs are the negated scores of the model. No piece
runs over the beginning of a new word, so the lattice of a text is a chain of word lattices:
each different word of a chunk is solved once, all of them at once, place by place. Decoding
runs the ids through the inverted machine.

The scores of a model built by merges rank its merges and say nothing about a path on their
own. Its machine gets a second weight, on neighbouring pieces: 0 if the merges leave the two
apart when applied to them, else infinite. One path then has a finite cost, the one that the
merges make, so the state is still the place in the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from streamtide.llm.common import BASE, INVERSE, SYMBOLS, in_tasks, mixed, powers, slices, span_hashes

#: Words of more bytes are solved one by one, so that a chunk's tables stay small.
LONG = 48
MARK = "▁"
#: Extra cost of a fallback byte over the dearest piece.
PENALTY = 10.0
#: Bytes of text taken apart at once: the more, the fewer words are solved twice.
PART = 2_000_000
#: Words solved at once, and the ids that a process keeps of solved words.
BLOCK = 8_192
FULL = 2_000_000
FILTER_BITS = 20
LENGTHS = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Machine:
    """Pieces as bytes (a space for the mark) by id; ``costs`` of the arcs; ids of the bytes."""

    pieces: list[bytes]
    costs: np.ndarray
    byte_ids: np.ndarray
    byte_cost: float
    arcs: dict[bytes, int]
    leading_space: bool
    merges: bool
    name: str

    def by_hash(self):
        """Hashes in order with their ids, and a bit table that most non-pieces fail."""
        texts = list(self.arcs)
        ends = np.cumsum([len(x) for x in texts])
        starts = ends - np.array([len(x) for x in texts])
        hashes = span_hashes(np.frombuffer(b"".join(texts), np.uint8), starts, ends)
        order = np.argsort(hashes)
        table = np.zeros(1 << FILTER_BITS, bool)
        table[hashes >> np.uint64(64 - FILTER_BITS)] = True
        return hashes[order], np.array(list(self.arcs.values()))[order], table, sorted({len(x) for x in texts}, reverse=True)


def load(model_file: str) -> Machine:
    """The machine of a model with byte fallback and the identity as character map."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(model_file, "rb") as file:
        proto.ParseFromString(file.read())
    spec = proto.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
        raise ValueError("only models that keep characters and white space as they are")
    sp = SentencePieceProcessor(model_file=model_file)
    n = sp.get_piece_size()
    names = [sp.id_to_piece(i) for i in range(n)]
    is_byte = [sp.is_byte(i) for i in range(n)]
    if sum(is_byte) != 256:
        raise ValueError("only models with byte fallback")
    silent = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
    pieces = [bytes([int(x[1:-1], 16)]) if b else b"" if s else x.replace(MARK, " ").encode()
              for x, b, s in zip(names, is_byte, silent)]
    arcs = {pieces[i]: i for i in reversed(range(n)) if pieces[i] and not is_byte[i]}
    if any(b" " in piece.lstrip(b" ") for piece in arcs):
        raise ValueError("only models whose pieces end where a word ends")
    costs = np.array([-sp.get_score(i) for i in range(n)])
    byte_ids = np.zeros(256, np.int32)
    for i in range(n):
        if is_byte[i]:
            byte_ids[pieces[i][0]] = i
    return Machine(pieces, costs, byte_ids, max(costs[i] for i in arcs.values()) + PENALTY, arcs, spec.add_dummy_prefix,
                   proto.trainer_spec.model_type == proto.trainer_spec.BPE, hashlib.sha256(proto.SerializeToString()).hexdigest())


def normalised(text: str | None, leading_space: bool = True) -> bytes:
    """The bytes the lattice is built over, a space for each mark."""
    if not text:
        return b""
    return (b" " if leading_space else b"") + text.replace(MARK, " ").encode()


class Neighbours:
    """Whether two pieces may stand side by side; the last million answers are kept."""

    def __init__(self, machine: Machine):
        self.pieces = machine.pieces
        self.ranks = {piece: float(machine.costs[k]) for piece, k in machine.arcs.items()}
        self.codes = np.full(1 << 20, -1, np.int64)
        self.answers = np.zeros(1 << 20, bool)

    def apart(self, left: int, right: int) -> bool:
        """Makes the cheapest merge, the leftmost of equals, again and again; none must cross the border."""
        before, after = (list(self.pieces[k].decode()) for k in (left, right))
        parts = [c.encode() for c in before + after]
        border, none = len(before) - 1, np.inf
        ranks = [self.ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
        while (best := min(ranks)) < none:
            i = ranks.index(best)
            if i == border:
                return False
            border -= i < border
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = self.ranks.get(parts[i - 1] + parts[i], none)
            if i < len(ranks):
                ranks[i] = self.ranks.get(parts[i] + parts[i + 1], none)
        return True

    def allowed(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For pairs of ids; an id beyond the pieces (the start, a character without piece) goes with any."""
        n = len(self.pieces)
        codes = np.where(left >= n, -2, left.astype(np.int64) * n + right)
        slots = mixed(codes.view(np.uint64)) >> np.uint64(44)
        answers = self.answers[slots] | (codes == -2)
        new = (self.codes[slots] != codes) & (codes != -2)
        if new.any():
            fresh, same = np.unique(codes[new], return_inverse=True)
            found = np.array([self.apart(int(c) // n, int(c) % n) for c in fresh])
            answers[new] = found[same]
            self.codes[slots[new]], self.answers[slots[new]] = codes[new], found[same]
        return answers


_neighbours: dict[str, Neighbours] = {}


def neighbours(machine: Machine) -> Neighbours:
    """One table for each worker process and model."""
    if machine.name not in _neighbours:
        _neighbours.clear()
        _neighbours[machine.name] = Neighbours(machine)
    return _neighbours[machine.name]


def width_of(lead: int) -> int:
    """Bytes of the character that begins with this byte; 0 within a character."""
    return 1 if lead < 0x80 else 0 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4


WIDTHS = np.array([width_of(b) for b in range(256)])


def shortest_path(word: bytes, machine: Machine) -> tuple[list[int], float]:
    """Ids and cost of the best path through one word; of equals, the longest last piece."""
    pairs, n = neighbours(machine), len(machine.pieces)
    longest = max(map(len, machine.arcs))
    best = np.full(len(word) + 1, np.inf)
    best[0], came, last = 0.0, [0] * (len(word) + 1), [n] * (len(word) + 1)
    for end in range(1, len(word) + 1):
        for at in range(max(0, end - longest), end):
            k = machine.arcs.get(word[at:end])
            if k is None or not best[at] + machine.costs[k] < best[end]:
                continue
            if not machine.merges or pairs.allowed(np.array([last[at]]), np.array([k]))[0]:
                best[end], came[end], last[end] = best[at] + machine.costs[k], at, k
        for at in range(max(0, end - 4), end):
            if WIDTHS[word[at]] == end - at and word[at:end] not in machine.arcs:
                cost = best[at] + machine.byte_cost * (end - at)
                if cost < best[end]:
                    best[end], came[end], last[end] = cost, at, n
    path, end = [], len(word)
    while end:
        at = came[end]
        path += [last[end]] if last[end] < n else [int(machine.byte_ids[b]) for b in reversed(word[at:end])]
        end = at
    return path[::-1], float(best[-1])


def shortest_paths(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, machine: Machine, index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for many words of at most LONG bytes: ids end to end, their number, the costs.

    Words lie in columns, the longest first, so the words that reach a place are the first
    columns. At each place the longest pieces that end there are tried first.
    """
    keys, key_ids, table, lengths = index
    pairs, none = neighbours(machine), len(machine.pieces)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    n, width = len(sizes), int(sizes[0]) if len(sizes) else 0
    alive = np.searchsorted(-sizes, -np.arange(width + 1), side="right")  # words of at least so many bytes
    best = np.full((width + 1, n), np.inf)
    came, last = np.zeros((width + 1, n), np.int16), np.full((width + 1, n), none, np.int32)
    best[0] = 0
    signs = np.zeros((width, n), np.uint8)
    sums = np.zeros((width + 1, n), np.uint64)
    up, down = powers(BASE, LONG + 1), powers(INVERSE, LONG + 1)
    for at in range(width):
        m = alive[at + 1]
        signs[at, :m] = data[starts[:m] + at]
        sums[at + 1, :m] = sums[at, :m] + SYMBOLS[signs[at, :m]] * up[at]

    def pieces_at(at: int, end: int, columns: np.ndarray):
        """The columns with a piece over these places, and its id."""
        size = np.array([end - at], np.uint64)
        hashes = mixed((sums[end, columns] - sums[at, columns]) * down[at] + size * LENGTHS)
        maybe = np.flatnonzero(table[hashes >> np.uint64(64 - FILTER_BITS)])
        found = np.minimum(np.searchsorted(keys, hashes[maybe]), len(keys) - 1)
        hit = keys[found] == hashes[maybe]
        return columns[maybe[hit]], key_ids[found[hit]]

    for end in range(1, width + 1):
        columns = np.arange(alive[end])
        for length in lengths:
            at = end - length
            if at < 0:
                continue
            who, k = pieces_at(at, end, columns)
            cost = best[at, who] + machine.costs[k]
            better = cost < best[end, who]
            if machine.merges:
                better[better] = pairs.allowed(last[at, who[better]], k[better])
            who = who[better]
            best[end, who], came[end, who], last[end, who] = cost[better], at, k[better]
            if machine.merges and len(who):
                columns = columns[np.isinf(best[end, columns])]
        for at in range(max(0, end - 4), end):
            who = np.flatnonzero(WIDTHS[signs[at, :alive[end]]] == end - at)
            who = np.setdiff1d(who, pieces_at(at, end, who)[0], assume_unique=True)
            cost = best[at, who] + machine.byte_cost * (end - at)
            who, cost = who[cost < best[end, who]], cost[cost < best[end, who]]
            best[end, who], came[end, who], last[end, who] = cost, at, none
    path = np.full((n, width), -1, np.int32)
    end, columns = sizes.copy(), np.arange(n)
    while (end > 0).any():
        who = columns[end > 0]
        to, k = end[who], last[end[who], who]
        at = came[to, who].astype(to.dtype)
        path[who, at] = k
        for step in range(4):
            byte = (k == none) & (at + step < to)
            path[who[byte], at[byte] + step] = machine.byte_ids[signs[at[byte] + step, who[byte]]]
        end[who] = at
    back = np.argsort(order, kind="stable")
    path, cost = path[back], best[sizes, columns][back]
    used = path >= 0
    return path[used], used.sum(axis=1), cost


class Solved:
    """Paths of words that this process has met, by the words' hashes; it starts anew when full."""

    def __init__(self):
        self.keys = np.zeros(1 << 19, np.uint64)
        self.place, self.number = np.zeros(1 << 19, np.int32), np.zeros(1 << 19, np.int32)
        self.cost = np.zeros(1 << 19)
        self.pool = np.zeros(0, np.int32)

    def paths(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, machine: Machine, index):
        """For different words: where their ids lie in the pool, how many they are, their costs."""
        if len(self.pool) > FULL:
            self.keys[:], self.pool = 0, self.pool[:0]
        slots = hashes >> np.uint64(45)
        place, number, cost = self.place[slots], self.number[slots], self.cost[slots]
        new = np.flatnonzero(self.keys[slots] != hashes)
        new = new[np.argsort(-sizes[new], kind="stable")]
        short, flat, at = new[sizes[new] <= LONG], [self.pool], len(self.pool)
        for k in new[sizes[new] > LONG]:
            ids, cost[k] = shortest_path(data[starts[k]:starts[k] + sizes[k]].tobytes(), machine)
            flat.append(np.array(ids, np.int32))
            place[k], number[k], at = at, len(ids), at + len(ids)
        for begin in range(0, len(short), BLOCK):
            block = short[begin:begin + BLOCK]
            ids, number[block], cost[block] = shortest_paths(data, starts[block], sizes[block], machine, index)
            flat.append(ids)
            place[block], at = at + np.cumsum(number[block]) - number[block], at + len(ids)
        self.pool = np.concatenate(flat)
        self.keys[slots[new]], self.place[slots[new]], self.number[slots[new]], self.cost[slots[new]] = hashes[new], place[new], number[new], cost[new]
        return place, number, cost


_solved: dict[str, Solved] = {}


def solved(machine: Machine) -> Solved:
    if machine.name not in _solved:
        _solved.clear()
        _solved[machine.name] = Solved()
    return _solved[machine.name]


def encode_texts(texts: list[str | None], machine: Machine, index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids end to end, their number in each text, and the cost of each text."""
    parts = [normalised(t, machine.leading_space) for t in texts]
    data = np.frombuffer(b"".join(parts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
    space = data == 32
    first = np.zeros(len(data) + 1, bool)
    first[1:-1] = space[1:] & ~space[:-1]
    first[offsets] = True
    starts = np.flatnonzero(first[:-1])
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    hashes, shown, same = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    words = solved(machine)
    place, number, cost = words.paths(data, hashes, starts[shown], (ends - starts)[shown], machine, index)
    each = number[same].astype(np.int64)
    ids = words.pool[np.repeat(place[same] - (np.cumsum(each) - each), each) + np.arange(each.sum())]
    edges = np.searchsorted(starts, offsets)
    totals = np.concatenate([[0], np.cumsum(each)])
    sums = np.concatenate([[0.0], np.cumsum(cost[same])])
    return ids, np.diff(totals[edges]), np.diff(sums[edges])


def decode_ids(ids: np.ndarray, machine: Machine) -> str:
    """The text of the ids; those that are no piece have none."""
    n = len(machine.pieces)
    text = b"".join([machine.pieces[k] for k in ids.tolist() if 0 <= k < n])
    return text[1 if machine.leading_space and text[:1] == b" " else 0:].decode("utf-8", "replace")


def fields_of(docs: DataFrame, keep: list[str]) -> list[str]:
    return [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]


def encode(docs: DataFrame, machine: Machine, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (default: all) with ``ids`` and ``cost``.

    A null or empty text has no ids and cost 0; each row is encoded for itself; kept columns
    with the two names are replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("ids", "cost")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = machine.by_hash()
        for batch in batches:
            for part in slices(batch, text, limit=PART):
                ids, numbers, costs = encode_texts(part.column(text).to_pylist(), machine, index)
                offsets = np.concatenate([[0], np.cumsum(numbers)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), lists, pa.array(costs)], [*keep, "ids", "cost"])

    needed = [*keep, *([] if text in keep else [text])]
    return in_tasks(docs.select(*needed), run, ", ".join([*fields_of(docs, keep), "ids array<int>", "cost double"]))


def decode(rows: DataFrame, machine: Machine, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The kept columns (default: all) with ``decoded``: the text of the ids.

    Null or no ids give an empty text; control ids and ids outside the model have no text;
    bytes that are no UTF-8 become replacement signs.
    """
    keep = [c for c in (rows.columns if keep is None else keep) if c != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = (pc.fill_null(v.values, -1).to_numpy() if v.is_valid else np.zeros(0, np.int32) for v in batch.column(ids))
            texts = [decode_ids(v, machine) for v in values]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string())], [*keep, "decoded"])

    needed = [*keep, *([] if ids in keep else [ids])]
    return in_tasks(rows.select(*needed), run, ", ".join([*fields_of(rows, keep), "decoded string"]))


def digest(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, n_ids, ids, cost, decoded_sha256, and whether decoding gave the text again.

    Encoding and decoding share one pass, so that the ids cross to Spark once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = machine.by_hash()
        for batch in batches:
            for part in slices(batch, limit=PART):
                texts = part.column("text").to_pylist()
                ids, numbers, costs = encode_texts(texts, machine, index)
                edges = np.concatenate([[0], np.cumsum(numbers)])
                decoded = [decode_ids(ids[a:b], machine) for a, b in zip(edges, edges[1:])]
                again = [d == (t or "").replace(MARK, " ") for d, t in zip(decoded, texts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(numbers, pa.int64()), pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids)),
                     pa.array(costs), pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()), pa.array(again, pa.bool_())],
                    ["doc_id", "n_ids", "ids", "cost", "decoded_sha256", "round_trip"])

    schema = "doc_id long, n_ids long, ids array<int>, cost double, decoded_sha256 string, round_trip boolean"
    return in_tasks(docs.select("doc_id", "text"), run, schema)
