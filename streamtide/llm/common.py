"""What the corpus operators share: scratch tables, batches of bytes, words and their hashes.

The numpy helpers work on the UTF-8 bytes of many texts at once, laid end to end. They run
inside Spark tasks, on slices of an Arrow batch of at most ``CHUNK`` bytes (a longer text is
a slice of its own), so the memory of a task does not depend on the size of its partition.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHUNK = 1_000_000
BATCH_ROWS = 1_000


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh folder in the shared ``spark.checkpoint.dir``, else below the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared folder and read again: lineage ends there."""
    path = scratch(frame.sparkSession, purpose)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Deletes a stored table that no later step reads."""
    spark = frame.sparkSession
    for file in frame.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def free_name(name: str, frame: DataFrame) -> str:
    """The name, with underscores until no column of the frame has it (in any case)."""
    taken = {c.lower() for c in frame.columns}
    while name in taken:
        name += "_"
    return name


ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def give_back() -> None:
    """Returns freed memory to the system; a worker would keep that of its largest batch."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not this C library
        pass


def in_tasks(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` for rows that hold whole texts: ``BATCH_ROWS`` at a time, as the session
    is told, and with memory given back after each batch."""
    conf = rows.sparkSession.conf
    if not 0 < int(conf.get(ROWS_KEY)) <= BATCH_ROWS:
        conf.set(ROWS_KEY, str(BATCH_ROWS))

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            give_back()

    return rows.mapInArrow(lambda batches: run(tidy(batches)), schema)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Row ranges of the batch whose texts have ``limit`` bytes at most, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes.astype(np.int64))
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts end to end, and the offsets (one more than texts); null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


LOWER = lower_table()
#: Bytes of a word: digits, a-z after lower-casing, and everything outside ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
#: Bytes of a word that only white space ends.
DARK = np.ones(256, bool)
DARK[[32, 9, 10, 11, 12, 13]] = False


def word_spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray):
    """Start and end of each word, and the number of words before each text."""
    inside = kind[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
SYMBOLS = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1024), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= 2 * CHUNK:
            _powers[base] = have
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any byte range follows in constant time."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(SYMBOLS[data] * powers(BASE, len(data)), out=sums[1:])
    return sums


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, the same wherever the bytes stand."""
    sums = prefix_sums(data)
    back = powers(INVERSE, len(data) + 1)
    lengths = (ends - starts).astype(np.uint64)
    return mixed((sums[ends] - sums[starts]) * back[starts] + lengths * np.uint64(0xD6E8FEB86659FD93))


def shingle_hashes(words: np.ndarray, firsts: np.ndarray, width: int):
    """Hashes of the runs of ``width`` words in each text, and the text of each.

    A text with fewer words, but not none, has its whole sequence as one run. ``firsts`` has
    the number of words before each text, with the total at its end.
    """
    counts = np.diff(firsts)
    runs = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    owner = np.repeat(np.arange(len(counts)), runs)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
    at, left = firsts[:-1][owner] + step, counts[owner] - step
    total = np.zeros(len(owner), np.uint64)
    for k in range(width):
        here = k < left
        part = words[np.minimum(at + k, max(len(words) - 1, 0))] if len(words) else total
        total = np.where(here, mixed(total + part + np.uint64(k + 1)), total)
    return total, owner


def as_long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))
