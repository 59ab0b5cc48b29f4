"""Compressed vectors: a code for each part, from codebooks learnt with adaptive distance bounds.

A vector is cut into parts and each part takes the number of the nearest entry of its codebook.
Comparing every part with every entry in every round is what costs; most parts stay where they
are. So each part keeps, from round to round, its ``b`` closest entries in the order of lower
bounds on their distances, and one outer bound below the distances of all other entries. When
entries move, a bound sinks by the way that its entry went, the outer one by the longest way of
all. A part's distance to its own entry is computed anew, in whole numbers:

* below all bounds, the part stays;
* else only the entries whose bounds it reaches are compared, in whole numbers (the bounds are
  kept in order, so these stand in front), and take their new places;
* if it reaches the outer bound too, all entries are compared and the ``b`` closest picked anew.

Bounds are rounded down and compared with a margin, so they never decide wrongly, and ties, which
no bound can decide, are always compared. ``b`` follows what a round used: it falls to the number
of entries that all but a hundredth of the rows reached, and never rises.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamtide.llm.common import discard, stored
from streamtide.llm.vectors import SCALE, added, digest_of, finite, largest, matrix, means, rows_of, scaled

#: Of the entries, one in so many is kept with each part at first; and at least so many.
SHARE, FEWEST = 8, 3
#: Vectors handled at once.
BLOCK = 1_000
#: Labels and their sums (24 bytes at most) are broadcast up to this number, beyond it shuffled.
BROADCAST_LABELS = 1_000_000
#: What rounding can take from a bound, relative and absolute, and more.
MARGIN = 1e-9


def below(x: np.ndarray) -> np.ndarray:
    """As 32-bit floats that are not greater."""
    return np.nextafter((x * (1 - MARGIN)).astype(np.float32), np.float32(-np.inf))


def squares(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of all parts to all entries. Every number on the way is whole and below
    2**53 (``compress`` sees to it), so floats hold them exactly."""
    x, c = parts.astype(np.float64), entries.astype(np.float64)
    return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None, :]).astype(np.int64)


def closest(distances: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The b nearest entries of each row in order (ties to the lower number), lower bounds on
    their distances, and one for all others."""
    k = distances.shape[1]
    keys = distances * k + np.arange(k)
    if k > b:
        keys = np.partition(keys, b, axis=1)[:, :b + 1]
    keys.sort(axis=1)
    outer = below(np.sqrt(keys[:, b] // k)) if k > b else np.full(len(keys), np.inf, np.float32)
    return (keys[:, :b] % k).astype(np.int16), below(np.sqrt(keys[:, :b] // k)), outer


def verified(parts: np.ndarray, entries: np.ndarray, moves: np.ndarray, near: np.ndarray, low: np.ndarray, outer: np.ndarray):
    """near, low, outer after the entries moved, the distance to the own entry, and how many
    places (from the second) each part had to compare; ``b`` where all entries were."""
    n, b = near.shape
    own = ((parts - entries[near[:, 0]]) ** 2).sum(axis=1)
    reach = np.sqrt(own) * (1 + MARGIN) + MARGIN
    low = low.astype(np.float64) - moves[near]
    outer = outer.astype(np.float64) - moves.max(initial=0.0)
    ordered = np.minimum(np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1], outer[:, None])
    used = (ordered[:, 1:] <= reach[:, None]).sum(axis=1)
    used[outer <= reach] = b
    low, outer = below(ordered), below(outer)

    some = np.flatnonzero((used > 0) & (used < b))
    if len(some):
        place = np.arange(b)
        compared = (place >= 1) & (place <= used[some, None])
        row, at = np.nonzero(compared)
        entry = near[some[row], at]
        distance = np.full(compared.shape, -1, np.int64)
        distance[:, 0] = own[some]
        distance[row, at] = ((parts[some[row]] - entries[entry]) ** 2).sum(axis=1)
        known = distance >= 0
        keys = np.where(known, distance * len(entries) + near[some], np.iinfo(np.int64).max - b + place)
        order = np.argsort(keys, axis=1)
        bounds = np.where(known, below(np.sqrt(np.maximum(distance, 0))), low[some])
        near[some], low[some] = np.take_along_axis(near[some], order, 1), np.take_along_axis(bounds, order, 1)
        own[some] = np.take_along_axis(distance, order, 1)[:, 0]
    whole = np.flatnonzero(used == b)
    if len(whole):
        distances = squares(parts[whole], entries)
        near[whole], low[whole], outer[whole] = closest(distances, b)
        own[whole] = distances[np.arange(len(whole)), near[whole, 0]]
    return near, low, outer, own, used


STATE = "vec_id {kind}, label {label}, ints array<long>, code array<smallint>, error long, used int, near array<smallint>, low array<float>, outer array<float>"


def first_pass(rows: DataFrame, books: np.ndarray, b: int) -> DataFrame:
    """Every part against every entry."""
    cuts, k, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                ints = matrix(part.column("ints"), cuts * width).reshape(-1, cuts, width)
                found = []
                for p in range(cuts):
                    distances = squares(ints[:, p], books[p])
                    found.append((*closest(distances, b), distances.min(axis=1), np.full(len(ints), b)))
                yield batch_of(part, found)

    return rows.mapInArrow(run, schema_of(rows))


def next_pass(state: DataFrame, books: np.ndarray, moves: np.ndarray, kept: int, b: int) -> DataFrame:
    """The state after the entries moved; of the ``kept`` entries with each part ``b`` stay."""
    cuts, k, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                ints = matrix(part.column("ints"), cuts * width).reshape(-1, cuts, width)
                near = matrix(part.column("near"), cuts * kept).reshape(-1, cuts, kept)
                low = matrix(part.column("low"), cuts * kept).reshape(-1, cuts, kept)
                outer = matrix(part.column("outer"), cuts)
                found = []
                for p in range(cuts):
                    edge = np.minimum(outer[:, p], low[:, p, b:].min(axis=1, initial=np.inf))
                    found.append(verified(ints[:, p], books[p], moves[p], near[:, p, :b].copy(), low[:, p, :b], edge))
                yield batch_of(part, found)

    return state.mapInArrow(run, schema_of(state))


def batch_of(part: pa.RecordBatch, found: list) -> pa.RecordBatch:
    near, low, outer, own, used = (np.stack(x, axis=1) for x in zip(*found))
    n = len(own)
    columns = {
        "vec_id": part.column("vec_id"), "label": part.column("label"), "ints": part.column("ints"),
        "code": rows_of(near[:, :, 0].astype(np.int16)), "error": pa.array(own.sum(axis=1)), "used": pa.array(used.max(axis=1).astype(np.int32)),
        "near": rows_of(near.reshape(n, -1).astype(np.int16)), "low": rows_of(low.reshape(n, -1).astype(np.float32)),
        "outer": rows_of(outer.astype(np.float32)),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def schema_of(rows: DataFrame) -> str:
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    return STATE.format(kind=kinds["vec_id"], label=kinds["label"])


def learnt(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The entries after one round: floors of the means of their parts; unused ones stay."""
    cuts, k, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(cuts * k, np.int64), np.zeros((cuts * k, width), np.int64)
        for batch in batches:
            ints = matrix(batch.column("ints"), cuts * width).reshape(-1, width)
            slot = (matrix(batch.column("code"), cuts).astype(np.int64) + np.arange(cuts) * k).ravel()
            order = np.argsort(slot, kind="stable")
            some, starts = np.unique(slot[order], return_index=True)
            if len(some):
                sums[some] += np.add.reduceat(ints[order], starts, axis=0)
            counts += np.bincount(slot, minlength=cuts * k)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some]), rows_of(sums[some])], ["slot", "n", "sums"])

    out = books.copy()
    for (slot,), found in added(state.select("ints", "code").mapInArrow(run, "slot int, n long, sums array<long>"), ["slot"]).items():
        out[divmod(slot, k)] = means(found, width)
    return out


def fewer(state: DataFrame, b: int) -> int:
    """How many entries to keep: one beyond those that all but a hundredth of the rows reached."""
    counts = {r["used"]: r["count"] for r in state.groupBy("used").count().collect()}  # b + 1 rows at most
    over, total = 0, sum(counts.values())
    for used in sorted(counts, reverse=True):
        over += counts[used]
        if 100 * over > total:
            return min(b, max(FEWEST, used + 2))
    return b


def whole(vectors: DataFrame, scale: int, vec_id: str, vector: str, label: str) -> DataFrame:
    return vectors.where(finite(vector)).select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), scaled(vector, scale).alias("ints"))


def common_length(rows: DataFrame, cuts: int) -> int:
    """The length that most vectors have, of those that can be cut; the shorter of two; 0 if none can."""
    fits = rows.select(F.size("ints").alias("n")).where((F.col("n") > 0) & (F.col("n") % cuts == 0))
    best = fits.groupBy("n").count().orderBy(F.desc("count"), "n").limit(1).collect()
    return best[0]["n"] if best else 0


def compress(vectors: DataFrame, cuts: int = 4, entries: int = 256, rounds: int = 4, scale: int = SCALE, vec_id: str = "vec_id",
             vector: str = "embedding", label: str = "label") -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code (an entry for each part), error for each kept vector; the codebooks.

    Vectors that are null or hold null or non-finite components go. The codebooks are for the
    length that most vectors have and that can be cut into equal parts; vectors of another length
    stay, with null code and error, and teach nothing. Entries start as the parts of the smallest
    ids; rows without an id come after all others, rows of one id in the order of their
    components. With fewer vectors there are fewer entries, and without any no rows. Repeated
    rows each count. Components so large that a squared distance could pass 2**53 raise an error.
    Columns other than the three named are not read.
    """
    everything = stored(whole(vectors, scale, vec_id, vector, label), "whole-vectors")
    width = common_length(everything, cuts) // cuts
    fits = (F.size("ints") == cuts * width) & F.lit(width > 0)
    rows = everything.where(fits)
    other = everything.where(~fits).select(
        "vec_id", "label", F.lit(None).cast("array<smallint>").alias("code"), F.lit(None).cast("long").alias("error"))
    if not width:
        return other, np.zeros((cuts, 0, 0), np.int64)
    if (2 * largest(rows) + 1) ** 2 * width >= 1 << 53:
        raise ValueError("components are too large: a squared distance could exceed 2**53")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    books = np.array([r["ints"] for r in first], np.int64).reshape(-1, cuts, width).transpose(1, 0, 2).copy()
    b = min(books.shape[1], max(FEWEST, entries // SHARE))
    state = stored(first_pass(rows, books, b), "codes")
    for _ in range(rounds):
        now = learnt(state, books)
        moves = np.sqrt(((now - books) ** 2).sum(axis=2)) * (1 + MARGIN)
        less = fewer(state, b)
        after = stored(next_pass(state, now, moves, b, less), "codes")
        discard(state)
        state, books, b = after, now, less
    return state.select("vec_id", "label", "code", "error").unionByName(other), books


def digest(vectors: DataFrame) -> DataFrame:
    """The code as hex digits, errors by row and by label, and the hash of the codebooks."""
    found, books = compress(vectors)
    rows = stored(found, "coded")
    sums = stored(rows.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    sums = F.broadcast(sums) if sums.count() <= BROADCAST_LABELS else sums
    text = F.array_join(F.transform("code", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    same = rows["label"].eqNullSafe(sums["label"])
    return rows.join(sums, same).select(
        "vec_id", text.alias("code"), "error", "label_error", F.lit(digest_of(books.ravel())).alias("codebooks_sha256"))


def oracle_sql(cuts: int = 4, entries: int = 256, rounds: int = 4, scale: int = SCALE) -> str:
    """The rows of ``digest`` in DuckDB SQL, for vectors of one length."""
    steps = [
        f"kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS row, * FROM (SELECT vec_id, label, "
        f"list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings "
        f"WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0))",
        f"parts AS MATERIALIZED (SELECT row, p, len(v) // {cuts} AS w, v[p * (len(v) // {cuts}) + 1 : (p + 1) * (len(v) // {cuts})] AS s FROM kept, range({cuts}) t(p))",
        f"c0 AS MATERIALIZED (SELECT p, row - 1 AS e, s AS c FROM parts WHERE row <= {entries})",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"a{r} AS MATERIALIZED (SELECT row, p, any_value(w) AS w, any_value(s) AS s, arg_min(e, (d, e)) AS e, min(d) AS d FROM "
            f"(SELECT row, parts.p, w, s, e, CAST(list_sum(list_transform(range(1, w + 1), lambda i: (s[i] - c[i]) * (s[i] - c[i]))) AS BIGINT) AS d "
            f"FROM parts JOIN c{r} USING (p)) GROUP BY row, p)")
        if r < rounds:
            steps.append(
                f"c{r + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.c, c{r}.c) AS c FROM c{r} LEFT JOIN (SELECT p, e, list(mean ORDER BY i) AS c FROM "
                f"(SELECT p, e, i, CAST((sum(s[i]) - ((sum(s[i]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS mean FROM "
                f"(SELECT p, e, s, unnest(range(1, w + 1)) AS i FROM a{r}) GROUP BY p, e, i) GROUP BY p, e) m USING (p, e))")
    return (
        "WITH " + ",\n".join(steps) +
        f",\ncoded AS (SELECT row, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY row),\n"
        f"book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c{rounds})\n"
        f"SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 "
        f"FROM kept JOIN coded USING (row), book")
