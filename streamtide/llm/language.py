"""Language identification by mixture inference.

Each word has a likelihood under each language from its byte trigrams. A document mixes
languages: expectation-maximisation finds the proportions, and the set of languages is the
one whose likelihood, less a penalty for each further language, is best.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamtide.llm.common import LOWER, as_bytes, in_tasks, slices, word_spans

#: Trigrams are hashed into so many bins; a model has one row of bins for each language.
BITS = 15
#: About so many labelled documents of each language are fitted, picked by a hash of the id.
SAMPLE = 2_500
#: Tasks that count the sample, whose size SAMPLE bounds.
SAMPLE_TASKS = 8
ROUNDS = 8
#: Log likelihood that a further language has to add, for each unit of log(words).
PENALTY = 2.0
#: Least likelihood of a word relative to its best language: no single word decides.
FLOOR = 1e-4
UNKNOWN = "und"

LETTERS = np.zeros(256, bool)
LETTERS[97:123] = LETTERS[128:] = True
FOLD = np.where(LETTERS[LOWER], LOWER, 32).astype(np.uint8)
LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Model:
    languages: list[str]
    table: np.ndarray  # log probability by language and bin


def trigram_bins(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bin of the trigram around each byte; beyond a text's ends stands a space."""
    left, right = np.full(len(data), 32, np.uint32), np.full(len(data), 32, np.uint32)
    left[1:], right[:-1] = data[:-1], data[1:]
    left[offsets[:-1][offsets[:-1] < len(data)]] = 32
    right[offsets[1:][offsets[1:] > 0] - 1] = 32
    code = (left << np.uint32(16)) | (data.astype(np.uint32) << np.uint32(8)) | right
    return (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id", sample: int = SAMPLE) -> Model:
    """Trigram probabilities of each non-null language, from about ``sample`` documents each.

    The sizes that reach the driver are those of the model: languages times bins. Rows
    without a text or a language are not used; without any the model has no language.
    """
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r.lang: r.n for r in usable.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, 1 << BITS), np.float32))
    share = F.create_map(*(F.lit(x) for k in languages for x in (k, min(1.0, sample / sizes[k]))))
    draw = F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.lit("language")), F.lit(1_000_000)) / 1_000_000
    picked = usable.where(draw < share[F.col(lang)]).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    places = {k: i for i, k in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(places), 1 << BITS), np.int64)
        for batch in batches:
            for part in slices(batch):
                data, offsets = as_bytes(part.column("text"))
                data = FOLD[data]
                bins = trigram_bins(data, offsets)
                owner = np.repeat([places[x.as_py()] for x in part.column("lang")], np.diff(offsets))
                inside = LETTERS[data]
                np.add.at(counts, (owner[inside], bins[inside]), 1)
        who, which = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(who.astype(np.int32)), pa.array(which.astype(np.int32)), pa.array(counts[who, which])], ["who", "bin", "n"])

    rows = (
        in_tasks(picked.repartition(SAMPLE_TASKS), count, "who int, bin int, n long")
        .groupBy("who", "bin").agg(F.sum("n").alias("n")).toPandas()
    )
    counts = np.full((len(languages), 1 << BITS), 0.5)
    np.add.at(counts, (rows["who"].to_numpy(), rows["bin"].to_numpy()), rows["n"].to_numpy())
    return Model(languages, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32))


def word_likelihoods(data: np.ndarray, offsets: np.ndarray, model: Model):
    """For each word its likelihood by language, the best as 1, and the words before each text."""
    data = FOLD[data]
    starts, ends, firsts = word_spans(data, offsets, LETTERS)
    bins = trigram_bins(data, offsets)
    logs = np.empty((len(starts), len(model.languages)))
    sums = np.zeros(len(data) + 1)
    for k, row in enumerate(model.table):
        np.cumsum(row[bins], dtype=np.float64, out=sums[1:])
        logs[:, k] = sums[ends] - sums[starts]
    logs -= logs.max(axis=1, keepdims=True)
    return np.maximum(np.exp(logs), FLOOR), firsts


def proportions(likely: np.ndarray, counts: np.ndarray, allowed: np.ndarray):
    """Proportions by text and language, and the log likelihood of each text.

    ``counts`` has the words of each text, none of which is 0; ``allowed`` marks the
    languages that a text may mix.
    """
    firsts = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(counts)), counts)
    shares = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(ROUNDS):
        weights = likely * shares[owner]
        weights /= weights.sum(axis=1, keepdims=True)
        shares = np.add.reduceat(weights, firsts, axis=0) / counts[:, None]
    return shares, np.add.reduceat(np.log((likely * shares[owner]).sum(axis=1)), firsts)


def mixtures(likely: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Proportions under the language set with the best penalised likelihood.

    The sets are nested: the languages in the order of their share when all may mix. A text
    leaves as soon as one more language does not pay.
    """
    n_languages = likely.shape[1]
    full, _ = proportions(likely, counts, np.ones((len(counts), n_languages)))
    rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1, kind="stable")
    firsts = np.cumsum(counts) - counts
    best = (rank == 0).astype(float)
    top = np.repeat(np.argmin(rank, axis=1), counts)
    score = np.add.reduceat(np.log(likely[np.arange(len(likely)), top]), firsts)
    active = np.arange(len(counts))
    for size in range(2, n_languages + 1):
        if not len(active):
            break
        chosen = np.zeros(len(counts), bool)
        chosen[active] = True
        shares, found = proportions(likely[np.repeat(chosen, counts)], counts[active], (rank[active] < size).astype(float))
        pays = found - PENALTY * np.log(counts[active] + 1) > score[active]
        active, shares, found = active[pays], shares[pays], found[pays]
        best[active], score[active] = shares, found - PENALTY * np.log(counts[active] + 1)
    return best


def has_letter(text: str | None) -> bool:
    return any(m.group().isalpha() for m in LETTER.finditer(text or ""))


def lettered(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text has a letter: those that ``predict`` judges if its model has languages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield part.filter(pa.array([has_letter(x.as_py()) for x in part.column(text)], pa.bool_()))

    return in_tasks(docs, run, docs.schema)


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default: all) with lang_pred, lang_score, languages and shares.

    lang_pred has the largest share, the first in the alphabet among equals. A text that is
    null or has no letter, or any text under a model without languages, is ``und`` with
    score 0 and no languages. Each row is judged for itself. A column with one of the four
    names is replaced.
    """
    added = {"lang_pred": T.StringType(), "lang_score": T.DoubleType(), "languages": T.ArrayType(T.StringType()), "shares": T.ArrayType(T.DoubleType())}
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    names = np.array([*model.languages, UNKNOWN])

    def infer(part: pa.RecordBatch) -> list[pa.Array]:
        known = np.fromiter((has_letter(x.as_py()) for x in part.column(text)), bool, part.num_rows)
        shares = np.zeros((part.num_rows, len(model.languages)))
        if model.languages and known.any():
            likely, firsts = word_likelihoods(*as_bytes(part.column(text)), model)
            counts = np.diff(firsts)
            some = counts > 0
            if some.any():
                shares[some] = mixtures(likely, counts[some])
        shares[~known] = 0
        first = shares.argmax(axis=1) if model.languages else np.zeros(part.num_rows, int)
        score = shares.max(axis=1) if model.languages else np.zeros(part.num_rows)
        sets = [np.flatnonzero(row > 0) for row in shares]
        return [
            pa.array(names[np.where(score > 0, first, len(model.languages))], pa.string()), pa.array(score),
            pa.array([names[s].tolist() for s in sets], pa.list_(pa.string())),
            pa.array([row[s] for row, s in zip(shares, sets)], pa.list_(pa.float64())),
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + infer(part), [*keep, *added])

    fields = [docs.schema[c] for c in keep] + [T.StructField(k, v) for k, v in added.items()]
    needed = [F.col(f"`{c}`") for c in [*keep, *([] if text in keep else [text])]]
    return in_tasks(docs.select(*needed), run, T.StructType(fields))


def digest(docs: DataFrame) -> DataFrame:
    model = fit(docs.where(~is_held_out(F.col("doc_id"))))
    found = predict(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"),
        F.array_join("languages", ",").alias("languages"))
