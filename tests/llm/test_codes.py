import math

import numpy as np
import pytest

from streamtide.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, near int"


def brute(rows, cuts=4, entries=256, rounds=4):
    kept = [(d, label, [math.floor(1024 * x) for x in v]) for d, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    sizes = [len(v) for _, _, v in kept if v and len(v) % cuts == 0]
    size = min(set(sizes), key=lambda n: (-sizes.count(n), n)) if sizes else 0
    fits = sorted((r for r in kept if len(r[2]) == size and size), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    width = size // cuts
    parts = [[r[2][p * width:(p + 1) * width] for r in fits] for p in range(cuts)]
    books = [[x[:] for x in own[:entries]] for own in parts]
    nearest = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(cuts):
            at = [nearest(x, books[p])[1] for x in parts[p]]
            for e in set(at):
                own = [x for x, a in zip(parts[p], at) if a == e]
                books[p][e] = [sum(column) // len(own) for column in zip(*own)]
    out = [(d, label, None, None) for d, label, v in kept if len(v) != size or not size]
    for k, (d, label, _) in enumerate(fits):
        found = [nearest(parts[p][k], books[p]) for p in range(cuts)]
        out.append((d, label, [e for _, e in found], sum(x for x, _ in found)))
    return sorted(out, key=repr), books


def frame(spark, rows):
    return spark.createDataFrame([(d, v, label, "clash", None, 1) for d, v, label in rows], SCHEMA).repartition(3)


def check(spark, rows, **bounds):
    expected, books = brute(rows, **bounds)
    got, own = codes.compress(frame(spark, rows), **bounds)
    assert own.tolist() == books
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected


@pytest.fixture(scope="module")
def rows(spark):
    found = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").where("vec_id < 400").select("vec_id", "embedding", "label").collect()
    own = [(r.vec_id, list(r.embedding[:8]), r.label) for r in found]
    odd = [None, [], [1.0, 2.0], [None] * 8, [1.0] * 7 + [float("nan")], [float("-inf")] + [0.0] * 7, [0.1] * 12]
    own += [(5_000 + k, v, None if k % 2 else 3) for k, v in enumerate(odd)] + [(None, [0.5] * 8, None), (None, [0.25] * 8, 1)]
    return own + own[:40] + [(own[0][0], [0.125] * 8, 2)]


@pytest.mark.parametrize("entries", [256, 40])
def test_equals_brute_force(spark, rows, entries):
    check(spark, rows, entries=entries)


def test_clusters_use_their_bounds(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1, (60, 8))
    rows = [(k, (centres[k % 60] + rng.normal(0, 0.02, 8)).tolist(), k % 3) for k in range(900)]
    check(spark, rows, entries=64, rounds=5)


def test_few_and_no_vectors(spark, rows):
    check(spark, rows[:2])
    check(spark, [(k, [0.5] * 8, None) for k in range(9)], entries=4)
    none = frame(spark, [(1, None, 1), (2, [], 2)])
    assert [tuple(r) for r in codes.compress(none)[0].collect()] == [(2, 2, None, None)]
    assert codes.digest(none.where("vec_id = 1")).collect() == []
    with pytest.raises(ValueError):
        codes.compress(frame(spark, [(1, [1e20] * 8, 1)]))


@pytest.mark.parametrize("limit", [codes.BROADCAST_LABELS, 0])
def test_label_errors_and_text(spark, rows, limit, monkeypatch):
    monkeypatch.setattr(codes, "BROADCAST_LABELS", limit)
    expected, _ = brute(rows)
    sums = {}
    for _, label, _, error in expected:
        sums[label] = sums.get(label, 0) + (error or 0)
    got = sorted(((r.vec_id, r.code, r.error, r.label_error) for r in codes.digest(frame(spark, rows)).collect()), key=repr)
    text = lambda code: None if code is None else "".join(f"{e:02x}" for e in code)
    assert got == sorted(((d, text(code), error, sums[label]) for d, label, code, error in expected), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_bounds_never_decide_wrongly(seed):
    rng = np.random.default_rng(seed)
    parts, entries = rng.integers(-30, 30, (500, 3)), rng.integers(-30, 30, (64, 3))
    near, low, outer = codes.closest(codes.squares(parts, entries), 8)
    compared = 0
    for step in (0, 1, 3, 1, 0):
        now = entries + rng.integers(-step, step + 1, entries.shape)
        moves = np.sqrt(((now - entries) ** 2).sum(axis=1)) * (1 + codes.MARGIN)
        near, low, outer, own, used = codes.verified(parts, now, moves, near, low, outer)
        exact = ((parts[:, None] - now[None]) ** 2).sum(axis=2)
        assert (near[:, 0] == exact.argmin(axis=1)).all() and (own == exact.min(axis=1)).all()
        true = np.sqrt(exact)
        kept = np.take_along_axis(true, near.astype(int), 1)
        assert (np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1][:, 1:] <= kept[:, 1:] + 1e-9).all()
        np.put_along_axis(true, near.astype(int), np.inf, 1)
        assert (outer <= true.min(axis=1)).all()
        compared += int((used > 0).sum())
        entries = now
    assert 0 < compared < 5 * len(parts)
