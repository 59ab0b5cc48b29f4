import collections
import hashlib
import random
import re

import numpy as np
import pytest

from streamtide.llm import queries, suffixes


def brute(rows, window):
    texts = [(t or "").encode() for _, t in rows]
    seen = {}
    for t in texts:
        for i in range(len(t) - window + 1):
            seen[t[i:i + window]] = seen.get(t[i:i + window], 0) + 1
    out = []
    for (doc, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - window + 1):
            if seen[t[i:i + window]] > 1:
                gone[i:i + window] = True
        runs = int((gone[:-1] & ~np.concatenate([[False], gone[:-1]])[:len(t)]).sum()) if len(t) else 0
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


@pytest.fixture(scope="module")
def docs(spark, documents):
    rng = random.Random(2)

    def text(n):
        return "".join(rng.choice("abcdefgh é\n") for _ in range(n))

    a, b, c = text(900), text(1300), text(430)
    rows = [a, a[:500] + text(60) + a[440:], b + b, text(200) + c + text(50), c[:410] + text(9), c[5:] + c[:404], "ab" * 700, "z" * 399, "z" * 400,
            b[:399], b[100:501], b[700:1099] + text(1) + b[300:720], text(3000), (a + b)[700:1400]]
    extra = [(80_000 + k, t) for k, t in enumerate(rows)] + [(80_001, rows[1]), (None, rows[3][:420]), (None, rows[3][:420]), (80_002, text(500))]
    some = documents.where("doc_id >= 10000 or doc_id < 60")
    return some.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True).cache()


@pytest.mark.parametrize("window, gram, limit", [(400, 200, 400_000), (400, 200, 0), (30, 12, 400_000)])
def test_equals_brute_force(docs, monkeypatch, window, gram, limit):
    monkeypatch.setattr(suffixes, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(suffixes, "PACKET", 3_000)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    monkeypatch.setattr(suffixes, "WINDOW", window)
    found = suffixes.repeats
    monkeypatch.setattr(suffixes, "repeats", lambda docs: found(docs, window, gram))
    got = suffixes.digest(docs).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(rows, window)
    assert sum(r.n_removed > 0 for r in got) > 12
    kept = suffixes.cut(found(docs, window, gram)).collect()
    assert sorted(hashlib.sha256(r.kept).hexdigest() for r in kept) == sorted(r.kept_sha256 for r in got)


def brute_passages(rows, size):
    texts = [re.findall(r"[^ \t-\r]+", t or "", re.A) for _, t in rows]
    seen = collections.Counter(tuple(t[i:i + size]) for t in texts for i in range(len(t) - size + 1))
    out = []
    for (doc, _), t in zip(rows, texts):
        inside = [False] * (len(t) + 1)
        for i in range(len(t) - size + 1):
            if seen[tuple(t[i:i + size])] > 1:
                inside[i:i + size] = [True] * size
        out.append((doc, sum(b and not a for a, b in zip([False, *inside], inside)), sum(inside)))
    return sorted(map(str, out))


@pytest.fixture(scope="module")
def passages(spark, documents):
    rng = random.Random(5)

    def words(n):
        return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4))) for _ in range(n))

    a, b = words(51), words(60)
    rows = [f"{words(40)} {a} {words(30)}", f"{words(9)}\n{a}\x85{words(8)}", f"{words(200)}  {a}", f" {b} ", f"{words(5)}\t{b.replace(' ', chr(10), 7)}",
            f"{words(20)} {b[1:]}", words(49), words(50), f"{words(70)} {words(70)}", "x y " * 40, None, "", "é" * 700, f"{b} {words(3)} {b}"]
    extra = [(70_000 + k, t) for k, t in enumerate(rows)] + [(71_000, rows[6]), (71_001, rows[7]), (71_002, rows[7]), (70_008, rows[8]), (None, rows[8]), (None, f"{a} {words(2)}")]
    some = documents.where("doc_id >= 10000 or doc_id < 60")
    return some.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True).cache()


@pytest.mark.parametrize("limit", [400_000, 0])
def test_passages_of_words_that_stand_elsewhere(passages, monkeypatch, limit):
    monkeypatch.setattr(suffixes, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(suffixes, "PACKET", 3_000)
    rows = [(r.doc_id, r.text) for r in passages.collect()]
    got = suffixes.digest(passages, passage=50).collect()
    assert sorted(str((r.doc_id, r.n_passages, r.n_passage_words)) for r in got) == brute_passages(rows, 50)
    assert sorted(str(tuple(r)[:5]) for r in got) == brute(rows, 400)
    planted = {r.doc_id: r for r in got}
    assert [(planted[k].n_passage_words, planted[k].n_removed) for k in (70_000, 70_001, 70_002)] == [(51, 0), (50, 0), (51, 0)]
    assert not any(planted[k].n_passages for k in (70_006, 71_000, 70_010, 70_011, 70_012))


def test_query_counts_passages(spark, passages, tmp_path):
    passages.where("doc_id >= 70000").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op3_suffixes(spark, str(tmp_path)).collect()}
    assert got[70_000].n_passages == 1 and got[70_000].n_passage_words == 51 and got[70_000].n_removed == 0


def test_front_coding_comes_back():
    rng = np.random.default_rng(4)
    for n in (1, 2, 500):
        keys = np.unique(rng.integers(0, 2 ** 63, n, dtype=np.uint64) >> np.uint64(rng.integers(0, 50)))
        back, same = suffixes.front_decoded(suffixes.front_coded(keys), len(keys))
        assert (back == keys).all()
        for k in range(1, len(keys)):
            a, b = (int(x).to_bytes(8) for x in keys[k - 1:k + 1])
            assert a[:same[k]] == b[:same[k]] and a[same[k]] != b[same[k]]
    dense = np.arange(1000, dtype=np.uint64)
    assert len(suffixes.front_coded(dense)) < 2.1 * len(dense) + 8


@pytest.mark.parametrize("n_runs, size, bits", [(1, 5, 0), (2, 40, 3), (7, 900, 5), (37, 4000, 5), (3, 0, 2)])
def test_loser_trees_mark_what_other_runs_have(n_runs, size, bits):
    rng = np.random.default_rng(n_runs)
    pool = rng.integers(0, 2 ** (63 - bits), max(size, 1), dtype=np.uint64) >> np.uint64(rng.integers(0, 3)) if bits else np.arange(9, dtype=np.uint64)
    pool[::3] &= np.uint64(0xFFFF)  # many that share leading bytes
    first = 1 if bits else 0
    runs = []
    for _ in range(n_runs):
        own = np.unique(rng.choice(pool, size)) + np.uint64(first << (64 - bits) if bits else 0) if size else np.zeros(0, np.uint64)
        runs.append(suffixes.front_decoded(suffixes.front_coded(own), len(own)) if len(own) else (own, np.zeros(0, np.uint8)))
    got = suffixes.LoserTrees(runs, first, bits).equal_keys()
    every = np.concatenate([k for k, _ in runs])
    kinds, counts = np.unique(every, return_counts=True)
    assert (got == (counts[np.searchsorted(kinds, every)] > 1)).all()


def test_no_rows(empty):
    assert suffixes.digest(empty).count() == 0
