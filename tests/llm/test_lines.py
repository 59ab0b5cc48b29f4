import hashlib
import random
import re

import numpy as np
import pytest

from streamtide.llm import lines


def brute(rows, min_words):
    """rows: distinct (doc, text) in order. Lines of each that lie in a maximal run of enough words
    that also stands at an earlier place: every two places with one line are compared."""
    split = [None if t is None else t.split("\n") for _, t in rows]
    gone, before = [set() for _ in rows], {}
    for d, own in enumerate(split):
        for p in range(len(own or [])):
            for e, q in before.get(own[p], []):
                n, other = 0, split[e]
                while p + n < len(own) and q + n < len(other) and own[p + n] == other[q + n]:
                    n += 1
                if sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in own[p:p + n]) >= min_words:
                    gone[d].update(range(p, p + n))
            before.setdefault(own[p], []).append((d, p))
    return split, gone


@pytest.fixture(scope="module")
def docs(spark, documents):
    rng = random.Random(9)

    def line(n):
        return " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))

    long, short = [line(60) for _ in range(4)], [line(4) for _ in range(40)]
    texts = [
        "\n".join([line(3), long[0], line(2)]), "\n".join([long[0], line(9)]), "\n".join([long[1], long[1], long[1]]),
        "\n".join(short), "\n".join([line(5), *short, line(5)]), "\n".join([*short[:20], line(1), *short[20:]]),
        "\n".join(short[5:17]), "\n".join(short[5:18]), "\n".join(["a b"] * 60), "\n".join(["a b"] * 33), "\n".join(["", "", *short[:14], "", ""]),
        "\n" * 300 + long[2], "\n" * 300 + long[2], "\n".join(["été", long[3], "fin"]), long[3] + "\n", "\n".join([*short, *long]) + "\nend",
    ]
    extra = [(70_000 + k, t) for k, t in enumerate(texts)] + [(70_000, texts[0]), (None, texts[3]), (None, texts[3])]
    return documents.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True).cache()


@pytest.mark.parametrize("min_words, rows", [(50, lines.BROADCAST_ROWS), (7, 0)])
def test_equals_brute_force(docs, monkeypatch, min_words, rows):
    monkeypatch.setattr(lines, "BROADCAST_ROWS", rows)
    own = sorted({(r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "") for r in docs.collect()})
    plain = [(d if known else None, t if some else None) for known, d, some, t in own]
    split, gone = brute(plain, min_words)
    expected = {(d, t): (None if t is None else "\n".join(x for i, x in enumerate(s) if i not in g), len(g)) for (d, t), s, g in zip(plain, split, gone)}
    got = lines.dedup(docs.withColumn("whole", docs.text).withColumn("removed_runs", docs.doc_id), min_words).collect()
    assert len(got) == docs.count()
    for r in got:
        text, n = expected[r.doc_id, r.whole]
        assert r.text == text, (r.doc_id, r.whole[:80])
        assert sum(x["to"] - x["from"] for x in r.removed_runs or []) == n
    assert sum(n for _, n in expected.values()) > 100


@pytest.mark.parametrize("min_words", [50, 7])
def test_tails_of_runs_go(spark, min_words):
    rng = random.Random(4)
    pool = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(n)) for n in (60, 5, 5, 1, 30, 3, 8, 2)] + [""]
    texts = ["\n".join([*pool[:3], "x"]), "\n".join(pool[:3]), "\n".join(["y", *pool[:3]]), "\n".join([pool[0], *[""] * 9, "z"]), "\n".join([pool[0], *[""] * 9])]
    texts += ["\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 40))) for _ in range(40)]
    rows = list(enumerate(texts))
    split, gone = brute(rows, min_words)
    got = {r.doc_id: r for r in lines.dedup(spark.createDataFrame(rows, "doc_id long, text string"), min_words).collect()}
    for d, _ in rows:
        assert {i for x in got[d].removed_runs or [] for i in range(x["from"], x["to"])} == gone[d], texts[d]
        assert got[d].text == "\n".join(x for i, x in enumerate(split[d]) if i not in gone[d])
    assert gone[1] == {0, 1, 2} and gone[2] == {1, 2, 3}


def test_digest(docs):
    for r in lines.digest(docs.where("doc_id between 70002 and 70003 or doc_id = 10000 or doc_id = 10001")).collect():
        expected = {70_002: (3, 2, 1), 70_003: (40, 0, 0), 10_000: (0, 0, 0), 10_001: (1, 0, 0)}[r.doc_id]
        assert (r.n_lines, r.n_removed, r.n_runs) == expected
        if r.doc_id >= 10_000 and r.doc_id < 10_002:
            assert r.kept_sha256 == hashlib.sha256(b"").hexdigest()


def test_no_rows(empty):
    assert lines.digest(empty).count() == 0 and lines.dedup(empty).columns == [*empty.columns, "removed_runs"]


def test_names_are_of_128_bits():
    data = b"one line" + b"one line" + b"" + b"one lime"
    got = lines.names_of(data, np.array([0, 8, 16, 16]), np.array([8, 16, 16, 24])).to_pylist()
    assert got[0] == got[1] and len({tuple(x.values()) for x in got}) == 3
    for half in "ab":
        assert len({x[half] for x in got}) == 3
