import hashlib
import re

import pytest

from streamtide.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words_of(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(text, items):
    words, hit, names = words_of(text), set(), set()
    for item, body in items:
        own = words_of(body)
        for at in range(max(len(own) - 9, 1) if own else 0):
            window = own[at:at + 10]
            for s in range(len(words) - len(window) + 1):
                if words[s:s + len(window)] == window:
                    hit.update(range(s, s + len(window)))
                    names.update([str(item)] if item is not None else [])
    return len(words), len(hit), sorted(names)


@pytest.fixture(scope="module")
def items(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()][:40]
    rows += [(900, "Alpha beta"), (901, "gamma"), (902, "one two three four five six"), (903, ""), (904, None), (None, "delta"),
             (905, "a b a b a b a b a b a b a b"), (906, "gamma"), (900, "Alpha beta"), (10, "été 你好 x")]
    return spark.createDataFrame([(*r, "clash") for r in rows], "item_id long, text string, doc_id string")


@pytest.fixture(scope="module")
def docs(spark, documents, items):
    body = items.first().text
    texts = ["so ALPHA, beta-gamma! delta", "one two three four five six one two three four five six", "a b " * 40, body + " tail " + body,
             "head " + " ".join(body.split()[1:12]), " ".join(body.split()[:9]), "été 你好 X été 你好 x", "b a b a b a b a b a b"]
    extra = spark.createDataFrame([(30_000 + k, t) for k, t in enumerate(texts)] + [(30_000, texts[0]), (None, "gamma")], "doc_id long, text string")
    return documents.unionByName(extra, allowMissingColumns=True).cache()


def check(got, docs, items):
    listed = [(r.item_id, r.text) for r in items.collect()]
    rows = [(r.doc_id, *brute(r.text, listed)) for r in docs.select("doc_id", "text").collect()]
    expected = [(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_equals_brute_force(docs, items):
    got = [tuple(r) for r in decontaminate.digest(docs, items).collect()]
    check(got, docs, items)
    assert sum(r[-1] for r in got) > 10


def test_large_item_tables_are_shuffled(docs, items, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    some = docs.where("doc_id >= 10000 or doc_id is null or doc_id < 20")
    check([tuple(r) for r in decontaminate.digest(some, items).collect()], some, items)


N = 20_000


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_ROWS, 0])
def test_long_text(spark, items, limit, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", limit)
    body = items.first().text
    text = f"{'filler of many words here ' * N} {body} delta {'more ' * 5 * N}"
    [row] = decontaminate.digest(spark.createDataFrame([(1, text)], "doc_id long, text string"), items).collect()
    assert row.n_words == 10 * N + 1 + len(words_of(body)) and row.n_hit == 1 + len(words_of(body)) and row.contaminated


def test_items_without_an_id_count_as_hits(spark):
    items = spark.createDataFrame([(None, "alpha beta gamma"), (None, "alpha beta gamma"), ("x", "delta")], "item_id string, text string")
    docs = spark.createDataFrame([(1, "so alpha beta gamma it is"), (2, "delta alpha beta gamma"), (3, "alpha beta")], "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r.item_ids) for r in decontaminate.scan(docs, items).collect()}
    assert got == {1: (3, []), 2: (4, ["x"]), 3: (0, [])}


def test_empty_tables(docs, items, empty):
    assert decontaminate.digest(empty, items).count() == 0
    none = decontaminate.digest(docs, items.limit(0)).collect()
    assert len(none) == docs.count() and not any(r.contaminated for r in none)
