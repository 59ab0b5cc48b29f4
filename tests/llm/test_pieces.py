import dataclasses
import itertools

import numpy as np
import pytest

from streamtide.llm import pieces

P = pytest.importorskip("public_tokenizers")
TEXTS = [None, "", "a  b", " lead", "x\ny\tz", "ﬁ ①  é", "a▁b", "trail ", "<s> </s> <unk> <0x41>", "\0\x7f", "   ", "你好" * 100, "ab" * 3000,
         "the cat " * 500, "\U0001F600" * 3, "　 x", "naïve café straße"]

SHORT = [b" ", b"   ", b" the", b" ninth", b" cats", "né".encode(), " 你".encode(), b"x"]


@pytest.fixture(scope="module")
def machine():
    return pieces.load(P.path("piece_bpe_32k.model"))


def words_of(data):
    """Runs of spaces with the other bytes up to the next space."""
    at = 0
    while at < len(data):
        end = at
        while end < len(data) and data[end] == 32:
            end += 1
        while end < len(data) and data[end] != 32:
            end += 1
        yield data[at:end]
        at = end


def test_every_text_comes_back(spark, documents, machine):
    extra = spark.createDataFrame([(50_000 + k, t) for k, t in enumerate(TEXTS)], "doc_id long, text string")
    docs = documents.unionByName(extra, allowMissingColumns=True)
    rows = pieces.digest(docs, machine).collect()
    assert len(rows) == docs.count() and all(r.round_trip for r in rows)
    assert all(r.n_ids == len(r.ids) for r in rows)
    assert {r.n_ids for r in rows if r.doc_id in (50_000, 50_001)} == {0}


def test_all_words_at_once_equal_one_by_one(documents, machine):
    texts = [r.text for r in documents.limit(40).collect()] + TEXTS
    ids, numbers, costs = pieces.encode_texts(texts, machine, machine.by_hash())
    at = 0
    for text, n, cost in zip(texts, numbers, costs):
        own = [pieces.shortest_path(w, machine) for w in words_of(pieces.normalised(text))]
        assert ids[at:at + n].tolist() == [k for path, _ in own for k in path]
        assert cost == pytest.approx(sum(c for _, c in own))
        at += n


def cheapest(word, machine):
    found = []
    for cuts in itertools.product((0, 1), repeat=len(word) - 1):
        marks = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
        parts = [word[a:b] for a, b in zip(marks, marks[1:])]
        if all(p in machine.arcs for p in parts):
            found.append(sum(machine.costs[machine.arcs[p]] for p in parts))
    return min(found)


def test_path_without_pair_weights_is_the_cheapest_of_all(machine):
    plain = dataclasses.replace(machine, merges=False)
    data = b"".join(SHORT)
    sizes = np.array([len(w) for w in SHORT])
    ids, numbers, costs = pieces.shortest_paths(np.frombuffer(data, np.uint8), np.cumsum(sizes) - sizes, sizes, plain, plain.by_hash())
    for word, cost, end, n in zip(SHORT, costs, np.cumsum(numbers), numbers):
        path, own = pieces.shortest_path(word, plain)
        assert own == pytest.approx(cheapest(word, plain)) == pytest.approx(cost)
        assert path == ids[end - n:end].tolist()
        assert b"".join(plain.pieces[k] for k in path) == word


def test_ids_are_those_of_the_library(documents, machine):
    sp = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    texts = [r.text for r in documents.limit(60).collect()] + [t for t in TEXTS if t is None or "\0" not in t]
    texts += ["However, internationalization of Schadenfreude: 12,345.67 €!  \n\n\tdef f(x):\n        return x", "one       two" + " " * 37]
    ids, numbers, _ = pieces.encode_texts(texts, machine, machine.by_hash())
    for text, end, n in zip(texts, np.cumsum(numbers), numbers):
        assert ids[end - n:end].tolist() == sp.encode(text or ""), (text or "")[:80]


def test_odd_ids_and_no_rows(spark, empty, machine):
    rows = spark.createDataFrame([(1, [1, 2, -5, 10**6, None]), (2, None), (3, [259])], "doc_id long, ids array<int>")
    assert [r.decoded for r in pieces.decode(rows, machine).orderBy("doc_id").collect()][:2] == ["", ""]
    assert pieces.digest(empty, machine).count() == 0
