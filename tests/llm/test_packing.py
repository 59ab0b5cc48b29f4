import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from streamtide.llm import packing
from streamtide.llm.queries import TOKENIZER_FILE

TEXTS = [
    "<|endoftext|> a <|startoftext|>b", "don't !'s 'sfoo ''s it's5 '('s WE'LL", "x́y KKb Ångstrom ≠ a≠b Iİx ΣαΣ",
    "\x00a\x1cb\x7fc   z　q", "a1b22c!!d--e_f`g", "日本語 text 中文!!ok", "é'sé 1́ 2⃣ ﬁ ½",
    "word " * 30_000, "a" * 3_000, "\U0001F600‍\U0001F600",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER_FILE)


@pytest.fixture(scope="module")
def docs(spark, documents):
    extra = spark.createDataFrame([(40_000 + k, t) for k, t in enumerate(TEXTS)] + [(40_000, TEXTS[0]), (None, "no id"), (None, None)], "doc_id long, text string")
    rows = documents.unionByName(extra, allowMissingColumns=True)
    return rows.withColumn("start", rows.kind).withColumn("ids", rows.source).repartition(4, "doc_id").cache()


def encoded(docs, tokenizer):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    return [(d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for d, t in rows]


def test_each_id_lies_in_one_piece_and_nothing_is_padded(docs, tokenizer):
    got = packing.digest(docs, TOKENIZER_FILE).collect()
    per_sequence = {}
    for r in got:
        per_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in per_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at == 2048 or at < 2048 and at & (at - 1) == 0
    times = Counter((d, tuple(ids)) for d, ids in encoded(docs, tokenizer))
    for (d, ids), n in times.items():
        cover = np.zeros(len(ids), int)
        for r in got:
            if r.doc_id == d and r.doc_tokens == len(ids):
                assert zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32
                cover[r.start:r.start + r.length] += 1
        assert (cover == n).all()


def test_sequences_hold_the_ids(docs, tokenizer):
    pieces = packing.pack(docs, TOKENIZER_FILE, capacity=256)
    whole = {}
    for r in pieces.collect():
        whole.setdefault((r.doc_id, r.doc_tokens), {})[r.start] = r.ids
    for d, ids in encoded(docs.where("doc_id < 10000"), tokenizer):
        assert [x for _, part in sorted(whole[d, len(ids)].items()) for x in part] == ids
    made = packing.sequences(pieces, 256, pad_id=7).collect()
    assert sum(r.n_ids for r in made) == pieces.selectExpr("sum(length)").first()[0]
    assert all(len(r.ids) == 256 or len(r.ids) == r.n_ids and r.n_ids & (r.n_ids - 1) == 0 for r in made)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 700), min_size=1, max_size=200), st.sampled_from([64, 100, 256]), st.integers(1, 40))
def test_any_lengths(lengths, capacity, classes):
    got = packing.pack_lengths(np.array(lengths), capacity, classes)
    ends, covered = {}, {}
    for d, s, n, q, o in zip(*(x.tolist() for x in got)):
        assert n > 0
        ends.setdefault(q, []).append((o, n))
        covered.setdefault(d, []).append((s, n))
    for places in [*ends.values(), *covered.values()]:
        at = 0
        for begin, n in sorted(places):
            assert begin == at
            at += n
    assert [sum(n for _, n in covered[d]) for d in range(len(lengths))] == lengths
    sizes = [sum(n for _, n in p) for p in ends.values()]
    assert all(s == capacity or s & (s - 1) == 0 for s in sizes) and max(sizes) <= capacity
    assert sum(s != capacity for s in sizes) <= capacity.bit_length()


def test_classes_keep_most_documents_whole():
    lengths = np.random.default_rng(3).integers(1, 2000, 5_000)
    got = packing.pack_lengths(lengths)
    assert len(got.doc) < 1.6 * len(lengths)
    assert packing.cut_classes(np.array([], int), np.array([], int), 2048, 32) == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aB1'!-_ \n\té́İ ≠中\x00\x1cs"), max_size=25), max_size=6))
def test_ids_are_the_library_s(texts):
    encoder = packing.Encoder.of(open(TOKENIZER_FILE, encoding="utf-8").read())
    ids, counts = encoder.encode(pa.array(texts, pa.string()))
    expected = [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == [x for own in expected for x in own] and counts.tolist() == [len(x) for x in expected]


def test_words_with_one_hash_and_a_full_memory(monkeypatch, tokenizer):
    encoder = packing.Encoder(open(TOKENIZER_FILE, encoding="utf-8").read())
    monkeypatch.setattr(packing, "span_hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
    monkeypatch.setattr(packing, "WORDS", 2)
    texts = ["several words that differ, here", "and a few more words", None]
    for _ in range(2):
        ids, counts = encoder.encode(pa.array(texts))
        assert ids.tolist() == [x for t in texts for x in tokenizer.encode(t or "", add_special_tokens=False).ids]
        assert counts[2] == 0


def test_no_rows_and_no_shuffle(spark, empty):
    assert packing.digest(empty, TOKENIZER_FILE).count() == 0
    plan = packing.digest(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), TOKENIZER_FILE)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_words_encoded_together_have_their_own_ids(tokenizer):
    encoder = packing.Encoder(open(TOKENIZER_FILE, encoding="utf-8").read())
    words = [w.encode() for t in TEXTS for w in t.split(" ") if w and "<|" not in w] + [f"w{k}".encode() for k in range(600)]
    words = list(dict.fromkeys([*words, b"|", b"a||b", "x́|y".encode(), "｜".encode()]))
    own = [np.array(tokenizer.encode(w.decode(), add_special_tokens=False).ids, np.uint32).tobytes() for w in words]
    plain = [(w, x) for w, x in zip(words, own) if b"|" not in w and "｜".encode() not in w]
    assert encoder.together([w for w, _ in plain]) == dict(plain)
    assert encoder.together([b"a", b"b|c"]) == {}  # a mark too many
    assert encoder.pieces_of(words) == own


def test_words_of_letters_are_encoded_by_the_model_alone(tokenizer):
    encoder = packing.Encoder(open(TOKENIZER_FILE, encoding="utf-8").read())
    assert encoder.letters is not None
    texts = ["É é ÉÑß ÀÞ×÷ß ÿŸ qué. É́ Ç,!! \x27É d\x27É É1é ÉǺx ßẞ", "Word WORD word wOrd's IT'S H̱ ẖ J̌x Éa İI KK <|ENDOFTEXT|> A1B|C", "ÅÄ A\x1cB Z\x7fz ABC\x0bDEF", "AB" * 500]
    ids, counts = encoder.encode(pa.array(texts))
    assert ids.tolist() == [x for t in texts for x in tokenizer.encode(t, add_special_tokens=False).ids]
    assert b"word" in encoder.words and b"Word" not in encoder.words
    calls = []
    encoder.tokenizer = type("Counted", (), {"encode_batch_fast": lambda self, words, **_: calls.extend(words) or []})()
    encoder.pieces_of([b"entirely", b"fresh", b"letters"])
    assert not calls or calls == [[]]


def test_other_rules_are_not_taken_for_these(tokenizer):
    rules = open(TOKENIZER_FILE, encoding="utf-8").read().replace('"Lowercase"', '"NFD"', 1)
    encoder = packing.Encoder(rules)
    texts = ["Word WORD word", "É H̱ x"]
    assert encoder.letters is None
    assert encoder.encode(pa.array(texts))[0].tolist() == [x for t in texts for x in encoder.tokenizer.encode(t, add_special_tokens=False).ids]
