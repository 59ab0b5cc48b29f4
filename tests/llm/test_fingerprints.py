import hashlib

import numpy as np
import pyarrow as pa
import pytest

from streamtide.llm import fingerprints


def brute_edits(rows):
    """doc_id, n_chars, sha256 of the edited text, by ascending id; texts with one id in any order."""
    rows = [(d, t or "") for d, t in rows]
    out = []
    for k, (d, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        q = len(t) // 4
        out.append((d, len(t), hashlib.sha256((t[:len(t) - q] + after[:q]).encode()).hexdigest()))
    return out


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    return {tuple(words[i:i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


@pytest.mark.parametrize("some", ["doc_id >= 0", "doc_id < 3", "doc_id = 5", "doc_id > 9990"])
def test_edits_equal_brute_force(documents, some):
    docs = documents.where(some)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = fingerprints.edits(docs).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == brute_edits(rows)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    prints = {r.doc_id: r.fingerprint for r in got}
    own = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(docs).collect()}
    assert prints == own


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c"), (None, None), (1, "x y"), (1, "x y"), (1, "z"), (2, "four five six seven")]
    got = fingerprints.edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 6 and sorted(str(r.doc_id) for r in got) == ["1", "1", "1", "2", "None", "None"]
    assert next(r for r in got if r.doc_id == 2).edited_sha256 in {
        hashlib.sha256(("four five six s" + t[:4]).encode()).hexdigest() for t in ("a b c", "")}


def test_likeness_estimates_the_similarity(documents):
    rows = [r.text for r in documents.where("length(text) > 800").limit(60).collect()]
    changed = [t[:len(t) - len(t) // k] + rows[-1][:len(t) // k] for t, k in zip(rows, [3, 4, 6, 12, 40] * 12)]
    truth = np.array([len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) for a, b in zip(rows, changed)])
    got = fingerprints.likeness(*fingerprints.signatures(pa.array(rows)), *fingerprints.signatures(pa.array(changed)))
    assert np.abs(got - truth).max() < 0.15 and abs((got - truth).mean()) < 0.02


def test_equal_texts_and_texts_without_words(documents):
    got = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(documents).collect()}
    assert got[10_008] == got[10_009] != got[10_003]
    assert got[10_000] == got[10_001] == got[10_002] == "" and len(got[10_003]) == fingerprints.BINS * fingerprints.BITS // 4


def test_no_rows(empty):
    assert fingerprints.edits(empty).count() == fingerprints.fingerprint(empty).count() == 0
