import re

import pytest

from streamtide.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}
NOTICE = list(licenses.TEMPLATES.values())
TEXTS = [
    "Under the MIT license, under the mit License!", "cc by nc cc-by-nc by nc", "Licensed under the Apache License, Version 2.0.",
    "x " * 50 + NOTICE[1].replace("file", "thing").upper() + " y" * 50, NOTICE[0] + " and " + NOTICE[0], " ".join(NOTICE[2].split()[:8]),
    "This work is licensed under the GNU General Public License, version 3.", " ".join(reversed(NOTICE[3].split())),
    "general public license gnu version 3 this work is", "mit license under the", "été under the mit license 你好", "license " * 500,
]


def words_of(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(text):
    words = words_of(text)
    places = sorted((i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words))
                    if words[i:i + len(phrase.split())] == phrase.split())
    met = {}
    for label, body in licenses.TEMPLATES.items():
        own = words_of(body)
        n = min(len(own), len(words))
        for i in range(len(words) - n + 1 if words else 0):
            share = len(set(own) & set(words[i:i + n])) / len(set(own))
            if share >= 0.8 - 1e-12:
                met.setdefault(label, set()).update(range(i, i + n))
    return words, places, met


@pytest.fixture(scope="module")
def docs(spark, documents):
    extra = spark.createDataFrame([(40_000 + k, t) for k, t in enumerate(TEXTS)] + [(None, TEXTS[0])], "doc_id long, text string")
    return documents.unionByName(extra, allowMissingColumns=True).cache()


def test_equals_brute_force(docs):
    texts = [r.text for r in docs.collect()]
    expected = []
    for text in texts:
        words, places, met = brute(text)
        base, every = sorted({x for _, x in places}), sorted({x for _, x in places} | set(met))
        starts = [s for s, _ in places] or [None]
        expected.append((len(words), len(places), starts[0], starts[-1], ",".join(base), ",".join(every)))
    got = [tuple(r[1:7]) for r in licenses.digest(docs).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    assert {"gpl-3", "apache-2", "bsd"} <= {x for r in got for x in r[5].split(",")}


def test_notice_runs_cover_the_same_words(docs):
    rows = licenses.scan(docs, keep=("doc_id", "text")).collect()
    for r in rows:
        covered = {}
        for n in r.notices:
            covered.setdefault(n.label, set()).update(range(n.start, n.end))
            assert 0.8 <= n.containment <= 1
        assert covered == brute(r.text)[2]


def test_empty_table(empty):
    assert licenses.digest(empty).count() == 0
