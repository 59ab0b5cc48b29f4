import random
import re

import pytest

from streamtide.llm import neardup
from streamtide.llm.components import stars


def brute(rows, width, percent):
    sets = {}
    for doc, text in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lower)
        sets[doc] = {tuple(words[i:i + width]) for i in range(max(len(words) - width + 1, 1))} if words else set()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if min(len(sets[a]), len(sets[b])) * 100 < percent * max(len(sets[a]), len(sets[b])):
                continue
            shared = len(sets[a] & sets[b])
            if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sorted((d, len(sets[d]), find(d), find(d) == d) for d in sets)


def edited(rng, words, rate):
    return [rng.choice("pqrstuv") + str(rng.randrange(99)) if rng.random() < rate else w for w in words]


@pytest.fixture(scope="module")
def docs(spark, documents):
    rng = random.Random(5)
    rows = []
    base = [f"w{rng.randrange(400)}" for _ in range(160)]
    for k in range(70):  # a large group around the threshold, without its origin
        rows.append(" ".join(edited(rng, base, 0.055)))
    chain = [f"c{i}" for i in range(60)]
    for k in range(25):  # each close to the next only
        chain = chain[2:] + [f"c{100 + 2 * k}", f"c{101 + 2 * k}"]
        rows.append(" ".join(chain))
    for n in (1, 2, 3, 6, 9, 11, 64, 65, 66, 90):  # small sets, and sets about as large as a sketch
        own = [f"s{n}x{i}" for i in range(n)]
        rows += [" ".join(own), " ".join(own + ["tail"]), " ".join(own[:-1] + ["other"]), " ".join(["in", "the"] * 3 + own)]
    extra = spark.createDataFrame([(60_000 + k, t) for k, t in enumerate(rows)], "doc_id long, text string")
    return documents.where("doc_id >= 10000 or doc_id < 120").unionByName(extra, allowMissingColumns=True).cache()


@pytest.mark.parametrize("width, percent, k", [(2, 80, 96), (5, 80, 64), (2, 70, 96)])
def test_equals_brute_force(docs, width, percent, k):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    expected = brute(rows, width, percent)
    got = sorted(tuple(r) for r in neardup.groups(docs, width, percent, k).select("doc_id", "n_shingles", "component_id", "kept").collect())
    assert got == expected
    assert sum(not r[3] for r in got) > 40


def test_large_tables_are_shuffled(docs, monkeypatch):
    monkeypatch.setattr(neardup, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(neardup, "BROADCAST_IDS", 0)
    some = docs.where("doc_id >= 60000")
    rows = [(r.doc_id, r.text) for r in some.select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in neardup.groups(some, 2).collect()) == brute(rows, 2, 80)


def test_null_ids_repeated_rows_and_no_rows(spark, empty):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(None, text), (None, text), (3, text), (3, text), (2, text), (4, None), (5, "  "), (6, "one")]
    got = neardup.groups(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert sorted(map(str, ((r.doc_id, r.component_id, r.kept) for r in got))) == sorted(map(str, [
        (None, None, True), (None, None, True), (3, 2, False), (3, 2, False), (2, 2, True), (4, 4, True), (5, 5, True), (6, 6, True)]))
    assert neardup.groups(empty).count() == 0


def test_bounds():
    assert neardup.least_overlap(64, 80) in range(24, 34) and neardup.least_overlap(8, 80) == 0
    least = neardup.shared_neighbours(96, 80)
    assert len(least) == 98 and min(least) == 1 and 15 < least[97] < 25
    rng = random.Random(1)
    for _ in range(3000):  # whole sets share at least so many neighbours
        union = rng.randrange(2, 97)
        both = sorted(rng.sample(range(union), -(-80 * union // 100)))
        rest = [x for x in range(union) if x not in both]
        a, b = (sorted(both + [x for x in rest if rng.random() < 0.5]) for _ in "ab")
        pairs = set(zip(a, a[1:])) & set(zip(b, b[1:]))
        if 100 * len(both) >= 80 * len(set(a) | set(b)):
            assert len(pairs) >= max(least[len(a)], least[len(b)])


def test_threshold_that_the_lists_cannot_keep(empty):
    with pytest.raises(ValueError):
        neardup.groups(empty, 2, 60)


def test_stars_reach_the_least_node(spark):
    path = [(i, i + 1) for i in range(100, 160)] + [(7, 3), (3, 9), (9, 9), (3, 7)]
    got = {r.b: r.a for r in stars(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, 7: 3, 9: 3}


def test_a_member_meets_two_centres_a_round(spark):
    rows = [(0, s, h, s * h % 7) for s in range(1, 40) for h in range(100, 130)]
    pairs = spark.createDataFrame([(s, h, h, alike) for _, s, h, alike in rows], "a long, b long, hub long, alike int")
    picked = [tuple(r) for r in neardup.nearest_hubs(pairs, 3).collect()]
    by_spoke = {s: [h for a, h, _ in picked if a == s] for s in range(1, 40)}
    assert len(picked) == len(set(picked)) and all(1 <= len(hubs) <= 2 for hubs in by_spoke.values())
    common = set.intersection(*map(set, by_spoke.values()))
    assert common  # the centre drawn first is the same for all
    for s, hubs in by_spoke.items():
        assert any(s * h % 7 == max(s * x % 7 for x in range(100, 130)) for h in hubs)


def crowd_of(spark, rng, members):
    """Sets of one text with edits of its own in each, mostly too many to link any two."""
    base = list(range(1, 148))
    sets = []
    for k in range(members):
        gone = set(rng.sample(base, rng.randrange(9, 15)))
        sets.append((k, sorted(x for x in base if x not in gone) + [1000 * (k + 1) + i for i in range(len(gone))]))
    members = spark.createDataFrame([(k, len(s), k) for k, s in sets], "id long, n long, part long")
    return dict(sets), members, spark.createDataFrame(sets, "id long, hashes array<long>")


def test_a_crowd_that_does_not_link_is_not_joined_in_all_pairs(spark):
    sets, members, rows = crowd_of(spark, random.Random(4), 300)
    met = {(r.a, r.b): r.bound for r in neardup.all_pairs(members, rows, 80).collect()}
    linked = 0
    for a in sets:
        for b in range(a + 1, len(sets)):
            both = len(set(sets[a]) & set(sets[b]))
            if 180 * both >= 80 * (len(sets[a]) + len(sets[b])):
                linked += 1
                assert met[a, b] >= both
    assert linked and len(met) < 300 * 299 / 2 / 3


def test_crowds_equal_brute_force(docs, monkeypatch):
    monkeypatch.setattr(neardup, "CROWD", 2)
    some = docs.where("doc_id >= 60000")
    rows = [(r.doc_id, r.text) for r in some.select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in neardup.groups(some, 2).collect()) == brute(rows, 2, 80)


def test_members_near_what_a_crowd_shares_are_linked_by_one(spark):
    base = list(range(1, 101))
    sets = [(k, base[:k] + base[k + 1:] + [1000 + k]) for k in range(80)] + [(90, base), (91, list(range(5000, 5100)))]
    members = spark.createDataFrame([(k, len(s), k) for k, s in sets], "id long, n long, part long")
    rows = spark.createDataFrame(sets, "id long, hashes array<long>")
    crowds = spark.createDataFrame([(0, k) for k, _ in sets[1:]], "a long, b long")
    told = neardup.differences(members, rows, crowds).cache()
    assert {r.id: sorted(r.hashes) for r in told.collect()} == {k: sorted(set(s) ^ set(base)) for k, s in sets}
    assert sorted((r.a, r.b) for r in neardup.differing_pairs(told, 80).collect()) == [(k, 90) for k in range(80)]
