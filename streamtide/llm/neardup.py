"""Near duplicates: bottom-k sketches of one hash function, inverted lists, exact Jaccard.

A document is the set of the hashes of its word shingles; documents with one set are a class,
represented by its least id. A sketch has the ``k`` least hashes. The steps:

1. Inverted lists of the retained values, two neighbours of a sketch at a time. In the order
   of the hash, the values of two sets' union are shared at random, so sets that meet the
   threshold share many values and among them many neighbours: at least ``need``, missed with a
   probability below ``MISS``, and for sets of at most ``k`` values never. Lists with one
   member drop out, and a representative stands only in its rarest lists, all but
   ``need - 1``. So neither frequent words nor a passage that many documents have make them
   meet.
2. Rounds of stars: each member of a list meets one member drawn for the round, so a list of
   any length gives as many pairs as members. Pairs whose sizes cannot meet the threshold are
   left out, then those whose union sketch shares too few values (``least_overlap``). Of what
   is left a member is compared with two centres a round, on full sets: the one that most others
   meet and the one most alike. So a group costs as many comparisons as it has members, however
   many lists hold them; pairs that were left over come again while their lists are open.
   Links make components, and lists within one component are closed.
3. When a round has not closed a tenth of the open pairs, the whole sets of the open lists'
   members are joined: values in the order of their frequency, with prefix, size and position
   filters, for members whose components differ. Values that stand in the prefixes of many make
   these a crowd. Its members are told by their differences from the values that most of it
   have: two sets differ as their differences do, and the edits of a member, unlike the text
   that all share, are met by few (``differing_pairs``). Of these pairs a few for each two
   components are compared first, then all whose components still differ. No pair that could
   link two components is left untested.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamtide.llm.common import DARK, LOWER, as_bytes, discard, in_tasks, mixed, shingle_hashes, slices, span_hashes, stored, word_spans
from streamtide.llm.components import stars

K = 96
MISS = 1e-10
#: In the last round, so many pairs of two components are tried before all others.
PICKS = 32
#: A value in the prefixes of more members than this makes them a crowd.
CROWD = 64
#: Sets to be compared are broadcast up to this size; beyond it pairs and sets are shuffled.
BROADCAST_BYTES = 32_000_000
#: Rows of ids and keys (24 bytes at most) up to this number are broadcast, 48 MB; beyond it
#: they are shuffled.
BROADCAST_IDS = 2_000_000


def least_overlap(k: int, percent: int) -> int:
    """The largest overlap that k draws, each shared with the threshold's probability, miss
    with a probability below MISS. Draws without replacement miss it less often."""
    p, total = percent / 100, 0.0
    for shared in range(k + 1):
        total += math.comb(k, shared) * p ** shared * (1 - p) ** (k - shared)
        if total > MISS:
            return shared
    return k


def shared_neighbours(k: int, percent: int) -> list[int]:
    """For each size of a set up to k, and last for larger ones, how many pairs of neighbours
    it shares at least with any set that meets the threshold."""
    least = [1]
    for n in range(1, k + 1):
        unions = range(n, 100 * n // percent + 1)
        others = [u - -(-percent * u // 100) for u in unions]  # each parts two pairs at most
        least.append(max(1, min(min(u, k) - 1 - 2 * o for u, o in zip(unions, others))))
    p = percent / 100
    apart, shared = np.zeros(k + 1), np.zeros(k + 1)  # by pairs so far; the last value shared or not
    apart[0] = 1.0
    for _ in range(k):
        apart, shared = (apart + shared) * (1 - p), apart * p + np.append(0, shared[:-1] * p)
    return [*least, int((np.cumsum(apart + shared) <= MISS).sum())]


def shingle_sets(part: pa.RecordBatch, text: str, width: int):
    """The distinct hashes of each text, sorted, end to end; the number of each."""
    data, offsets = as_bytes(part.column(text))
    data = LOWER[data]
    starts, ends, firsts = word_spans(data, offsets, DARK)
    hashes, owner = shingle_hashes(span_hashes(data, starts, ends), firsts, width)
    hashes >>= np.uint64(1)  # as signed longs they keep their order
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[fresh], np.bincount(owner[fresh], minlength=part.num_rows)


def lists_of(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(flat.view(np.int64)))


def sketches(docs: DataFrame, width: int, k: int) -> DataFrame:
    """doc_id, n (size of the set), key_a and key_b (the set as 128 bits), sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                hashes, counts = shingle_sets(part, "text", width)
                ends = np.cumsum(counts)
                sums = [np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes ^ np.uint64(salt)), dtype=np.uint64)]) for salt in (0x51, 0xA7F3)]
                keys = [pa.array((s[ends] - s[ends - counts]).view(np.int64)) for s in sums]
                rank = np.arange(len(hashes)) - np.repeat(ends - counts, counts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts), *keys, lists_of(hashes[rank < k], np.minimum(counts, k))],
                    ["doc_id", "n", "key_a", "key_b", "sketch"])

    return in_tasks(docs, run, "doc_id long, n long, key_a long, key_b long, sketch array<long>")


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """id, hashes: the whole set of each document, sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists_of(*shingle_sets(part, "text", width))], ["id", "hashes"])

    return in_tasks(docs, run, "id long, hashes array<long>")


def with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The stored pairs hub, spoke with the sets of both. A hub has many pairs: few sets are read
    for that end, often so few that they are broadcast and the other sets stay where they are."""
    for end in ("spoke", "hub"):
        ids = stored(pairs.select(F.col(end).alias("id")).distinct(), f"{end}s")
        own, small = light(sets.join(few(ids), "id", "left_semi"), "hashes")
        own = own.select(F.col("id").alias(end), F.col("hashes").alias(f"set_{end}"))
        pairs = pairs.join(F.broadcast(own) if small else own, end)
    return pairs


def light(rows: DataFrame, values: str, width: int = 8) -> tuple[DataFrame, bool]:
    """The table of ids and lists, and whether it is small enough to be broadcast."""
    return rows, rows.agg(F.coalesce(F.sum(F.size(values) * width + 32), F.lit(0))).first()[0] <= BROADCAST_BYTES


def with_both(pairs: DataFrame, rows: tuple[DataFrame, bool], values: str, name: str) -> DataFrame:
    """The pairs a, b with the values of both, broadcast or shuffled."""
    one, two = (rows[0].select(F.col("id").alias(x), F.col(values).alias(f"{name}_{x}")) for x in "ab")
    if rows[1]:
        one, two = F.broadcast(one), F.broadcast(two)
    return pairs.join(one, "a").join(two, "b")


def linked(pairs: DataFrame, percent: int) -> DataFrame:
    """a, b of the pairs whose full sets meet the threshold."""
    both = pairs.withColumn("shared", F.size(F.array_intersect("set_hub", "set_spoke")))
    union = F.size("set_hub") + F.size("set_spoke") - F.col("shared")
    linked = both.where(F.col("shared") * 100 >= union * percent)
    return linked.select(F.least("hub", "spoke").alias("a"), F.greatest("hub", "spoke").alias("b"))


def inverted_lists(classes: DataFrame, k: int, percent: int) -> DataFrame:
    """value, id, n: the lists in which each representative must stand; a value is two neighbours."""
    pairs = F.transform(F.sequence(F.lit(1), F.size("sketch") - 1), lambda i: F.xxhash64(F.get("sketch", i - 1), F.get("sketch", i)))
    values = classes.where(F.size("sketch") > 1).select(F.explode(pairs).alias("value"), "id")
    shared = values.groupBy("value").agg(F.count("*").alias("frequency")).where("frequency > 1")
    own = values.join(shared, "value").groupBy("id").agg(F.sort_array(F.collect_set(F.struct("frequency", "value"))).alias("own"))
    own = own.join(classes.select("id", "n"), "id")
    need = F.get(F.array(*map(F.lit, shared_neighbours(k, percent))), F.least(F.col("n"), F.lit(k + 1)).cast("int"))
    places = F.size("own") - need + 1
    return own.where(places > 0).select("id", "n", F.explode(F.slice("own", F.lit(1), places)).alias("one")).select("one.value", "id", "n")


def sizes_agree(n: Column, m: Column, percent: int) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def sketches_agree(a: Column, b: Column, k: int, percent: int) -> Column:
    """The sketch of the union has enough values of both; exact where it is the whole union."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, k)
    need = F.when(F.size(union) < k, F.ceil(F.size(union) * percent / 100)).otherwise(F.lit(least_overlap(k, percent)))
    return F.size(F.array_intersect(union, F.array_intersect(a, b))) >= need


def star_pairs(members: DataFrame, turn: int, percent: int) -> DataFrame:
    """a, b, hub: the pairs of members and centres, a less than b; the hub is the centre."""
    drawn = F.min(F.struct(F.xxhash64("id", F.lit(turn)), F.col("id").alias("other"), F.col("n").alias("m"), F.col("part").alias("other_part")))
    centres = members.groupBy("value").agg(drawn.alias("centre")).select("value", "centre.other", "centre.m", "centre.other_part")
    met = members.join(centres, "value").where((F.col("part") != F.col("other_part")) & sizes_agree(F.col("n"), F.col("m"), percent))
    ends = F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")
    return met.groupBy(*ends).agg(F.min("other").alias("hub"))


def spoke_of() -> Column:
    return F.when(F.col("hub") == F.col("a"), F.col("b")).otherwise(F.col("a"))


def nearest_hubs(pairs: DataFrame, turn: int) -> DataFrame:
    """Of the pairs a, b, hub, alike of a spoke two at most: that with the centre that was drawn
    first, as for most members of a group, and that with the most values shared."""
    ends = F.struct("a", "b", "hub")
    first = F.min_by(ends, F.struct(F.xxhash64("hub", F.lit(turn)), "hub"))
    best = F.max_by(ends, F.struct("alike", F.xxhash64("hub", F.lit(turn)), "hub"))
    picked = pairs.groupBy(spoke_of().alias("spoke")).agg(F.array_distinct(F.array(first, best)).alias("picked"))
    return picked.select(F.inline("picked"))


def all_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b, bound: of the members of the open lists all that may meet the threshold and have
    different parts, with the overlap that they cannot exceed.

    Each set is put in order, the values that the fewest members have first. Two sets share no
    more than what either has left from the first value on that they share: values that a set
    has for itself stand before all others, so they count against it and are left out here.
    """
    own = stored(members.select("id", "n", "part").distinct(), "open-members")
    values = sets.join(few(own.select("id")), "id", "left_semi").select("id", F.explode("hashes").alias("hash"))
    frequency = values.groupBy("hash").agg(F.count("*").alias("c")).where("c > 1")
    backwards = Window.partitionBy("id").orderBy(F.desc("c"), F.desc("hash"))
    shared = values.join(frequency, "hash").withColumn("left", F.row_number().over(backwards)).drop("c").join(few(own), "id")
    prefix = stored(shared.where(F.col("left") * 100 >= F.col("n") * percent), "prefix")
    crowded = stored(prefix.groupBy("hash").agg(F.count("*").alias("c"), F.min("id").alias("centre")).where(F.col("c") > CROWD).drop("c"), "crowded")
    at_most, both = F.least("left", "other_left"), F.col("n") + F.col("other_n")
    met = across(prefix.join(few(crowded), "hash", "left_anti"), ["hash"], at_most * (100 + percent) >= both * percent, at_most)
    if crowded.isEmpty():
        return met
    crowds = stars(prefix.join(few(crowded), "hash").select(F.col("centre").alias("a"), F.col("id").alias("b")))
    met = met.unionByName(differing_pairs(stored(differences(own, sets, crowds), "differences"), percent))
    return met.groupBy("a", "b", "part_a", "part").agg(F.max("bound").alias("bound"))


def across(rows: DataFrame, on: list[str], enough: Column, bound: Column) -> DataFrame:
    """a, b, part_a, part, bound of the rows that share ``on``, have different parts and meet the
    condition; in it the columns of the other row begin with other_."""
    other = rows.select(*on, *(F.col(c).alias(f"other_{c}") for c in rows.columns if c not in on))
    met = rows.join(other, on).where((F.col("id") < F.col("other_id")) & (F.col("part") != F.col("other_part")) & enough)
    ends = F.col("id").alias("a"), F.col("other_id").alias("b"), F.col("part").alias("part_a"), F.col("other_part").alias("part")
    return met.groupBy(*ends).agg(F.max(bound).alias("bound"))


def differences(own: DataFrame, sets: DataFrame, crowds: DataFrame) -> DataFrame:
    """crowd, id, n, part, key (of the set), hashes: the values that a member has and most of its
    crowd have not, and those that most have and it has not. ``crowds`` has components as ``stars``
    gives them. What most have has at most twice the values of a member on the average."""
    named = stored(crowds.union(crowds.select("a", F.col("a").alias("b"))).distinct().select(F.col("b").alias("id"), F.col("a").alias("crowd")), "crowds")
    rows = sets.join(few(named), "id").join(few(own), "id").where(F.size("hashes") == F.col("n"))
    members = stored(rows.groupBy("crowd").agg(F.count("*").alias("members")), "crowd-sizes")
    counts = rows.select("crowd", F.explode("hashes").alias("hash")).groupBy("crowd", "hash").agg(F.count("*").alias("c"))
    common = counts.join(few(members), "crowd").where("2 * c > members").groupBy("crowd").agg(F.collect_list("hash").alias("common"))
    common, small = light(stored(common, "common"), "common")
    told = rows.join(F.broadcast(common) if small else common, "crowd", "left").withColumn("common", F.coalesce("common", F.array().cast("array<long>")))
    apart = F.concat(F.array_except("hashes", "common"), F.array_except("common", "hashes"))
    return told.select("crowd", "id", "n", "part", F.xxhash64("hashes").alias("key"), apart.alias("hashes"))


def differing_pairs(members: DataFrame, percent: int) -> DataFrame:
    """a, b, part_a, part, bound as ``all_pairs`` has them, of members of one crowd.

    Sets A and B have |A - B| + |B - A| = d + e - 2 s values apart, with d and e differences from
    what is common and s of them shared. The threshold allows (n + m) (100 - percent) / (100 +
    percent), so 2 (100 + percent) s must reach the sum of the two weights. Differences stand in
    order, those that the fewest members have first, as values do in ``all_pairs``. Where the sum
    is not positive the pair is linked; so is each of the two with the member of least weight,
    and these pairs stand for all such.
    """
    apart = F.size("hashes").cast("long")
    weight = apart * (100 + percent) - F.col("n") * (100 - percent)
    rows = members.withColumn("apart", apart).withColumn("weight", weight)
    values = rows.withColumn("hash", F.explode("hashes")).drop("hashes")
    frequency = values.groupBy("crowd", "hash").agg(F.count("*").alias("c")).where("c > 1")
    backwards = Window.partitionBy("id", "key").orderBy(F.desc("c"), F.desc("hash"))
    shared = values.join(frequency, ["crowd", "hash"]).withColumn("left", F.row_number().over(backwards)).drop("c")
    # a partner has at most 100 / percent times the values, and so at least the own weight less 2 (100 - percent) for each
    prefix = stored(shared.where(F.col("left") * (100 + percent) * percent >= F.col("weight") * percent - F.col("n") * 100 * (100 - percent)), "edits")
    at_most, weights = F.least("left", "other_left"), F.col("weight") + F.col("other_weight")
    enough = (weights > 0) & (at_most * 2 * (100 + percent) >= weights) & sizes_agree(F.col("n"), F.col("other_n"), percent)
    shared_before = ((F.col("n") + F.col("other_n") - F.col("apart") - F.col("other_apart")) / 2).cast("long")
    met = across(prefix, ["crowd", "hash"], enough, shared_before + at_most)

    least = stored(rows.groupBy("crowd").agg(F.min(F.struct("weight", "id", "n", "part")).alias("least")), "least")
    sure = rows.drop("hashes").join(few(least), "crowd").where("weight + least.weight <= 0 and id != least.id and part != least.part")
    first = F.col("id") < F.col("least.id")
    return met.unionByName(sure.select(
        F.least("id", "least.id").alias("a"), F.greatest("id", "least.id").alias("b"),
        F.when(first, F.col("part")).otherwise(F.col("least.part")).alias("part_a"),
        F.when(first, F.col("least.part")).otherwise(F.col("part")).alias("part"),
        F.least("n", "least.n").alias("bound")))


def best_pairs(pairs: DataFrame, parts: DataFrame | None, picks: int | None) -> DataFrame:
    """The pairs whose parts still differ; with ``picks`` about that many for each two parts,
    those with the highest bounds: one link spares the others."""
    if picks is None:
        now = with_parts(pairs.select("a", "b", F.col("a").alias("hub")), parts, "a").withColumnRenamed("part", "part_a")
        return with_parts(now, parts, "b").where("part_a != part").select("a", "b", "hub")
    slot = F.pmod(F.xxhash64("a", "b"), F.lit(picks))
    ends = F.least("part_a", "part").alias("low"), F.greatest("part_a", "part").alias("high")
    best = pairs.groupBy(*ends, slot.alias("slot")).agg(F.max(F.struct("bound", "a", "b")).alias("best"))
    return best.select("best.a", "best.b", F.col("best.a").alias("hub"))


def with_parts(rows: DataFrame, parts: DataFrame | None, key: str) -> DataFrame:
    if parts is None:
        return rows.withColumn("part", F.col(key))
    return rows.join(parts.select(F.col("b").alias(key), F.col("a").alias("least")), key, "left").withColumn(
        "part", F.coalesce("least", F.col(key))).drop("least")


def open_lists(lists: DataFrame, parts: DataFrame | None) -> tuple[DataFrame, int]:
    """The members of lists with several components, and how many pairs lie across these."""
    members = with_parts(lists, parts, "id")
    by_part = members.groupBy("value", "part").agg(F.count("*").alias("c"))
    per_list = by_part.groupBy("value").agg(F.count("*").alias("parts"), F.sum("c").alias("c"), F.sum(F.col("c") * F.col("c")).alias("squares"))
    across = ((F.col("c") * F.col("c") - F.col("squares")) / 2).cast("long")
    still = stored(per_list.where("parts > 1").select("value", across.alias("pairs")), "open")
    pairs = still.agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0]
    return members.join(still.select("value"), "value", "left_semi"), int(pairs)


def few(ids: DataFrame) -> DataFrame:
    """The stored table of ids, to be broadcast if they are few."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def links(docs: DataFrame, classes: DataFrame, drawn: DataFrame, width: int, percent: int, k: int) -> DataFrame | None:
    """Parts (a the least, b any other id) of the representatives; None if there is no link.
    ``drawn``, the stored table behind ``classes``, is deleted when both have been read."""
    lists = stored(inverted_lists(classes, k, percent), "lists")
    active = stored(lists.select("id").distinct(), "active")
    if active.isEmpty():
        discard(drawn)
        return None
    active = few(active)
    upper = F.transform("sketch", lambda x: F.shiftright(x, 32).cast("int"))  # enough to estimate, in the same order
    kept = light(stored(classes.join(active, "id", "left_semi").select("id", upper.alias("sketch")), "kept"), "sketch", 4)
    discard(drawn)
    sets = stored(full_sets(docs.join(active, docs.doc_id == active.id, "left_semi").select("doc_id", "text"), width), "sets")
    parts, tested, edges, turn, before = None, None, None, 0, None

    def compared(near: DataFrame) -> None:
        """Adds the links among the pairs to the components."""
        nonlocal edges, parts
        sure = stored(linked(with_sets(near.select("hub", spoke_of().alias("spoke")), sets), percent), "links")
        if not sure.isEmpty():
            edges = parts = stars(sure if edges is None else edges.union(sure))

    while True:
        members, pairs = open_lists(lists, parts)
        if not pairs:
            return parts
        if before is not None and 10 * pairs > 9 * before:
            break
        met = star_pairs(members, turn, percent)
        if tested is not None:
            met = met.join(tested, ["a", "b"], "left_anti")
        both = with_both(met, kept, "sketch", "sketch")
        alike = both.where(sketches_agree(F.col("sketch_a"), F.col("sketch_b"), k, percent)).select(
            "a", "b", "hub", F.size(F.array_intersect("sketch_a", "sketch_b")).alias("alike"))
        near = stored(nearest_hubs(alike, turn), "near")
        compared(near)
        tested = near.select("a", "b") if tested is None else tested.union(near.select("a", "b"))
        turn, before = turn + 1, pairs
    met = stored(all_pairs(members, sets, percent).join(tested, ["a", "b"], "left_anti"), "met")
    for picks in (PICKS, None):
        compared(stored(best_pairs(met, parts, picks), "near"))
    return parts


def groups(docs: DataFrame, width: int = 5, percent: int = 80, k: int = K, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row for each row of ``docs``.

    component_id is the least id reachable by links of at least ``percent`` Jaccard similarity;
    kept is whether the row has it. A text with fewer than ``width`` words is one shingle;
    without words, null or empty, it has none and links with nothing. A row without an id links
    with nothing, has no component and is kept. Repeated rows get the same answer; of rows that
    share an id each is judged by its own text, and groups that such an id represents are one.
    Other columns are not read. The threshold must be two thirds at least, and ``k`` so large that
    neighbours are sure to be shared.
    """
    if percent < 67 or not shared_neighbours(k, percent)[-1]:
        raise ValueError(f"sketches of {k} values miss sets that are alike to {percent} percent")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    drawn = stored(sketches(rows, width, k), "sketches")
    usable = drawn.where("n > 0 and doc_id is not null")
    keys = stored(usable.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("id"), F.count("*").alias("c")).where("c > 1").drop("c"), "classes")
    copies = stored(usable.join(few(keys), ["key_a", "key_b"]).where("doc_id != id").select("doc_id").distinct(), "copies")
    classes = usable.join(few(copies), "doc_id", "left_anti").select(F.col("doc_id").alias("id"), "n", "sketch")
    plain = stored(drawn.select("doc_id", "n", "key_a", "key_b"), "plain")
    parts = links(rows, classes, drawn, width, percent, k)
    named = plain.join(keys, ["key_a", "key_b"], "left").withColumn("id", F.coalesce("id", "doc_id"))
    part = with_parts(named, parts, "id").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("part")).otherwise(F.col("doc_id")).alias("component_id"))
    return part.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def digest(docs: DataFrame) -> DataFrame:
    return groups(docs, width=2)
