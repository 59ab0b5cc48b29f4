"""Benchmark passages in documents: a prefix-filtered set join over word shingles.

Only DataFrame functions. A window is ``window`` consecutive words of an item (a shorter
item is one window) and is the set of its shingles at their places. A document holds a
window only if it holds all of its shingles, so the prefix that any match must share is the
window's rarest shingle alone. One scan of the documents meets the item shingles; from its
matches follow the frequencies over all documents, the candidates (rarest shingle, with the
place it has in the window), and, as each match carries the words around it, the exact check.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamtide.llm.common import stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Item shingles (a hash of 8 bytes each) up to this number are broadcast, 16 MB; beyond it
#: both sides are shuffled on the hash.
BROADCAST_ROWS = 1_000_000
#: Stands for "no shingle" where the shingles are broadcast: the row of a document without matches.
NONE = 0


def words_of(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, window: int, item_id: str, text: str) -> DataFrame:
    """item_id, words, phrase: every distinct window of every item that has words."""
    words = items.select(F.col(item_id).cast("string").alias("item_id"), words_of(F.col(text)).alias("all_words"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("all_words") - window, F.lit(0)))
    return (
        words.where(F.size("all_words") > 0)
        .select("item_id", "all_words", F.explode(starts).alias("at"))
        .select("item_id", F.slice("all_words", F.col("at") + 1, window).alias("words"))
        .withColumn("phrase", F.array_join("words", " ")).distinct()
    )


def shingle_hash(hashes: Column, at: Column, k: int) -> Column:
    """Of the ``k`` words from ``at``, out of the hashes of all words."""
    return F.xxhash64(*(F.get(hashes, at + j) for j in range(k)))


def window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """phrase, length, k, offset, h: the shingles of each distinct window, ``k`` words each."""
    hashed = windows.select("phrase", "words").distinct().select(
        "phrase", F.size("words").alias("length"), F.least(F.size("words"), F.lit(shingle)).alias("k"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    placed = hashed.select("*", F.explode(F.sequence(F.lit(0), F.col("length") - F.col("k"))).alias("offset"))
    by_width = [shingle_hash(F.col("hashes"), F.col("offset"), k) for k in range(1, shingle + 1)]
    return placed.select("phrase", "length", "k", "offset", F.get(F.array(*by_width), F.col("k") - 1).alias("h"))


def shingles_at(hashes: Column, k: int) -> Column:
    last = F.size(hashes) - k
    at = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(i.alias("pos"), shingle_hash(hashes, i, k).alias("h")))
    return F.when(last >= 0, at).otherwise(F.array().cast("array<struct<pos:int,h:bigint>>"))


def around(words: Column, begin: Column, n: int) -> Column:
    """``n`` words from ``begin``, null beyond the end; its cost does not grow with the text, as
    that of a slice does, and it needs no function that would take a row out of generated code."""
    return F.array(*(F.get(words, begin + j) for j in range(n)))


def placed(texts: DataFrame, places: Column) -> DataFrame:
    """A row for each place; one of nulls, which no join keeps, for a text without any.

    The list is made first: a generator over a plain column runs in generated code, which refers
    to the words of the text where it would else copy them. The outer form, as for the other one
    Spark infers that the list is not empty, and works it all out once more below."""
    return texts.select("row", "doc_id", "words", places.alias("places")).select("row", "doc_id", "words", F.inline_outer("places"))


def matches(docs: DataFrame, shingles: DataFrame, window: int, doc_id: str, text: str) -> DataFrame:
    """Every place where an item shingle may stand, with the words around it, and for each
    document one row at place -1.

    Few shingles are broadcast, and one scan yields both. Many are joined by a shuffle that takes
    the words around each place along, never a whole text; the rows at place -1 stay out of it.
    """
    widths = sorted(r.k for r in shingles.select("k").distinct().collect())  # at most `shingle` values
    keys = shingles.select("h").distinct()
    few = keys.count() <= BROADCAST_ROWS
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    if not few:
        rows = stored(rows, "numbered")  # read twice, and the numbers must stay
    texts = rows.select("row", "doc_id", words_of(F.col("text")).alias("words"))
    hashed = texts.select("*", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    start = F.array(F.struct(F.lit(-1).alias("pos"), F.lit(NONE).cast("long").alias("h")))
    at = [shingles_at(F.col("hashes"), k) for k in widths]
    near_at = F.greatest(F.col("pos") - window, F.lit(0))
    near = F.when(F.col("pos") >= 0, around(F.col("words"), near_at, 2 * window))
    columns = "row", "doc_id", F.size("words").cast("long").alias("n_words"), "pos", "h", near_at.alias("near_at"), near.alias("near")
    if few:
        none = docs.sparkSession.range(1).select(F.lit(NONE).cast("long").alias("h"))
        places = placed(hashed, F.concat(start, *at))
        return places.join(F.broadcast(keys.union(none).distinct()), "h").select(*columns)
    found = placed(hashed, F.concat(*at) if at else F.array().cast("array<struct<pos:int,h:bigint>>")).select(*columns).join(keys, "h")
    return found.unionByName(placed(texts, start).select(*columns))


def occurrences(found: DataFrame, shingles: DataFrame) -> DataFrame:
    """row, start, length, phrase: where a window stands in a document, word for word."""
    places = found.where("pos >= 0")
    frequency = places.groupBy("h").agg(F.count("*").alias("n"))
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "h")).alias("rarest")
    prefix = (
        shingles.join(frequency, "h", "left").groupBy("phrase", "length").agg(rarest)
        .select("phrase", "length", "rarest.offset", "rarest.h")
    )
    start = F.col("pos") - F.col("offset")
    words = F.slice("near", F.col("start") - F.col("near_at") + 1, F.col("length"))
    return (
        places.join(prefix, "h").withColumn("start", start)
        .where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
        .where(F.array_join(words, " ") == F.col("phrase"))
        .select("row", "start", "length", "phrase")
    )


def covered_words(found: DataFrame) -> DataFrame:
    """row, n_hit: words inside any occurrence; overlaps count once."""
    before = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    spans = found.groupBy("row", "start").agg(F.max("length").alias("length"))
    return (
        spans.withColumn("reach", F.coalesce(F.max(end).over(before), F.lit(0)))
        .groupBy("row").agg(F.sum(F.greatest(end - F.greatest("start", "reach"), F.lit(0))).alias("n_hit"))
    )


def scan(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5, doc_id: str = "doc_id",
         text: str = "text", item_id: str = "item_id") -> DataFrame:
    """doc_id, n_words, n_hit, item_ids (sorted), one row for each row of ``docs``.

    Null or empty texts have no words and no hits; repeated rows are judged each for itself.
    Items without words count for nothing, repeated items once; the windows of items without an
    id count for ``n_hit``, but such an item has no name to be listed. Without items or
    documents the result has no hits or no rows. Columns other than the named ones are not read.
    """
    windows = stored(item_windows(items, window, item_id, text), "item-windows")
    shingles = stored(window_shingles(windows, shingle), "item-shingles")
    found = stored(matches(docs, shingles, window, doc_id, text), "matches")
    exact = stored(occurrences(found, shingles), "occurrences")
    named = exact.select("row", "phrase").distinct().join(windows.select("phrase", "item_id"), "phrase")
    per_row = named.groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    rows = found.where("pos = -1").select("row", "doc_id", "n_words")
    return rows.join(covered_words(exact), "row", "left").join(per_row, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    return scan(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def oracle_sql(window: int = 10) -> str:
    """The rows of ``digest`` in DuckDB SQL: every window of the items at every place."""
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{WORD}')"
    return f"""WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {words} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), {window}) AS n, array_to_string(w[i + 1 : i + {window}], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(greatest(len(w) - {window - 1}, 1))) AS i FROM items WHERE len(w) > 0)),
docs AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, {words} AS w FROM documents),
places AS (
  SELECT row, i, n, array_to_string(w[i + 1 : i + n], ' ') AS phrase
  FROM (SELECT row, w, n, unnest(range(len(w) - n + 1)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
found AS MATERIALIZED (SELECT row, i, places.n AS n, item_id FROM places JOIN windows ON places.phrase = windows.phrase AND places.n = windows.n),
hits AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS p FROM found) GROUP BY row),
named AS (SELECT row, list_sort(list(DISTINCT item_id) FILTER (item_id IS NOT NULL)) AS ids FROM found GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (row) LEFT JOIN named USING (row)"""
