"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Only DataFrame functions; one pass over the rows and no shuffle. A pattern is never tried
twice over the same run of characters. The spans of a text are gathered block by block, about as
many blocks as a block has places, and their surroundings are cut from short stretches of the
text, so very long texts with very many spans cost little more than their length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Base kinds, in the order in which spans with one start are listed. Matches are leftmost
#: and do not overlap; \G lets a match start where the last one ended, else it starts at the
#: beginning of a run. Possessive repeats give the same matches and need no stack. For an IBAN
#: only the first four characters are taken, and the group is the run from there: words and
#: other numbers may follow, so ``account_number`` looks for its end.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])))[A-Z]{2}[0-9]{2}",
}
BASE_KINDS = ("email", "ip", "card", "phone")
#: A text without this cannot hold the kind.
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9]", "phone": r"\+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}"}
#: Score of a span that passed its check, before context.
CONFIDENCE = {"email": 0.8, "ip": 0.5, "card": 0.7, "phone": 0.5, "iban": 0.9}
SUPPORT = {
    "email": r"(?i)\b(?:e-?mail|contact|write|reach|send)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|login|from)\b",
    "card": r"(?i)\b(?:card|credit|visa|mastercard|payment|paid|cvv)\b",
    "phone": r"(?i)\b(?:phone|call|tel|mobile|fax|whatsapp)\b",
    "iban": r"(?i)\b(?:iban|bank|account|transfer|konto)\b",
}
DOUBT = r"(?i)\b(?:example|sample|test|dummy|version|order|invoice|isbn)\b"
#: Registered lengths of IBANs by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
#: Characters on either side that count as near.
NEAR = 40
#: Code points of a stretch of text; at least NEAR.
STRETCH = 256


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(number: Column) -> Column:
    """Every second digit from the right doubled, less nine above nine; the sum ends in 0."""
    back = F.split(F.reverse(number), "")

    def step(total: Column, at: Column) -> Column:
        digit = F.element_at(back, at + 1).cast("int") * (at % 2 + 1)
        return total + digit - F.when(digit > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), step) % 10 == 0


def passes_mod97(value: Column) -> Column:
    """The first four characters moved to the end, letters as 10 to 35, must leave 1."""
    plain = F.regexp_replace(value, " ", "")
    moved = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))

    def step(rest: Column, sign: Column) -> Column:
        code = F.ascii(sign)
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def confirmed(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: F.ltrim(part, F.lit("0")).rlike(
            "^(?:[0-9]{0,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        number = digits(value)
        return F.length(number).between(12, 19) & passes_luhn(number)
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(value, " ", "")).between(15, 34) & passes_mod97(value)
    return F.lit(True)


def account_number(run: Column) -> Column:
    """The IBAN that a run of tokens begins with, or null: the tokens that make the registered
    length of the country, else the whole run, or its longest part if the country has none."""
    lengths = F.create_map(*(F.lit(x) for n, countries in IBAN_LENGTHS.items() for country in countries.split() for x in (country, n)))
    tokens = F.split(run, " ")
    parts = F.transform(F.sequence(F.lit(1), F.size(tokens)), lambda n: F.array_join(F.slice(tokens, 1, n), " "))
    length = F.try_element_at(lengths, F.substring(run, 1, 2))

    def registered(part: Column) -> Column:
        return F.length(F.regexp_replace(part, " ", "")) == length

    passed = F.filter(parts, lambda part: (length.isNull() | registered(part) | (part == run)) & confirmed("iban", part))
    return F.element_at(F.concat(F.array(F.lit(None).cast("string")), passed, F.filter(passed, registered)), -1)


def stretches(text: Column) -> Column:
    """The text in pieces of STRETCH code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{STRETCH}}}"), F.lit(0))


def cut(parts: Column, begin: Column, length: Column) -> Column:
    """At most NEAR code points of the text from ``begin``, out of its stretches."""
    at = F.floor(begin / STRETCH).cast("int")
    both = F.concat(F.coalesce(F.get(parts, at), F.lit("")), F.coalesce(F.get(parts, at + 1), F.lit("")))
    return F.substr(both, begin - at * STRETCH + 1, length)


def scored(kind: str, parts: Column, start: Column, end: Column) -> Column:
    begin = F.greatest(start - NEAR, F.lit(0))
    near = F.concat_ws(" ", cut(parts, begin, start - begin), cut(parts, end, F.lit(NEAR)))

    def moved(near: Column) -> Column:
        raised = F.when(near.rlike(SUPPORT[kind]), 0.2).otherwise(0.0)
        lowered = F.when(near.rlike(DOUBT), 0.3).otherwise(0.0)
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(CONFIDENCE[kind]) + raised - lowered))

    return bound(near, moved)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once: within a list, an expression is worked out
    wherever it stands."""
    return F.transform(F.array(value), use)[0]


def gathered(items: Column, state: Column, step: Callable[[Column, Column], Column], kind: str) -> Column:
    """What ``step`` finds in each item, as a list of ``kind``; nulls are left out.

    There is an item at least. ``step`` takes the state and an item; of its result, ``state`` goes on to the next. A list
    that grows by one is copied each time, so items are taken in blocks of their number's square
    root: only the list of a block grows by one, and the whole one by a block.
    """
    none = F.array().cast(f"array<{kind}>")

    def in_blocks(own: Column) -> Column:
        size = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(own)))).cast("int")
        numbers = F.sequence(F.lit(0), F.floor((F.size(own) - 1) / size).cast("int"))
        return F.transform(numbers, lambda k: F.slice(own, k * size + 1, size))

    def one(so_far: Column, item: Column) -> Column:
        return bound(step(so_far["state"], item), lambda x: F.struct(x["state"].alias("state"), F.when(
            x["found"].isNotNull(), F.concat(so_far["found"], F.array(x["found"]))).otherwise(so_far["found"]).alias("found")))

    def block(so_far: Column, own: Column) -> Column:
        inner = F.aggregate(own, F.struct(so_far["state"].alias("state"), none.alias("found")), one)
        return bound(inner, lambda x: F.struct(x["state"].alias("state"), F.concat(so_far["found"], x["found"]).alias("found")))

    return F.aggregate(bound(items, in_blocks), F.struct(state.alias("state"), none.alias("found")), block, lambda x: x["found"])


SPAN = "struct<kind:string,start:int,end:int,value:string>"


def spans_of(kind: str, text: Column, parts: Column) -> Column:
    """The confirmed spans of one kind: code points from 0, the end exclusive.

    The pieces between matches and the matches alternate, so adding up their lengths gives
    the places. IBANs that begin within one that was found are part of it.
    """
    pattern = F.lit(PATTERNS[kind])
    hits = F.regexp_extract_all(text, pattern, F.lit(1 if kind == "iban" else 0))
    if kind == "iban":
        hits = F.transform(hits, account_number)
    pieces = F.arrays_zip(F.transform(F.split(text, PATTERNS[kind], -1), F.length).alias("gap"), hits.alias("hit"))
    state = F.struct(F.lit(0).alias("at"), F.lit(0).alias("free"))

    def step(state: Column, piece: Column) -> Column:
        start = state["at"] + piece["gap"]
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.coalesce(F.length(piece["hit"]), F.lit(0))).alias("end"),
                        piece["hit"].alias("value"))
        return bound(span, lambda s: bound(good(state, s), lambda fine: F.struct(
            F.struct((s["start"] + 4 if kind == "iban" else s["end"]).alias("at"), F.when(fine, s["end"]).otherwise(state["free"]).alias("free")).alias("state"),
            F.when(fine, s).alias("found"))))

    def good(state: Column, span: Column) -> Column:
        return span["value"].isNotNull() & ((span["start"] >= state["free"]) if kind == "iban" else confirmed(kind, span["value"]))

    found = F.transform(gathered(pieces, state, step, SPAN), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"),
        scored(kind, parts, s["start"], s["end"]).alias("score")))
    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string,score:double>>")
    return F.when(text.rlike(NEEDS[kind]), found).otherwise(none)


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with ``personal``: their spans by start, then kind as listed.

    Null is an empty text and has none. Repeated rows are judged each for itself; other
    columns pass through, but one named ``personal`` is replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    own = "stretches of the text"  # a name that no table has; the column ends here
    docs = docs.withColumn(own, F.when(whole.rlike("|".join(NEEDS.values())), stretches(whole)))
    spans = F.concat(*(spans_of(kind, whole, F.col(own)) for kind in PATTERNS))
    order = F.create_map(*(F.lit(x) for k, kind in enumerate(PATTERNS) for x in (kind, k)))

    def compare(a: Column, b: Column) -> Column:
        return F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(order[a["kind"]] - order[b["kind"]])

    return docs.withColumn("personal", F.array_sort(spans, compare)).drop(own)


def listing(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """Counts by kind, the hash of the base spans, and all spans as text."""
    spans = F.col("personal")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))

    def counted(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [counted(kind) for kind in PATTERNS]
    return find(docs.select("doc_id", "text")).select(
        "doc_id", *counts, F.sha2(listing(base), 256).alias("base_sha256"), listing(spans).alias("spans"),
        F.coalesce(F.array_max(F.transform(spans, lambda s: s["score"])), F.lit(0.0)).alias("score"))
