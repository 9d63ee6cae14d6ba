"""Documents that hold passages of a benchmark, also with other numbers, names or units. DataFrame functions only.

A text becomes a template: numbers, units that follow them and capitalised words inside a sentence give
typed placeholders, the rest is lower case without punctuation. Windows of WINDOW template tokens are
hashed and joined. Matches of one document and item at one distance are an alignment, and its slots are
read again with their values: each value of the item must stand for one and the same value of the
document. Equal numbers before different words are different values. An alignment in which a value stands for several
counts by its windows without such values: two of them that prove something and do not overlap. Windows with fewer than LITERAL ordinary words prove nothing by themselves; an alignment of
such windows alone counts only if all values are equal. A window without slots is the passage itself.
A short item, of fewer than WINDOW tokens and of them fewer than LITERAL ordinary words, matches only as whole lines.
In scripts that write no spaces between words every letter is a token, and an item that is mostly in such letters has windows twice as long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podwatch.llm.scratch import Scratch

WINDOW, LITERAL = 8, 5
# Rows of (hash, item, position), some 100 MB on an executor; beyond, Spark picks a shuffle join.
BROADCAST_WINDOWS = 1_000_000
NUMBER, NAME, UNIT = "\ue000", "\ue001", "\ue002"
UNITS = (
    "mm cm m km in inch inches ft feet yd yard yards mi mile miles mg g kg t lb lbs oz ounce ounces gram grams pound pounds ton tons "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month "
    "months year years cent cents dollar dollars euro euros usd eur degrees percent"
).split()
_NUMBER = r"\p{N}+(?:[.,:/]\p{N}+)*"
# What is rare is looked at first: the capital before what stands before it, the mark before its neighbours.
_NAME = r"(\p{Lu}(?<=[\p{Ll}\p{N},;:] .)\p{Ll}+)"
_UNIT = rf"({NUMBER}[^ ]* ) ?({'|'.join(sorted(UNITS, key=len, reverse=True))})(?!\p{{L}})"
# Letters of scripts without spaces between words, with their marks; all lie beyond the range looked at first.
_SCRIPTS = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
_UNSPACED = rf"[\u0e00-\x{{10ffff}}](?<={_SCRIPTS})\p{{M}}*"
# What separates tokens: all but letters, marks, digits, placeholders and the separators inside a number.
_BETWEEN = rf"(?:[^\p{{L}}\p{{M}}\p{{N}}{NUMBER}-{UNIT}.,:/]|[.,:/](?<!\p{{N}}.)|[.,:/](?!\p{{N}}))+"


def template(text: Column, values: bool = False) -> Column:
    """The template's tokens; with ``values`` each placeholder is followed by what stood there."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    spaced = F.regexp_replace(F.regexp_replace(spaced, " {2,}", " "), _UNSPACED, " $0 ")
    named = F.regexp_replace(spaced, _NAME, f" {NAME}$1 " if values else f" {NAME} ")
    counted = F.regexp_replace(named, _NUMBER, f" {NUMBER}$0 " if values else f" {NUMBER} ")
    measured = F.regexp_replace(counted, _UNIT, f"$1 {UNIT}$2 " if values else f"$1 {UNIT} ")
    return F.filter(F.split(F.lower(measured), _BETWEEN), lambda t: t != "")


def _hashes(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: F.xxhash64(t))


def _windows(hashes: Column, width: int) -> Column:
    """Hash of every window of token hashes, in order."""
    last = F.size(hashes) - F.lit(width)
    found = F.transform(F.sequence(F.lit(1), last + 1), lambda i: F.xxhash64(F.slice(hashes, i, F.lit(width))))
    return F.when(last >= 0, found).otherwise(F.array().cast("array<bigint>"))


def _is_slot(token: Column) -> Column:
    return F.substring(token, 1, 1).between(NUMBER, UNIT)


def _words(tokens: Column) -> Column:
    return F.size(F.filter(tokens, lambda t: ~_is_slot(t)))


def _is_short(tokens: Column) -> Column:
    return (F.size(tokens) < WINDOW) & (_words(tokens) < LITERAL)


def _lines(text: Column) -> Column:
    """The lines that have tokens."""
    return F.filter(F.split(text, r"\R"), lambda x: x.rlike(rf"[\p{{L}}\p{{M}}\p{{N}}{NUMBER}-{UNIT}]"))


def _line_tokens(lines: Column, values: bool = False) -> Column:
    return F.flatten(F.transform(lines, lambda x: template(x, values)))


def _line_matches(docs: DataFrame, items: DataFrame) -> DataFrame | None:
    """Lines of documents that have the template of a short item, as alignments of one window; None if there are no short items."""
    tokens = _line_tokens(_lines(F.col("text")))
    short = items.where(_is_short(template(F.col("text")))).select(
        F.col("item_id"), F.xxhash64(tokens).alias("hash"), F.size(_lines(F.col("text"))).alias("n_lines"),
        _words(tokens).alias("words"), F.size(tokens).alias("width"), _line_tokens(_lines(F.col("text")), True).alias("here"),
    ).where("width > 0")
    size = short.agg(F.count("*").alias("n"), F.collect_set("n_lines").alias("n_lines")).first()  # fewer than WINDOW numbers of lines
    if size["n"] and size["n"] <= BROADCAST_WINDOWS:
        short = F.broadcast(short)
    found = None
    for n in sorted(size["n_lines"]):
        lines = _lines(F.col("text"))
        runs = F.transform(F.sequence(F.lit(1), F.size(lines) - n + 1), lambda i: F.slice(lines, i, n))  # noqa: B023
        runs = docs.where(F.size(lines) >= n).select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(runs).alias("place", "run"))
        runs = runs.withColumn("hash", F.xxhash64(_line_tokens(F.col("run")))).withColumn("n_lines", F.lit(n))
        hits = runs.join(short, ["hash", "n_lines"]).drop("hash", "n_lines")
        found = hits if found is None else found.union(hits)
    if found is None:
        return None
    in_docs = docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("h"), "text")
    found = found.join(in_docs, (F.col("doc_id") == F.col("d")) & (F.col("text_hash") == F.col("h")))
    before = F.array_join(F.slice(_lines(F.col("text")), F.lit(1), F.col("place")), "\n")
    at = F.array(F.lit(0))
    return found.select(
        "doc_id", "item_id", "width", F.lit(0).alias("shift"), at.alias("starts"),
        F.when(F.col("words") > 0, at).otherwise(F.array().cast("array<int>")).alias("rich_starts"), (F.col("words") == F.col("width")).alias("plain"),
        _line_tokens(F.col("run"), True).alias("there"), "here", F.size(template(before)).alias("first"),
    )


def item_windows(items: DataFrame) -> DataFrame:
    """(hash, width, item_id, at, rich, plain) of items (item_id, text) that are not short; one of fewer tokens than its windows should have is one window of its own width."""
    tokens = items.select("item_id", template(F.col("text")).alias("tokens")).where((F.size("tokens") > 0) & ~_is_short(F.col("tokens")))
    unspaced = F.size(F.filter("tokens", lambda t: t.rlike("^" + _SCRIPTS)))
    longest = F.when(unspaced * 2 > F.size("tokens"), F.lit(2 * WINDOW)).otherwise(F.lit(WINDOW))
    tokens = tokens.withColumn("width", F.least(F.size("tokens"), longest)).withColumn("hashes", _hashes(F.col("tokens")))
    starts = F.sequence(F.lit(1), F.size("tokens") - F.col("width") + 1)
    found = F.transform(
        starts,
        lambda i: F.struct(
            F.xxhash64(F.slice("hashes", i, F.col("width"))).alias("hash"),
            (i - 1).alias("at"),
            _words(F.slice("tokens", i, F.col("width"))).alias("words"),
        ),
    )
    rows = tokens.select("item_id", "width", F.explode(found).alias("w"))
    rich = F.col("w.words") >= LITERAL
    plain = F.col("w.words") == F.col("width")
    return rows.select(F.col("w.hash").alias("hash"), "width", "item_id", F.col("w.at").alias("at"), rich.alias("rich"), plain.alias("plain"))


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_windows, first_token, n_slots, same_values) for each document and item that share a passage.

    Reads doc_id and text of ``docs``, item_id and text of ``items``. A NULL or empty text on either side, an
    item without an id and a row without a doc_id match nothing. Rows that repeat a doc_id are read
    separately and reported together. ``first_token`` is the place of the first matching window in the
    document, from 0; ``same_values`` says that some alignment has the item's own values. Empty tables
    give an empty result.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text <> ''")
    items = items.select("item_id", "text").where("item_id is not null and text <> ''")
    known = item_windows(items)
    size = known.agg(F.count("*").alias("n"), F.collect_set("width").alias("widths")).first()  # twice WINDOW at most
    widths = sorted(size["widths"])
    if size["n"] <= BROADCAST_WINDOWS:
        known = F.broadcast(known)
    # Rows of one doc_id are told apart by their text.
    tokens = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _hashes(template(F.col("text"))).alias("hashes"))
    hits = None
    if widths:
        each = F.inline(F.array(*(F.struct(F.lit(w).alias("width"), _windows(F.col("hashes"), w).alias("of")) for w in widths)))
        windows = tokens.select("doc_id", "text_hash", each).select("doc_id", "text_hash", "width", F.posexplode("of").alias("place", "hash"))
        hits = windows.join(known, ["hash", "width"])
    lines = _line_matches(docs, items)
    if hits is None and lines is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_windows long, first_token int, n_slots int, same_values boolean")
    both = lines if hits is None else _window_matches(docs, items, hits)
    both = both if hits is None or lines is None else both.unionByName(lines)
    return _proven(both)


def _window_matches(docs: DataFrame, items: DataFrame, hits: DataFrame) -> DataFrame:
    """The alignments of matching windows, with the values on both sides."""
    runs = hits.groupBy("doc_id", "text_hash", "item_id", "width", (F.col("place") - F.col("at")).alias("shift")).agg(
        F.collect_set("at").alias("starts"), F.collect_set(F.when(F.col("rich"), F.col("at"))).alias("rich_starts"), F.max("plain").alias("plain")
    )

    # The texts stay where they are unless the alignments are many.
    runs = Scratch(docs.sparkSession, "decontaminate").written(runs, "alignments")
    if runs.count() <= BROADCAST_WINDOWS:
        runs = F.broadcast(runs)
    in_docs = docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("h"), "text")
    in_docs = runs.join(in_docs, (F.col("doc_id") == F.col("d")) & (F.col("text_hash") == F.col("h")))
    in_docs = in_docs.select("doc_id", "item_id", "width", "shift", "starts", "rich_starts", "plain", template(F.col("text"), values=True).alias("there"))
    in_items = items.select(F.col("item_id").alias("i"), template(F.col("text"), values=True).alias("here"))
    both = in_docs.join(in_items, F.col("item_id") == F.col("i")).drop("i")
    return both.withColumn("first", F.col("shift") + F.array_min("starts"))


def _proven(both: DataFrame) -> DataFrame:
    """What holds of alignments (doc_id, item_id, width, shift, starts, rich_starts, plain, here, there, first), by document and item."""
    covered = F.filter(
        F.sequence(F.lit(0), F.size("here") - 1), lambda k: F.exists("starts", lambda s: (s <= k) & (k < s + F.col("width")))
    )
    # A number is told apart by what follows it.
    of = lambda k: F.when(F.get("here", k).startswith(NUMBER), F.coalesce(F.get("here", k + 1), F.lit(""))).otherwise("")
    places = F.filter(
        F.transform(covered, lambda k: F.struct(k.alias("k"), F.get("here", k).alias("x"), of(k).alias("of"), F.get("there", k + F.col("shift")).alias("y"))),
        lambda p: _is_slot(p["x"]),
    )
    both = both.select("doc_id", "item_id", "width", "starts", "first", "rich_starts", "plain", places.alias("places"))
    both = both.withColumn("slots", F.array_distinct(F.transform("places", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))))
    both = both.withColumn("equal", F.forall("slots", lambda p: p["x"] == p["y"]))
    clashes = F.filter("places", lambda p: F.exists("places", lambda q: (p["x"] == q["x"]) & (p["of"] == q["of"]) & (p["y"] != q["y"])))
    both = both.withColumn("clashes", F.transform(clashes, lambda p: p["k"]))
    clean = F.filter("rich_starts", lambda s: ~F.exists("clashes", lambda k: (s <= k) & (k < s + F.col("width"))))
    apart = F.coalesce(F.array_max(clean) - F.array_min(clean) >= F.col("width"), F.lit(False))
    proven = both.where(F.when(F.size("rich_starts") > 0, F.col("plain") | (F.size("clashes") == 0) | apart).otherwise(F.col("equal")))
    return proven.groupBy("doc_id", "item_id").agg(
        F.sum(F.size("starts")).alias("n_windows"),
        F.min("first").cast("int").alias("first_token"),
        F.max(F.size("slots")).alias("n_slots"),
        F.max("equal").alias("same_values"),
    )
