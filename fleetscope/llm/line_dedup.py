"""Removal of repeated and slightly edited lines by deletion neighbourhoods.

A line is its sequence of words; an edit inserts, deletes or replaces one. A
line with at least ``least`` words is dropped if an earlier line has the same
words, and one with at least ``near`` also if an earlier line of that length
lies within one edit. Earlier means a smaller id, or a smaller place in the
document; shorter lines always stay. The registered query and the pipeline take
every line that has a word, and ``SHORTEST_NEAR`` words: of fewer, one edit is
a fourth of the line or more, and leaves another line.

All variants within the bound are emitted as hashed keys: the line itself, and
the line without each of its words. Keys carry what was deleted, so that equal
keys are pairs within the bound: a replaced word leaves equal variants of equal
length at one place, an inserted word a variant equal to the other line. Every
key needs only its earliest line, by an aggregate with map-side combine, so the
lines of a group are never multiplied out. The edit distance to the earliest
line is then verified on the words.

Most lines have no neighbour. The edit lies in one third of the line and leaves
the others as they are, so only lines that share two of their thirds with a
different line emit variants: three keys a line for its class of lengths, and
for the next class where a line one word longer falls into that. Of these, a line
emits the variants without a word of the thirds that it does not share, and itself.

Whole texts are dealt twice, to fetch lines and to cut, each time to a hash table
of the few rows they meet: by one plan for any size, without sorting texts.

A null text stays null and has no lines. Rows that repeat id and text are one
document, and are cut alike. A null id is later than any other. An empty table
gives an empty result; other columns pass unchanged, whatever their names.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.llm.columns import WORD, fresh, let
from fleetscope.sinks.storage import Scratch

MIN_WORDS = 5
NEAR_WORDS = 10
SHORTEST, SHORTEST_NEAR = 1, 5  # of the registered query and the pipeline
CLASS = 3  # lengths for which thirds are cut alike
_SHARES = ("shares_0", "shares_1", "shares_2")  # the parts of a line's own class that it shares

_BLANKS = r"[\t\x0B\f\r]"  # that end a word, besides spaces and line ends

_PLACE = ("late", "id", "text_hash", "at")  # where a line stands; smallest is earliest


def _thirds(longer: Column) -> tuple[Column, Column, Column]:
    """The smallest length of a line's class, and how many words all but one of
    its thirds and a third of it have."""
    length = longer - longer % CLASS
    third = F.floor((length - 1) / 3).cast("int")
    return length, length - 1 - third, third + 1


def _parts(line: Column, longer: Column) -> list[Column]:
    """Keys of the words that a line shares with one within an edit, if the
    longer of the two is this long: all but the last third, all but the first,
    or both of these. Thirds are those of the smallest length of the class, so
    that they cover the edits of every longer one."""
    length, long, short = _thirds(longer)
    some = lambda n: F.call_function("substring_index", line, F.lit(" "), n)
    parts = ([some(long)], [some(-long)], [some(short), some(-short)])
    return [F.xxhash64(F.lit(k), length, *part) for k, part in enumerate(parts)]


def _line_table(docs: DataFrame, id: str, text: str, least: int, near: int) -> DataFrame:
    """A row for every line of at least ``least`` words: its place, two hashes
    of its words, its length, and the keys of its parts."""

    def describe(line: Column, length: Column, at: Column) -> Column:
        parts = _parts(line, length)
        at_end = (length + 1) % CLASS == 0  # a line one word longer is of the next class
        keys = F.when(at_end, F.array(*parts, *_parts(line, length + 1))).otherwise(F.array(*parts))
        return F.struct(
            at.alias("at"), length.alias("length"),
            F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2"),
            F.when(length >= near, keys).alias("parts"),
        )

    def single(line: Column) -> Column:
        """The words of a line with one space between them."""
        return let(F.trim(line), lambda x: F.when(F.contains(x, F.lit("  ")), F.regexp_replace(x, " +", " ")).otherwise(x))

    def count(line: Column) -> Column:
        spaces = F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit("")))
        return F.when(line == "", 0).otherwise(spaces + 1)

    def described(line: Column, at: Column) -> Column:
        return let(single(line), lambda bare: let(count(bare), lambda length: describe(bare, length, at)))

    lines = F.transform(F.split(F.regexp_replace(docs[text], _BLANKS, " "), "\n"), described)
    # before the rows are made: a filter on them would split every line twice
    long = F.filter(lines, lambda line: line["length"] >= least)
    rows = docs.select(
        docs[id].isNull().alias("late"), docs[id].alias("id"),
        F.xxhash64(docs[text]).alias("text_hash"), F.explode(long).alias("line"),
    )
    return rows.select("late", "id", "text_hash", *[f"line.{c}" for c in ("at", "h1", "h2", "parts")])


def _active(firsts: DataFrame) -> DataFrame:
    """Of the distinct lines those that share parts with another, by one hash, and
    which of their own class they share; a line that has the same by chance is one
    candidate more."""
    shared = firsts.filter("parts IS NOT NULL").select("h1", F.posexplode("parts").alias("which", "part"))
    bounds = shared.groupBy("part").agg(F.min("h1").alias("low"), F.max("h1").alias("high"))
    several = bounds.filter("low != high").select("part")
    several = shared.join(several, "part", "left_semi")
    return several.groupBy("h1").agg(*[F.bool_or(F.col("which") == k).alias(name) for k, name in enumerate(_SHARES)])


def _variants(active: DataFrame) -> DataFrame:
    """active (place, h1, h2, shares, words) -> (key, side, place): side 0 for a
    word left out at a known place, 1 for the whole line, 2 for any word left
    out. Words are left out where a shared part leaves room for the edit. The hash of a sequence is the XOR of its words' hashes with places, so
    that leaving one out takes running XORs, not time that grows squared."""
    line = Window.partitionBy("h1", "h2")
    ahead = line.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # dealt as lines, of which the words are made in place
    words = active.repartition("h1", "h2").select(
        "place", "h1", "h2", *_SHARES, F.size("words").alias("n"), F.posexplode("words").alias("k", "word")
    )
    words = words.withColumns({"a": F.xxhash64("k", "word"), "b": F.xxhash64(F.col("k") - 1, "word")})
    words = words.withColumns(
        {
            "whole": F.bit_xor("a").over(line),
            "before": F.bit_xor("a").over(ahead).bitwiseXOR(F.col("a")),
            "after": F.bit_xor("b").over(line).bitwiseXOR(F.bit_xor("b").over(ahead)),
        }
    )
    rest = F.col("before").bitwiseXOR(F.col("after"))
    length, k = F.col("n"), F.col("k")
    _, long, short = _thirds(length)
    room = (k >= long, k < length - long, (k >= short) & (k < length - short))
    edit = functools.reduce(Column.__or__, [F.col(shares) & here for shares, here in zip(_SHARES, room, strict=True)])
    keys = F.array(
        F.when(edit, F.struct(F.xxhash64(F.lit(0), rest, length, "k").alias("key"), F.lit(0).alias("side"))),
        F.when(edit, F.struct(F.xxhash64(F.lit(1), rest, length - 1).alias("key"), F.lit(2).alias("side"))),
        F.when(k == 0, F.struct(F.xxhash64(F.lit(1), "whole", length).alias("key"), F.lit(1).alias("side"))),
    )
    # a word that repeats gives a variant twice: no more rows than words, and no harm
    keyed = words.select("place", F.explode(F.array_compact(keys)).alias("of"))
    return keyed.select("of.key", "of.side", "place")


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether two word arrays are at most one inserted, deleted or replaced
    word apart."""

    def compare(long: Column, short: Column) -> Column:
        places = F.filter(
            F.sequence(F.lit(0), F.size(short)),
            lambda k: ~F.coalesce(F.get(long, k) == F.get(short, k), F.lit(False)),
        )
        at = F.get(places, F.lit(0))  # the first difference, or the shorter one's end
        tail = lambda x, skip: F.slice(x, at + 1 + skip, F.size(x))
        return F.when(F.size(long) == F.size(short), tail(long, 1) == tail(short, 1)).otherwise(
            (F.size(long) - F.size(short) == 1) & (tail(long, 1) == tail(short, 0))
        )

    return F.when(F.size(a) >= F.size(b), compare(a, b)).otherwise(compare(b, a))


def _near_lines(
    docs: DataFrame, firsts: DataFrame, active: DataFrame, scratch: Scratch, id: str, text: str, shortest: int
) -> DataFrame:
    """(h1, h2) of the lines that have an earlier one within one edit."""
    by_doc = scratch.save(
        firsts.join(active, "h1").groupBy("first.late", "first.id", "first.text_hash")
        .agg(F.collect_list(F.struct("h1", "h2", *_SHARES, F.col("first.at").alias("at"))).alias("lines"))
        .withColumnsRenamed({"id": "of", "text_hash": "of_hash"})
    )
    docs = docs.select(docs[id].alias("doc"), docs[text].alias("text"))
    same = docs["doc"].eqNullSafe(by_doc["of"]) & (F.xxhash64(docs["text"]) == by_doc["of_hash"])
    found = docs.join(by_doc.hint("shuffle_hash"), same).select(
        "late", F.col("of").alias("id"), F.col("of_hash").alias("text_hash"),
        F.split(docs["text"], "\n").alias("all_lines"), F.explode("lines").alias("line"),
    )
    words = F.regexp_extract_all(F.get("all_lines", "line.at"), F.lit(WORD), F.lit(0))
    found = found.select("late", "id", "text_hash", "line.*", words.alias("words"))
    found = found.filter(F.size("words") >= shortest)
    found = found.select(F.struct(*_PLACE).alias("place"), "h1", "h2", *_SHARES, "words").dropDuplicates(["h1", "h2"])
    found = scratch.save(found)
    variants = scratch.save(_variants(found))
    earliest = variants.groupBy("key").agg(
        *[F.min(F.when(F.col("side") == side, F.col("place"))).alias(f"on_{side}") for side in (0, 1, 2)]
    )
    other = F.when(F.col("side") == 0, F.col("on_0")).when(F.col("side") == 1, F.col("on_2")).otherwise(F.col("on_1"))
    pairs = variants.join(earliest, "key").withColumn("other", other).filter("other < place")
    pairs = pairs.select("place", "other").distinct()
    mine = found.select("place", "h1", "h2", "words")
    theirs = found.select(F.col("place").alias("other"), F.col("words").alias("other_words"))
    checked = pairs.join(mine, "place").join(theirs, "other")
    near = checked.filter(within_one_edit(F.col("words"), F.col("other_words")))
    near = scratch.save(near.select("h1", "h2").distinct())
    scratch.drop(by_doc, found, variants)
    return near


def dropped_lines(
    docs: DataFrame, scratch: Scratch, id: str = "doc_id", text: str = "text",
    least: int = MIN_WORDS, near: int = NEAR_WORDS,
) -> DataFrame:
    """of, of_hash, dropped: the places of the lines that go, one row for every
    document that loses any."""
    table = scratch.save(_line_table(docs, id, text, least, near))
    keyed = scratch.save(
        table.groupBy("h1", "h2").agg(
            F.min(F.struct(*_PLACE)).alias("first"), F.max("parts").alias("parts"),
            (F.count(F.lit(1)) > 1).alias("repeated"),
        )
    )
    # the parts are most of both tables, and go before whole texts are dealt
    lines = scratch.save(table.drop("parts"))
    scratch.drop(table)
    active = scratch.save(_active(keyed))
    firsts = scratch.save(keyed.drop("parts"))
    scratch.drop(keyed)
    close = _near_lines(docs, firsts.drop("repeated"), active, scratch, id, text, near)
    repeated = firsts.filter("repeated").drop("repeated")
    marked = repeated.join(close.withColumn("near", F.lit(True)), ["h1", "h2"], "full")
    known = lines.join(marked, ["h1", "h2"])
    gone = known.filter((F.struct(*_PLACE) != F.col("first")) | F.col("near"))
    found = gone.groupBy("id", "text_hash").agg(F.array_sort(F.collect_set("at")).alias("dropped"))
    found = scratch.save(found.withColumnsRenamed({"id": "of", "text_hash": "of_hash"}))
    scratch.drop(lines, firsts, active, close)
    return found


def without_repeated_lines(
    docs: DataFrame, scratch: Scratch, id: str = "doc_id", text: str = "text",
    least: int = MIN_WORDS, near: int = NEAR_WORDS,
) -> tuple[DataFrame, str, str]:
    """``docs`` with each text cut, and the lines it had and lost in two more
    columns, whose names follow."""
    found = dropped_lines(docs, scratch, id, text, least, near)
    of, of_hash, dropped, lines, lost = fresh(docs, "of", "of_hash", "dropped", "n_lines", "n_removed")
    found = found.toDF(of, of_hash, dropped)
    same = docs[id].eqNullSafe(found[of]) & (F.xxhash64(docs[text]) == found[of_hash])
    joined = docs.join(found.hint("shuffle_hash"), same, "left")

    def cut(every: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col(dropped))
        return F.array_join(F.transform(places, lambda k: F.get(every, k)), "\n")

    split = F.split(F.col(f"`{text}`"), "\n")
    shorter = F.when(F.col(dropped).isNull(), F.col(f"`{text}`")).otherwise(let(split, cut))
    columns = [shorter.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    counts = [
        F.coalesce(F.size(split), F.lit(0)).cast("bigint").alias(lines),
        F.coalesce(F.size(dropped), F.lit(0)).cast("bigint").alias(lost),
    ]
    return joined.select(*columns, *counts), lines, lost
