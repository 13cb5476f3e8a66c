"""Benchmark decontamination by template canonicalisation.

Words are lower-cased and stripped of ASCII punctuation. In a template, numbers,
names (words with a capital) and units (after a number) become placeholders of
their type; runs of names are one name, and end at punctuation. Windows of
``WINDOW`` template words are hash-joined with those of the benchmark, and the
words that fill the slots must be consistent over the windows of one occurrence
of the item in the document: the same slot value of the item always stands for
the same word of the document. A document may hold several versions of an item:
its best occurrence counts, whether windows are told apart by how far they are
shifted against the item, by where the item starts anew, or not at all.
Windows of plain words, without placeholders, are joined as well, so
that a change of case alone hides nothing. Items shorter than a window are one
window of their own length.

A document is contaminated by an item if they share a window of plain words, or
windows with at least ``LITERALS`` words outside slots, consistently filled,
that cover ``COVERAGE`` of the item's.

Tasks drop windows that no benchmark item has by a bitmap of fixed size, filled
from the benchmark's hashes; what remains goes through an ordinary join. A
larger benchmark makes the bitmap let more through, not the result less exact.
Null and empty texts share nothing. Rows that repeat an id are one document. An
empty table gives an empty result; other columns are ignored or pass unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.llm import words
from fleetscope.llm.columns import fresh
from fleetscope.sinks.storage import Scratch

WINDOW = 8
LITERALS = 5
COVERAGE = 0.5
SHORTEST = 4  # words of the shortest item that is searched for
BITMAP_BITS = 24

# fixed values: words that are units after a number
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs oz pound pounds ml l "
    "liter liters litre litres s sec second seconds min minute minutes h hr hour hours day days week weeks month "
    "months year years cent cents dollar dollars usd eur euro euros percent degrees mph kmh hz khz mhz ghz w kw mw "
    "v a c f k"
).split()

_NUMBER, _NAME, _UNIT = (np.uint64(x) for x in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0x9B05688C2B3E6C1F))
_DIGITS = np.zeros(256, dtype=bool)
_DIGITS[48:58] = True
_CAPITALS = np.zeros(256, dtype=bool)
_CAPITALS[65:91] = True
_STOPS = np.zeros(256, dtype=bool)
_STOPS[list(b':;,!?)"')] = True
_ABBREVIATION = 3  # letters before a point that ends no run of names, as in Mr. or J.


class Template:
    """Words and template words of several texts.

    ``plain``, ``shape`` and ``slot`` describe template words: the hash of the
    word, the hash with placeholders, and whether it is one."""

    def __init__(self, texts: pa.Array) -> None:
        whole = words.split_words(texts)
        found = words.bare_words(whole)
        bare, starts, ends, first = found.data, found.starts, found.ends, found.first
        # capitals of Latin-1 take two bytes
        wide = words.latin_capitals(bare)
        bare = np.where(wide, bare + 0x20, bare).astype(np.uint8)
        plain = words._range_hash(words._LOWERED[bare], starts, ends, words._BASE, words._INVERSE)
        digits = np.append(0, np.cumsum(_DIGITS[bare]))
        number = digits[ends] - digits[starts] == ends - starts
        name = (_CAPITALS[bare] | np.append(wide[1:], False))[starts]
        at_first = np.zeros(len(starts) + 1, dtype=bool)
        at_first[first] = True
        at_first = at_first[:-1]
        unit = np.isin(plain, _unit_hashes())
        unit[1:] &= number[:-1]
        unit[:1] = False
        unit &= ~at_first
        shape = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, plain)))
        again = np.zeros(len(starts), dtype=bool)  # names that continue a name
        again[1:] = name[1:] & name[:-1] & ~at_first[1:] & ~_after_stop(whole)[1:]
        stays = ~again
        self.plain, self.plain_first = plain, first
        self.word = np.flatnonzero(stays)  # the word a template word stands at
        self.shape = shape[stays]
        self.slot = (number | unit | name)[stays]
        self.first = np.append(0, np.cumsum(stays))[first]
        # what fills a slot: the hash of the words of the run
        run_end = np.append(self.word[1:], len(starts))
        summed = np.append(np.uint64(0), np.cumsum(words.mix(plain)))
        self.value = summed[run_end] - summed[self.word]


def _after_stop(whole: words.Words) -> np.ndarray:
    """For every bare word, whether punctuation parts it from the word before."""
    letters = np.append(0, np.cumsum(words._LETTERS[whole.data]))
    n_letters = letters[whole.ends] - letters[whole.starts]
    last, first = whole.data[whole.ends - 1], whole.data[whole.starts]
    stop = _STOPS[last] | ((last == ord(".")) & (n_letters > _ABBREVIATION))
    parted = np.append(False, stop[:-1])[: len(stop)] | (first == ord("("))
    return parted[n_letters > 0]


def _unit_hashes() -> np.ndarray:
    return words.split_words(pa.array([" ".join(UNITS)])).hashes(lower=True)


def template_windows(texts: pa.Array, size: int, whole: bool = False) -> Iterator[tuple]:
    """(exact, text, place, hash, slot places, slot values) of all windows, as
    arrays. With ``whole`` only texts of just this size are taken."""
    found = Template(texts)
    for exact in (True, False):
        hashes, first = (found.plain, found.plain_first) if exact else (found.shape, found.first)
        windows = words.window_hashes(hashes, size)
        counts = np.diff(first)
        taken = np.where(counts == size, 1, 0) if whole else np.maximum(counts - size + 1, 0)
        at = words.ranges(first[:-1], taken)
        text = np.repeat(np.arange(len(counts)), taken)
        if not exact:
            slots = np.append(0, np.cumsum(found.slot))
            in_slots = slots[at + size] - slots[at]
            useful = (in_slots > 0) & (size - in_slots >= min(LITERALS, size - 1))
            at, text = at[useful], text[useful]
        salt = np.uint64(2 * size + exact)
        yield exact, text, at - first[text], words.mix(windows[at] + salt), at, found


def _slots(found: Template, at: int, size: int) -> list[int]:
    places = np.flatnonzero(found.slot[at : at + size]) + at
    return words.signed(found.value[places]).tolist()


_WINDOW_SCHEMA = "id {kind}, exact boolean, size int, place int, hash bigint, slots array<bigint>"


def _windows(table: DataFrame, sizes, whole: bool, bitmap=None) -> DataFrame:
    """The windows of (id, text), of the given sizes, that the bitmap lets pass."""
    kind = table.schema["id"].dataType.simpleString()
    schema = _WINDOW_SCHEMA.format(kind=kind)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bitmap.value if bitmap is not None else None
        for batch in words.slices(batches):
            for size in sizes:
                for exact, text, place, hashes, at, found in template_windows(
                    batch.column("text"), size, whole and size < WINDOW
                ):
                    if known is not None:
                        spot = hashes >> np.uint64(64 - BITMAP_BITS)
                        hit = (known[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 > 0
                        text, place, hashes, at = text[hit], place[hit], hashes[hit], at[hit]
                    if not len(text):
                        continue
                    slots = [[] if exact else _slots(found, a, size) for a in at.tolist()]
                    n = len(text)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("id").take(pa.array(text)),
                            pa.array(np.full(n, exact)),
                            pa.array(np.full(n, size, dtype=np.int32)),
                            pa.array(place.astype(np.int32)),
                            pa.array(words.signed(hashes)),
                            pa.array(slots, pa.list_(pa.int64())),
                        ],
                        ["id", "exact", "size", "place", "hash", "slots"],
                    )

    return table.mapInArrow(emit, schema)


def _bitmap(windows: DataFrame) -> np.ndarray:
    """A bit for the leading bits of every hash; its size does not depend on how
    many there are. Tasks send the set bits' places, each at most once."""
    places = windows.select(F.shiftrightunsigned("hash", 64 - BITMAP_BITS).alias("place")).distinct()
    bits = np.zeros(1 << BITMAP_BITS, dtype=bool)
    for row in places.toLocalIterator():
        bits[row["place"]] = True
    return np.packbits(bits, bitorder="little")


def _best_occurrences(shared: DataFrame) -> DataFrame:
    """For id and item the occurrence that covers most of the item, consistent
    ones first. Of the three ways to tell occurrences apart none loses what
    another finds: a word more or less shifts the windows behind it, and windows
    that the item repeats seem to start it anew."""
    in_order = Window.partitionBy("id", "item").orderBy("place", "item_place")
    step = F.col("item_place") - F.lag("item_place").over(in_order)
    ahead = F.col("place") - F.lag("place").over(in_order)
    anew = F.coalesce((step <= 0) | (ahead > step + 2 * WINDOW), F.lit(False))
    told = shared.filter("NOT exact").withColumn("anew", anew.cast("bigint"))
    told = told.withColumn("start", F.sum("anew").over(in_order))
    ways = [(0, F.lit(0)), (1, F.col("place") - F.col("item_place")), (2, F.col("start"))]
    ways = F.array(*[F.struct(F.lit(k).alias("way"), n.cast("bigint").alias("n")) for k, n in ways])
    told = told.withColumn("occurrence", F.explode(ways))
    slots = F.explode(F.arrays_zip(F.col("item_slots").alias("of_item"), F.col("slots").alias("of_doc")))
    filled = told.select("id", "item", "occurrence", "size", "item_place", slots.alias("slot"))
    distinct = lambda column: F.size(F.collect_set(column)).cast("bigint")
    each = filled.groupBy("id", "item", "occurrence").agg(
        distinct(F.struct("size", "item_place")).alias("n_template"),
        (distinct("slot") == distinct("slot.of_item")).alias("consistent"),
        distinct(F.when(F.col("slot.of_item") != F.col("slot.of_doc"), F.col("slot"))).alias("n_refilled"),
    )
    best = F.max(F.struct("consistent", "n_template", (-F.col("n_refilled")).alias("unchanged"))).alias("best")
    return each.groupBy("id", "item").agg(best).select(
        "id", "item", "best.consistent", "best.n_template", (-F.col("best.unchanged")).alias("n_refilled")
    )


def contaminated(
    docs: DataFrame, benchmark: DataFrame, scratch: Scratch,
    id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """doc id, item id, shared windows (templates: of the best occurrence), the
    part of the item's windows they are, and whether slots were filled otherwise: a row for every contaminated
    document and item."""
    items = benchmark.select(benchmark[item_id].alias("id"), benchmark[item_text].alias("text"))
    sizes = list(range(SHORTEST, WINDOW + 1))
    windows = scratch.save(_windows(items, sizes, whole=True))
    used = [row["size"] for row in windows.select("size").distinct().collect()]
    bitmap = scratch.spark.sparkContext.broadcast(_bitmap(windows))
    narrow = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    ours = _windows(narrow, sorted(used), whole=False, bitmap=bitmap)
    of_item = windows.select(
        F.col("id").alias("item"), "exact", "size", F.col("place").alias("item_place"), "hash",
        F.col("slots").alias("item_slots"),
    )
    shared = scratch.save(ours.join(of_item, ["hash", "size", "exact"]))
    occurrences = _best_occurrences(shared)
    matched = shared.groupBy("id", "item").agg(
        F.countDistinct(F.when(F.col("exact"), F.struct("size", "item_place"))).alias("n_exact"),
    )
    of_items = windows.groupBy(F.col("id").alias("item")).agg(
        F.count_if("exact").alias("all_exact"), F.count_if(~F.col("exact")).alias("all_template")
    )
    keys = lambda other: (
        matched["id"].eqNullSafe(other["id"]) & matched["item"].eqNullSafe(other["item"])
    )
    found = matched.join(occurrences, keys(occurrences), "left").join(
        of_items, matched["item"].eqNullSafe(of_items["item"]), "left"
    )
    found = found.withColumn("n_template", F.coalesce("n_template", F.lit(0)))
    covered = F.greatest(
        F.coalesce(F.try_divide("n_exact", "all_exact"), F.lit(0.0)),
        F.coalesce(F.try_divide("n_template", "all_template"), F.lit(0.0)),
    )
    same_template = F.coalesce("consistent", F.lit(False)) & (
        F.col("n_template") >= COVERAGE * F.col("all_template")
    )
    leaked = found.filter((F.col("n_exact") > 0) | same_template)
    return leaked.select(
        matched["id"].alias(id), matched["item"].alias(item_id), "n_exact", "n_template",
        covered.alias("covered"), (F.col("n_exact") < F.col("all_exact")).alias("reworded"),
        F.coalesce("n_refilled", F.lit(0)).alias("n_refilled"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, scratch: Scratch, id: str = "doc_id") -> DataFrame:
    """The documents that share nothing with the benchmark."""
    (other,) = fresh(docs, "leaked_id")
    leaked = scratch.save(contaminated(docs, benchmark, scratch, id=id).select(F.col(id).alias(other)).distinct())
    kept = docs.join(leaked, docs[id].eqNullSafe(leaked[other]), "left_anti")
    return kept
