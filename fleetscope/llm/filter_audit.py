"""Filter interaction audit: what every filter removes in every order.

Each document is measured once and becomes a mask, with a bit for each filter it
fails. Documents of one part (a language) with one mask are a cell; all further
work is on cells, at most 2 ** filters of them in a part. A recursive common
table expression then enumerates the orders: it starts with the masks and no
filter, extends a prefix by each letter that is unused, carries the bits applied
so far, and at each level decides for each mask what the step does with it. The
metrics of a step depend on its prefix alone, so they are summed per part and
prefix, and every full order takes those of its own prefixes.

A repeated text is one whose very text, compared over the whole table by a hash
of 256 bits, a document with a smaller id has too. Groups of copies, however
large, are summed up in the map tasks before anything else reads them.

A null text is an empty one, and equals it. A null id is neither smaller nor
larger than another; rows that repeat an id and a text are not each other's
copies. Any of several labels of an id counts; labels without an id are ignored.
A null part is the empty string. An empty table gives an empty result; other
columns are ignored. Very long texts are measured whole, one at a time.
"""

from __future__ import annotations

from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.llm.columns import let
from fleetscope.sinks.storage import Scratch

# the parameters of the registered audit
LEAST_WORDS = 100
DISTINCT_SHARE = 80  # percent of the words
CAPITAL_SHARE = 10  # percent of the characters
SIGNS = r"[#$%&*|]"
LETTERS = "ABCDE"
COPY_BIT = 16  # of the last filter, on repeated texts

MOST_FILTERS = 6  # their orders times masks are enumerated: 125,184 rows for six

_GAPS = r"[\x20\x09-\x0D]+"


def text_bits(text: Column) -> Column:
    """A bit for each of the filters A to D, which read nothing but the text."""

    def of_words(parts: Column) -> Column:
        # blanks at either end of a text leave an empty part there
        ends = F.array_size(F.filter(F.slice(parts, 1, 1), lambda w: w == "")) + F.when(
            F.array_size(parts) > 1, (F.element_at(parts, -1) == "").cast("int")
        ).otherwise(0)
        words = F.array_size(parts) - ends
        distinct = F.array_size(F.array_distinct(parts)) - (ends > 0).cast("int")
        few, repeated = words < LEAST_WORDS, 100 * distinct < DISTINCT_SHARE * words
        return few.cast("int") + 2 * repeated.cast("int")

    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    loud = 100 * capitals > CAPITAL_SHARE * F.length(text)
    # the parts are made once, for both filters on words
    return let(F.split(text, _GAPS), of_words) + 4 * loud.cast("int") + 8 * text.rlike(SIGNS).cast("int")


def mask_cells(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """part, mask, n, good, toxic: how many documents of the part have the mask."""
    whole = F.coalesce(docs[text], F.lit(""))
    named = docs.select(docs[id].alias("id"), F.coalesce(docs[part], F.lit("")).alias("part"), whole.alias("text"))
    measured = named.select(
        "id", "part", F.unhex(F.sha2("text", 256)).alias("key"), text_bits(F.col("text")).alias("bits")
    )
    each = measured.groupBy("id", "part", "key", "bits").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.groupBy("doc_id").agg(
        F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic")
    )
    marked = each.join(marks.withColumnRenamed("doc_id", "of"), F.col("id") == F.col("of"), "left")
    known = F.col("id").isNotNull()
    copies = (
        marked.groupBy(
            "key", "part", "bits",
            F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
        )
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(known, F.col("n")).otherwise(0)).alias("n_known"),
            F.min(F.when(known, F.struct("id", "n"))).alias("first"),
        )
        .withColumn("earliest", F.min("first.id").over(Window.partitionBy("key")))
    )
    earliest = F.when(F.col("first.id") == F.col("earliest"), F.col("first.n")).otherwise(0)
    repeated = F.col("n_known") - earliest
    both = F.array(
        F.struct(F.col("bits").bitwiseOR(COPY_BIT).alias("mask"), repeated.alias("n")),
        F.struct(F.col("bits").alias("mask"), (F.col("n") - repeated).alias("n")),
    )
    split = copies.select("part", "good", "toxic", F.inline(both)).filter("n > 0")
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def prefix_levels(masks: DataFrame, letters: str) -> DataFrame:
    """filter_order (a prefix), step, letter, mask and what the step does with a
    document of that mask: kept, removed, redundant, alone (each 0 or 1)."""
    if not 0 < len(letters) <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters can be audited, not {len(letters)}")
    return masks.sparkSession.sql(
        f"""
        WITH RECURSIVE unused(was, letter, bit) AS (
          SELECT was, substr('{letters}', place + 1, 1), shiftleft(1, place)
          FROM (SELECT CAST(id AS INT) AS was, explode(sequence(0, {len(letters) - 1})) AS place
                FROM range({1 << len(letters)}))
          WHERE was & shiftleft(1, place) = 0
        ),
        levels(filter_order, step, letter, bit, was, applied, mask) AS (
          SELECT CAST('' AS STRING), 0, CAST('' AS STRING), 0, 0, 0, mask FROM {{masks}}
          UNION ALL
          SELECT concat(l.filter_order, u.letter), l.step + 1, u.letter, u.bit, u.was, u.was | u.bit, l.mask
          FROM levels l JOIN unused u ON l.applied = u.was
        )
        SELECT filter_order, step, letter, mask,
               CAST(mask & applied = 0 AS INT) AS kept,
               CAST(mask & bit <> 0 AND mask & was = 0 AS INT) AS removed,
               CAST(mask & bit <> 0 AND mask & was <> 0 AS INT) AS redundant,
               CAST(mask = bit AS INT) AS alone
        FROM levels WHERE step > 0
        """,
        masks=masks,
    )


def interactions(cells: DataFrame, scratch: Scratch, letters: str) -> DataFrame:
    """cells (part, mask, n, good, toxic), bit ``i`` of a mask standing for letter
    ``i``. For every part, order of all letters and step: kept, removed,
    redundant, unique_fails, good_lost, toxic_lost and shapley."""
    cells = scratch.save(cells)
    levels = prefix_levels(cells.select("mask").distinct(), letters)
    # a row per prefix and mask: their number is fixed by that of the filters
    joined = cells.join(F.broadcast(levels), "mask")

    def total(count: str, flag: str) -> Column:
        return F.sum(F.col(count) * F.col(flag))

    steps = scratch.save(
        joined.groupBy("part", "filter_order", "step", "letter").agg(
            total("n", "kept").alias("kept"),
            total("n", "removed").alias("removed"),
            total("n", "redundant").alias("redundant"),
            total("n", "alone").alias("unique_fails"),
            total("good", "removed").alias("good_lost"),
            total("toxic", "removed").alias("toxic_lost"),
        )
    )
    size = len(letters)
    orders_with = F.element_at(F.array(*(F.lit(factorial(size - k)) for k in range(1, size + 1))), F.col("step"))
    shapley = steps.groupBy("part", "letter").agg(F.sum(F.col("removed") * orders_with).alias("shapley"))
    orders = steps.filter(F.col("step") == size).select(
        "part", F.col("filter_order").alias("whole"), F.explode(F.sequence(F.lit(1), F.lit(size))).alias("at")
    )
    prefixes = orders.withColumn("filter_order", F.expr("substr(whole, 1, at)"))
    found = prefixes.join(steps, ["part", "filter_order"]).join(shapley, ["part", "letter"])
    return found.select(
        "part", F.col("whole").alias("filter_order"), F.col("at").alias("step"), "kept", "removed",
        "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley", F.col("letter").alias("filter"),
    )


def audit(docs: DataFrame, labels: DataFrame, scratch: Scratch, **names: str) -> DataFrame:
    """The audit of the five filters A to E over whole texts."""
    return interactions(mask_cells(docs, labels, **names), scratch, LETTERS)
