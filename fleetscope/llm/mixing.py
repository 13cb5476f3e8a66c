"""Mixing sources to target weights by a splitting tree over blocks.

Documents of each source are dealt by hash into blocks, a random partition, and
the blocks' order is a random permutation. A source's target is a number of
whole passes over its blocks, a run of further blocks, part of one more, whose
documents are taken in the order of their hashes as far as they fit, and one
closing document that comes nearest to what is then left. The drawn blocks of all sources are then dealt to
output shards by a binary tree: every node divides its block quotas exactly,
each source's share drawn from the multivariate hypergeometric distribution.
Shards draw consecutive, hence disjoint, runs of each source's permuted blocks,
and shuffle them locally.

Targets share the total size by weight; a target stops at ``ceiling`` times its
source's size and the excess is shared again by weight, until none is above.

A null text has size 0; a null source comes last and is a source like others. A
document without words is never taken. Rows that repeat an id are taken
together. Quotas need one row per source, as do the weights themselves; nothing
else is gathered. An empty table gives an empty result. Draws are hashes of ids,
so reruns agree. Other columns pass unchanged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.llm.columns import fresh, word_count
from fleetscope.sinks.storage import Scratch

WEIGHTS = (5, 2, 1)
CEILING = 3
BLOCK_BITS = 10
BLOCKS = 1 << BLOCK_BITS
SHARDS = 16
_EXACT = "decimal(38,0)"


def _draw(id: Column) -> Column:
    """32 random bits of a document; the high ones are its block."""
    digest = F.md5(F.concat(F.lit("mix:"), F.coalesce(id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def _block(draw: Column) -> Column:
    return F.shiftright(draw, 32 - BLOCK_BITS).cast("int")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """source, source_size -> with its target. One row per source."""
    ranked = Window.orderBy(F.col("source").isNull(), "source")
    place = (F.row_number().over(ranked) - 1) % len(weights)
    table = F.array(*[F.lit(w) for w in weights])
    found = sizes.withColumn("weight", F.get(table, place).cast("bigint"))
    found = found.withColumn("most", (ceiling * F.col("source_size")).cast(_EXACT))
    rising = Window.orderBy(F.col("most").cast("double") / F.col("weight"), F.col("source").isNull(), "source")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    # if all sources with a lower ceiling per weight stop there, does this one too?
    total = F.sum(F.col("source_size").cast(_EXACT)).over(everything)
    rest = total - F.coalesce(F.sum("most").over(before), F.lit(0).cast(_EXACT))
    others = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    found = found.withColumns({"total": total, "stops": F.col("weight") * rest > F.col("most") * others})
    left = F.col("total") - F.coalesce(F.sum(F.when(F.col("stops"), F.col("most"))).over(everything), F.lit(0).cast(_EXACT))
    shared = F.sum(F.when(~F.col("stops"), F.col("weight"))).over(everything)
    open_target = F.try_divide((F.col("weight") * left).cast("double"), shared.cast("double"))
    target = F.when(F.col("stops"), F.col("most").cast("double")).otherwise(F.coalesce(open_target, F.lit(0.0)))
    return found.select("source", "source_size", target.alias("target"))


def _passes(sized: DataFrame, scratch: Scratch, weights, ceiling) -> DataFrame:
    """Per source: target, whole passes, blocks of the last pass, and in the
    block after these the last document taken (null: none)."""
    blocks = scratch.save(sized.groupBy("source", "block").agg(F.sum("size").alias("words")))
    sizes = blocks.groupBy("source").agg(F.sum("words").alias("source_size"))
    plan = scratch.save(targets(sizes, weights, ceiling))
    size = F.col("source_size")
    passes = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(F.lit(0)).cast("int")
    plan = plan.withColumn("passes", passes)
    plan = plan.withColumn("rest", F.col("target") - F.col("passes") * size)
    by_source = Window.partitionBy("source").orderBy("block")
    through = F.sum("words").over(by_source.rowsBetween(Window.unboundedPreceding, 0))
    other = plan.select(F.col("source").alias("of"), "rest")
    running = blocks.withColumn("through", through)
    running = running.join(other, running["source"].eqNullSafe(other["of"]))
    cut = running.filter("through > rest").groupBy("source").agg(
        F.min_by(F.struct("block", (F.col("rest") - F.col("through") + F.col("words")).alias("room")), F.col("block")).alias("cut")
    ).select(F.col("source").alias("of"), F.col("cut.block").alias("cut_block"), F.col("cut.room").alias("room"))
    plan = plan.join(cut, plan["source"].eqNullSafe(cut["of"]), "left").drop("of")
    # a rest that reaches the source's end, by rounding, is another whole pass
    plan = plan.withColumn("cut_block", F.when(F.col("rest") > 0, F.coalesce("cut_block", F.lit(BLOCKS))).otherwise(F.lit(0)))
    plan = plan.withColumn("room", F.coalesce("room", F.lit(0.0)))
    plan = scratch.save(plan)
    wanted = plan.select(F.col("source").alias("of"), F.col("cut_block").alias("at"), "room").filter("room > 0")
    inside = sized.join(wanted, sized["source"].eqNullSafe(wanted["of"]) & (sized["block"] == wanted["at"]))
    together = inside.groupBy("source", "draw", "id").agg(F.sum("size").alias("size"), F.min("room").alias("room"))
    in_order = Window.partitionBy("source").orderBy("draw", "id").rowsBetween(Window.unboundedPreceding, 0)
    last = (
        together.withColumn("through", F.sum("size").over(in_order)).filter("through <= room")
        .groupBy(F.col("source").alias("of"))
        .agg(F.max(F.struct("draw", "id")).alias("last"), F.max("through").alias("used"))
    )
    plan = plan.join(last, plan["source"].eqNullSafe(last["of"]), "left").drop("of")
    plan = plan.withColumn("left", F.col("room") - F.coalesce("used", F.lit(0))).drop("used")
    plan = scratch.save(plan)
    short = plan.select(F.col("source").alias("of"), "cut_block", "last", "left").filter("left > 0")
    rows = sized.join(short, sized["source"].eqNullSafe(short["of"]))
    in_run = (F.col("block") < F.col("cut_block")) | F.coalesce(_until_last(F.col("draw"), F.col("id"), F.struct("cut_block", "last")), F.lit(False))
    others = rows.filter(~in_run).groupBy("source", "draw", "id").agg(F.sum("size").alias("size"), F.min("left").alias("left"))
    error = F.abs(F.col("size") - F.col("left"))
    closing = (
        others.filter(error < F.col("left")).groupBy(F.col("source").alias("of"))
        .agg(F.min(F.struct(error.alias("error"), "draw", "id")).alias("closing"))
        .select("of", F.struct("closing.draw", "closing.id").alias("closing"))
    )
    plan = plan.join(closing, plan["source"].eqNullSafe(closing["of"]), "left").drop("of", "left")
    return scratch.save(plan)


def _until_last(draw: Column, id: Column, plan: Column) -> Column:
    """Whether a document of the cut block is taken; null if none is."""
    place = F.struct(draw.alias("draw"), id.alias("id"))
    return (_block(draw) == plan["cut_block"]) & (place <= plan["last"])


def _divide(quotas: Column, wanted: Column, total: Column, node: Column, seed: int) -> Column:
    """How many of each source's blocks go left, if ``wanted`` of all ``total``
    do: the multivariate hypergeometric distribution, by selection sampling."""

    def choose(state: Column, quota: Column) -> Column:
        start = F.struct(state["need"].alias("need"), state["left"].alias("left"))

        def one(s: Column, k: Column) -> Column:
            bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), node, quota["source"], k), 11)
            taken = (bits.cast("double") * (2.0**-53) * s["left"] < s["need"]).cast("bigint")
            return F.struct((s["need"] - taken).alias("need"), (s["left"] - 1).alias("left"))

        units = F.filter(F.sequence(F.lit(0).cast("bigint"), quota["n"]), lambda k: k > 0)
        end = F.aggregate(units, start, one)
        return F.aggregate(
            F.array(end), state,
            lambda s, e: F.struct(
                e["need"].alias("need"), e["left"].alias("left"),
                F.concat(s["chosen"], F.array(s["need"] - e["need"])).alias("chosen"),
            ),
        )

    start = F.struct(
        wanted.alias("need"), total.alias("left"), F.array().cast("array<bigint>").alias("chosen")
    )
    return F.aggregate(quotas, start, choose)["chosen"]


def splitting_tree(quotas: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """quotas (source, n blocks) -> source, ends: the running totals of the
    blocks that its shards draw."""
    structs = F.array_sort(F.collect_list(F.struct(F.col("source").isNull().alias("last"), "source", "n")))
    nodes = quotas.agg(structs.alias("quotas")).select(
        F.lit(0).alias("low"), F.lit(shards).alias("high"), "quotas"
    )
    width = shards
    while width > 1:
        total = F.aggregate("quotas", F.lit(0).cast("bigint"), lambda n, q: n + q["n"])
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        nodes = nodes.withColumns({"total": total, "middle": middle})
        share = (F.col("middle") - F.col("low")) / (F.col("high") - F.col("low"))
        wanted = F.floor(F.col("total") * share).cast("bigint")
        node = F.col("low") * (shards + 1) + F.col("high")
        nodes = nodes.withColumn("chosen", _divide(F.col("quotas"), wanted, F.col("total"), node, seed))

        def part(count):
            return F.zip_with(
                "quotas", "chosen",
                lambda q, c: F.struct(q["last"].alias("last"), q["source"].alias("source"), count(q, c).alias("n")),
            )

        halves = F.array(
            F.struct(F.col("low").alias("low"), F.col("middle").alias("high"), part(lambda q, c: c).alias("quotas")),
            F.struct(F.col("middle").alias("low"), F.col("high").alias("high"), part(lambda q, c: q["n"] - c).alias("quotas")),
        )
        nodes = nodes.select(F.explode(halves).alias("half")).select("half.*").filter("low < high")
        width = -(-width // 2)
    leaves = nodes.select("low", F.explode("quotas").alias("q")).select("low", "q.source", "q.n")
    ordered = F.array_sort(F.collect_list(F.struct("low", "n")))
    drawn = leaves.groupBy("source").agg(ordered.alias("drawn"))
    ends = F.transform(
        "drawn",
        lambda d, k: F.aggregate(F.slice("drawn", 1, k + 1), F.lit(0).cast("bigint"), lambda n, x: n + x["n"]),
    )
    return drawn.select("source", ends.alias("ends"))


def mix(
    docs: DataFrame, scratch: Scratch, id: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[int] = WEIGHTS, ceiling: int = CEILING, shards: int = SHARDS, seed: int = 0,
) -> tuple[DataFrame, list[str]]:
    """``docs`` with the columns size, source_size, target, taken and copies (an
    array of shard and place, one for each time the document is taken). The
    second result names these columns, which differ where ``docs`` has them."""
    sized = docs.select(
        docs[id].alias("id"), docs[source].alias("source"), word_count(docs[text]).alias("size")
    )
    sized = sized.withColumn("draw", _draw(F.col("id"))).withColumn("block", _block(F.col("draw")))
    sized = scratch.save(sized)
    plan = _passes(sized, scratch, weights, ceiling)
    part = F.col("last").isNotNull() | F.col("closing").isNotNull()
    units = F.col("passes") * BLOCKS + F.col("cut_block") + part.cast("int")
    tree = splitting_tree(plan.select("source", units.cast("bigint").alias("n")), shards, seed)
    plan = plan.join(tree.withColumnRenamed("source", "of"), plan["source"].eqNullSafe(F.col("of")), "left")
    plan = scratch.save(plan.drop("of", "rest", "room"))
    names = fresh(docs, "size", "source_size", "target", "taken", "copies")
    mine = {c: f"mix_{c}" for c in plan.columns}
    (row, size, draw) = fresh(docs, "mix_row", "mix_size", "mix_draw")
    plan = plan.select(F.struct(*plan.columns).alias(row))
    found = docs.withColumns({size: word_count(docs[text]), draw: _draw(docs[id])})
    found = found.join(plan, F.col(f"`{source}`").eqNullSafe(F.col(row)["source"]), "left")
    of, block = F.col(row), _block(F.col(draw))
    in_part = F.coalesce(_until_last(F.col(draw), F.col(f"`{id}`"), of), F.lit(False))
    place = F.struct(F.col(draw).alias("draw"), F.col(f"`{id}`").alias("id"))
    in_part |= F.coalesce(place.eqNullSafe(of["closing"]), F.lit(False)) & of["closing"].isNotNull()
    unit = F.when(in_part, of["cut_block"]).otherwise(block)  # a closing document joins that part
    extra = (in_part | (block < of["cut_block"])).cast("int")
    times = F.when(F.col(size) > 0, of["passes"] + extra).otherwise(F.lit(0))
    turns = F.filter(F.sequence(F.lit(0), times), lambda k: k < times)
    copies = F.transform(
        turns,
        lambda k: F.struct(
            F.size(
                F.filter(of["ends"], lambda end: end <= k * BLOCKS + F.when(k < of["passes"], block).otherwise(unit))
            ).alias("shard"),
            F.xxhash64(F.lit(seed), F.col(f"`{id}`"), k).alias("place"),
        ),
    )
    values = [F.col(size), of["source_size"], of["target"], F.col(size) * times, copies]
    kept = [F.col(f"`{c}`") for c in docs.columns]
    return found.select(*kept, *[v.alias(n) for v, n in zip(values, names, strict=True)]), names


def arranged(mixed: DataFrame, copies: str, shards: int = SHARDS) -> DataFrame:
    """A row for every copy, gathered by shard and shuffled within it."""
    shard, place = fresh(mixed, "shard", "place")
    (copy,) = fresh(mixed, "copy")
    rows = mixed.withColumn(copy, F.explode(copies)).withColumns(
        {shard: F.col(copy)["shard"], place: F.col(copy)["place"]}
    )
    return rows.drop(copy, copies).repartition(shards, shard).sortWithinPartitions(shard, place)
