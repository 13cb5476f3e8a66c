"""N-gram Jaccard self-join by parity sketches.

A document's set is its distinct word shingles. Its parity sketch has a bit for
every possible shingle hash, toggled by each shingle, so the Hamming distance of
two sketches is at most the size of the symmetric difference; a similarity of at
least t bounds that by (1 - t) / (1 + t) * (|A| + |B|). Documents are compared
in bands of sizes; in a band whose bound is d, the sketch is cut into more than
d blocks, and by the pigeonhole principle a similar pair agrees in at least one
whole block. Blocks are represented by the XOR of their shingles' hashes, and
equal blocks meet in an equi-join. Enough blocks are cut that, for all but a few
documents, one that isn't empty must agree; those few match by empty blocks too.

Equal sets are one node, represented once. With each node a sketch of 2 to 4 bits
a shingle is kept; before a pair's texts are fetched, the Hamming distance of its
sketches must be within the bound. In the group of a block, every node is compared
with the first one. Groups whose other nodes are not all connected by then are cut
into chunks; in a task, chunk meets chunk by sketches, and of the pairs within the
bound only those go out that would join two components, as a spanning forest. So
what is verified stays linear in the group, while pairs that are linked are not
multiplied out. After some rounds every pair is verified that is still apart and
within the bound, so the components are exact. Verification intersects the whole
sets of both texts, in tasks; nothing is collected.

A null or empty text has an empty set, which is linked with nothing. Repeated
rows are nodes like other copies. A null id is larger than any other. An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.llm import words
from fleetscope.llm.components import connected_components
from fleetscope.sinks.storage import Scratch

SHINGLE = 5
NEAR, WHOLE = 80, 100  # linked if WHOLE * intersection >= NEAR * union
_BAND_RATIO = 1.5
_SLACK = 0.12
ROUNDS = 2  # of spanning forests, before every pair within the bound is verified
_CHUNK_ROWS, _CHUNK_BYTES = 1024, 4 << 20  # of a group's nodes and their sketches


def shingle_sets(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    """For every text, the sorted distinct hashes of its shingles; a text of
    fewer words than a shingle has one, of its whole sequence."""
    found = words.split_words(batch.column("text"))
    hashes = found.hashes(lower=True)
    windows = words.window_hashes(hashes, size)
    for first, end in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        if end - first >= size:
            every = np.sort(windows[first : end - size + 1])
            yield every[np.append(True, every[1:] != every[:-1])]
        elif end > first:
            yield words.window_hashes(hashes[first:end], end - first)
        else:
            yield hashes[:0]


def set_node(shingles: np.ndarray) -> int:
    """One number for equal sets."""
    seed = words.mix(shingles ^ np.uint64(0xA0761D6478BD642F))
    both = np.array([seed.sum(dtype=np.uint64), len(shingles)], dtype=np.uint64)
    return int(words.signed(words.window_hashes(both, 2))[0])


def _limits(near: int, whole: int) -> tuple[int, int]:
    """(1 - t) / (1 + t) as a fraction."""
    return whole - near, whole + near


def bands_of(size: int, near: int = NEAR, whole: int = WHOLE) -> list[tuple[int, int]]:
    """(band, most differences) for the bands in which a set of this size is
    compared: its own, and the next if a similar set can lie there."""
    low, band = 1, 0
    while (high := max(low + 1, int(low * _BAND_RATIO))) <= size:
        low, band = high, band + 1
    over, under = _limits(near, whole)
    found = []
    for _ in range(2):
        if whole * size >= near * low:
            found.append((band, 2 * (high - 1) * over // under))
        low, high, band = high, max(high + 1, int(high * _BAND_RATIO)), band + 1
    return found


def block_keys(shingles: np.ndarray, near: int = NEAR, whole: int = WHOLE) -> np.ndarray:
    """The keys of a set's sketch blocks, over the bands it is compared in."""
    size = len(shingles)
    keys = []
    seed = words.mix(shingles + np.uint64(0xE7037ED1A0B428DB))
    for band, bound in bands_of(size, near, whole) if size else ():
        if not bound:
            continue  # only equal sets are similar: they are one node already
        blocks = bound + 2 + int(bound * _SLACK)
        block = shingles % np.uint64(blocks)
        order = np.argsort(block)
        sorted_blocks = block[order]
        starts = np.flatnonzero(np.append(True, sorted_blocks[1:] != sorted_blocks[:-1]))
        parity = np.bitwise_xor.reduceat(seed[order], starts)
        place = np.uint64(band << 32) + np.arange(blocks, dtype=np.uint64)
        place = words.mix(place + np.uint64(1))
        here = sorted_blocks[starts].astype(np.intp)
        keys.append(words.mix(parity ^ place[here]))
        # of the blocks that must agree, is one bound to hold a shingle?
        own_bound = min(bound, size * (whole - near) // near)
        if blocks - own_bound <= blocks - len(starts):
            empty = np.ones(blocks, dtype=bool)
            empty[here] = False
            keys.append(words.mix(place[empty]))
    return np.concatenate(keys) if keys else np.empty(0, dtype=np.uint64)


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """Words of a power of two of bits, at least two for each shingle; a shingle
    toggles the bit that its hash names."""
    bits = max(64, 1 << (2 * len(shingles) - 1).bit_length())
    place = (words.mix(shingles ^ np.uint64(0x8EBC6AF09C88C6E3)) & np.uint64(bits - 1)).astype(np.intp)
    odd = (np.bincount(place, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.uint64)


def folded(sketches: np.ndarray, length: int) -> np.ndarray:
    """Sketches (along the last axis) as they would be with ``length`` words."""
    while sketches.shape[-1] > length:
        half = sketches.shape[-1] // 2
        sketches = sketches[..., :half] ^ sketches[..., half:]
    return sketches


def sketch_distance(a: np.ndarray, b: np.ndarray) -> int:
    """At most the size of the symmetric difference."""
    length = min(len(a), len(b))
    return int(np.bitwise_count(folded(a, length) ^ folded(b, length)).sum())


def _nodes(docs: DataFrame, size: int) -> DataFrame:
    """A row per document: id, text_hash, size of its set, node, sketch."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            sizes, nodes, sketches = [], [], []
            for shingles in shingle_sets(batch, size):
                sizes.append(len(shingles))
                nodes.append(set_node(shingles) if len(shingles) else None)
                sketches.append(parity_sketch(shingles).tobytes() if len(shingles) else None)
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64())]
            columns += [pa.array(nodes, pa.int64()), pa.array(sketches, pa.binary())]
            names = ["id", "text_hash", "n_shingles", "node", "sketch"]
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["id"].dataType.simpleString()
    schema = f"id {kind}, text_hash bigint, n_shingles bigint, node bigint, sketch binary"
    return docs.mapInArrow(describe, schema)


def _keys(docs: DataFrame, size: int, near: int, whole: int) -> DataFrame:
    """(key, node) of every sketch block; a task emits equal sets once."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in words.slices(batches):
            keys, nodes = [], []
            for shingles in shingle_sets(batch, size):
                if len(shingles) and (node := set_node(shingles)) not in seen:
                    seen.add(node)
                    keys.append(block_keys(shingles, near, whole))
                    nodes.append(node)
            if keys:
                repeated = np.repeat(np.array(nodes), [len(k) for k in keys])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.signed(np.concatenate(keys))), pa.array(repeated)],
                    ["key", "node"],
                )

    return docs.select("text").mapInArrow(emit, "key bigint, node bigint")


def _within_bound(pairs: DataFrame, sketches: DataFrame, near: int, whole: int) -> DataFrame:
    """The pairs (a, b) whose sketches, of ``sketches`` (node, n, sketch), are no
    farther apart than those of similar sets can be."""
    over, under = _limits(near, whole)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of_a, of_b = batch.column("a_sketch"), batch.column("b_sketch")
            both = np.asarray(batch.column("n"))
            close = np.zeros(batch.num_rows, dtype=bool)
            for i in range(batch.num_rows):
                x = np.frombuffer(of_a[i].as_buffer(), dtype=np.uint64)
                y = np.frombuffer(of_b[i].as_buffer(), dtype=np.uint64)
                close[i] = under * sketch_distance(x, y) <= over * int(both[i])
            yield batch.select(["a", "b"]).filter(pa.array(close))

    side = lambda name: sketches.select(
        F.col("node").alias(name), F.col("n").alias(f"{name}_n"), F.col("sketch").alias(f"{name}_sketch")
    )
    joined = pairs.join(side("b"), "b").join(side("a"), "a")
    joined = joined.filter(whole * F.least("a_n", "b_n") >= near * F.greatest("a_n", "b_n"))
    joined = joined.select("a", "b", (F.col("a_n") + F.col("b_n")).alias("n"), "a_sketch", "b_sketch")
    return joined.mapInArrow(compare, "a bigint, b bigint")


def _texts_of(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, text): a text for each node of the pairs."""
    active = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    one_of = nodes.join(active, "node", "left_semi").groupBy("node").agg(
        F.min_by(F.struct("id", "text_hash"), F.struct(F.col("id").isNull(), "id", "text_hash")).alias("of")
    ).select("node", F.col("of.id").alias("of"), F.col("of.text_hash").alias("of_hash"))
    same = docs["id"].eqNullSafe(one_of["of"]) & (docs["text_hash"] == one_of["of_hash"])
    return docs.join(one_of, same).select("node", "text").dropDuplicates(["node"])


def _verify(pairs: DataFrame, texts: DataFrame, size: int, near: int, whole: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar."""

    def intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, x = None, None
        for whole_batch in batches:
            for batch in words.slices([whole_batch], "b_text"):
                of_a, linked = batch.column("a"), np.zeros(batch.num_rows, dtype=bool)
                of_b = pa.RecordBatch.from_arrays([batch.column("b_text")], ["text"])
                for i, y in enumerate(shingle_sets(of_b, size)):
                    if (a := of_a[i].as_py()) != last:
                        text = batch.column("a_text").slice(i, 1)
                        (x,) = shingle_sets(pa.RecordBatch.from_arrays([text], ["text"]), size)
                        last = a
                    both = np.sort(np.concatenate([x, y]))
                    common = int((both[1:] == both[:-1]).sum())
                    linked[i] = whole * common >= near * (len(both) - common)
                yield batch.select(["a", "b"]).filter(pa.array(linked))

    side = lambda name: texts.select(
        F.col("node").alias(name), F.col("text").alias(f"{name}_text")
    )
    joined = pairs.join(side("b"), "b").join(side("a"), "a")
    return joined.select("a", "b", "a_text", "b_text").mapInArrow(intersect, "a bigint, b bigint")


def similar_components(
    docs: DataFrame,
    scratch: Scratch,
    id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    near: int = NEAR,
    whole: int = WHOLE,
) -> DataFrame:
    """For every row of ``docs``: its id, text_hash, n_shingles, and label, equal
    for the documents of one component (null for empty sets)."""
    docs = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    nodes = scratch.save(_nodes(docs.select("id", "text_hash", "text"), size))
    by_key = Window.partitionBy("key").orderBy("node")
    until_here = by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    groups = (
        _keys(docs, size, near, whole)
        .withColumns({"first": F.first("node").over(until_here), "last": F.lag("node").over(by_key)})
        .filter("node != first AND node != last")
    )
    stars = scratch.save(groups.select("key", "first", "node"))
    met = scratch.save(stars.select(F.col("first").alias("a"), F.col("node").alias("b")).distinct())
    active = met.select(F.col("a").alias("node")).union(met.select("b")).distinct()
    sketches = scratch.save(
        nodes.select("node", F.col("n_shingles").alias("n"), "sketch")
        .join(active, "node", "left_semi").dropDuplicates(["node"])
    )
    done = scratch.save(_within_bound(met, sketches, near, whole))
    groups = scratch.save(_distinct_groups(stars))
    scratch.drop(stars, met)
    labels, more = None, done
    for turn in range(ROUNDS + 2):
        if turn:
            every = turn > ROUNDS
            found = scratch.save(_group_pairs(groups, sketches, labels, turn, every, near, whole).distinct())
            if not found.limit(1).count():
                scratch.drop(found)
                break
            more = scratch.save(found.join(done, ["a", "b"], "left_anti"))
            scratch.drop(found)
            if not more.limit(1).count():
                scratch.drop(more)
                continue
        texts = scratch.save(_texts_of(docs, nodes, more))
        links = _verify(more, texts, size, near, whole)
        if labels is None:
            labels = scratch.save(connected_components(links, scratch))
        else:
            merged = labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(links)
            before, labels = labels, scratch.save(connected_components(merged, scratch))
            before_done, done = done, scratch.save(done.union(more))
            scratch.drop(before, before_done, more)
        scratch.drop(texts)
    scratch.drop(groups, sketches, done)
    labelled = nodes.join(labels, "node", "left")
    return labelled.select("id", "text_hash", "n_shingles", F.coalesce("label", "node").alias("label"))


def _distinct_groups(stars: DataFrame) -> DataFrame:
    """stars (key, first, node) -> key, node: the nodes but the first of every
    group of at least three. Groups of the same nodes, as near copies form them
    in many blocks, are kept once."""
    sign = F.struct(
        "first", F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"),
    )
    signed = stars.groupBy("key", "first").agg(sign.alias("sign")).filter("sign.n > 1")
    kept = signed.groupBy("sign").agg(F.min("key").alias("key")).select("key")
    return stars.select("key", "node").join(kept, "key", "left_semi")


def _group_pairs(
    groups: DataFrame, sketches: DataFrame, labels: DataFrame, turn: int, every: bool, near: int, whole: int
) -> DataFrame:
    """Pairs (a, b) of nodes of one group, not connected by now and within the
    bound: a spanning forest of what they would connect, or ``every`` one."""
    over, under = _limits(near, whole)
    known = groups.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = known.groupBy("key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("rows")
    ).filter("low != high").select("key", "rows")
    members = known.join(mixed, "key").join(sketches, "node")
    widest = F.greatest(F.col("rows") / _CHUNK_ROWS, F.col("rows") * F.length("sketch") / _CHUNK_BYTES)
    # all members of a group must be cut alike: by the group's widest sketch
    chunks = members.groupBy("key").agg(F.max(F.ceil(widest)).alias("chunks"))
    mine = F.pmod(F.xxhash64("node"), F.col("chunks"))
    parted = (
        members.join(chunks, "key").withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
        .select(
            "key", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
            "mine", "node", "label", "n", "sketch",
        )
    )

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        node, label, n, mine = (
            np.asarray(group.column(name)) for name in ("node", "label", "n", "mine")
        )
        order = np.argsort(words.mix(node.view(np.uint64) + np.uint64(turn)))
        # the most common label first: its nodes need no comparison with each other
        found, counts = np.unique(label, return_counts=True)
        alike = label[order] == found[np.argmax(counts)]
        order = np.concatenate([order[alike], order[~alike]])
        node, label, n, mine = node[order], label[order].copy(), n[order], mine[order]
        across = group.column("low")[0].as_py() != group.column("high")[0].as_py()
        sketch = group.column("sketch")
        raw = [np.frombuffer(sketch[i].as_buffer(), dtype=np.uint64) for i in order.tolist()]
        length = np.array([len(x) for x in raw])
        at_width = {  # every sketch as wide as that; rows of narrower ones aren't read
            w: np.stack([folded(x, w) if len(x) >= w else np.zeros(w, np.uint64) for x in raw])
            for w in np.unique(length).tolist()
        }
        left, right = [], []
        for i in range(int(counts.max()), len(node)):
            may = label[:i] != label[i]
            may &= whole * np.minimum(n[:i], n[i]) >= near * np.maximum(n[:i], n[i])
            if across:
                may &= mine[:i] != mine[i]
            at = np.flatnonzero(may)
            if not len(at):
                continue
            apart = np.empty(len(at), dtype=np.int64)
            width = np.minimum(length[at], length[i])
            for w in np.unique(width).tolist():
                here = width == w
                differing = np.bitwise_count(at_width[w][at[here]] ^ at_width[w][i])
                apart[here] = differing.sum(axis=1, dtype=np.int64)
            close = under * apart <= over * (n[at] + n[i])
            at, apart = at[close], apart[close]
            if every:
                left += [node[i]] * len(at)
                right += node[at].tolist()
                continue
            while len(at):
                # the closest, later any: what was verified in vain isn't tried again
                j = at[int(np.argmin(apart))] if turn == 1 else at[0]
                left.append(node[i])
                right.append(node[j])
                label[label == label[j]] = label[i]
                open_ = label[at] != label[i]
                at, apart = at[open_], apart[open_]
        a, b = np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return parted.groupBy("key", "low", "high").applyInArrow(compare, "a bigint, b bigint")


def component_ids(docs: DataFrame, scratch: Scratch, id: str = "doc_id", **options) -> DataFrame:
    """id, text_hash, n_shingles and component_id, the smallest id of the
    component (the row's own where its set is empty)."""
    labelled = scratch.save(similar_components(docs, scratch, id=id, **options))
    smallest = labelled.groupBy("label").agg(F.min("id").alias("component_id"))
    joined = labelled.join(smallest, "label", "left")
    return joined.select(
        F.col("id").alias(id), "text_hash", "n_shingles",
        F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one_of_each(docs: DataFrame, scratch: Scratch, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component. Rows
    that repeat both id and text are one document, of which one row stays."""
    found = component_ids(docs, scratch, id=id, text=text)
    each = found.groupBy(F.col(id).alias("of"), F.col("text_hash").alias("of_hash")).agg(
        F.min("component_id").alias("component"), F.count(F.lit(1)).alias("n")
    )
    smallest = F.col("of").eqNullSafe(F.col("component"))
    # few among all documents: the texts of the others are not shuffled for them
    apart = scratch.save(each.filter(~smallest | (F.col("n") > 1)).select("of", "of_hash", smallest.alias("stays")))
    same = docs[id].eqNullSafe(apart["of"]) & (F.xxhash64(docs[text]) == apart["of_hash"])
    once = docs.join(apart, same, "left_anti")
    repeated = docs.join(apart.filter("stays"), same, "left_semi")
    return once.union(repeated.dropDuplicates([id, text]))
