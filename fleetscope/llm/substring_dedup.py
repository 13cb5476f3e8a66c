"""Removal of long passages that an earlier document has, by suffix trees that
are partitioned by prefixes.

The words of a document from any place on are a suffix; two documents share a
passage of ``SPAN`` words where their suffixes branch below that depth, at a deep
internal node of the suffix tree. The tree is never built whole. Each suffix is
represented by a prefix taken from its first SPAN words, the GRAM words whose
hash is smallest among them, so that equal suffixes have equal prefixes and a
text has few of them. Only prefixes that occur in several documents branch.
Suffixes of these are partitioned by prefix into groups; a prefix with more than
``GROUP`` occurrences is lengthened to the whole span, which splits its group into
single nodes. A group's suffixes are sorted to depth SPAN, in which order the
suffixes below one deep node follow each other, the earliest document first;
those of later documents are repeats. The order is made by an external sort and
read as a stream, so no group has to fit into memory. Neighbouring repeats of a
document add up to its maximal ones.

Of documents with the same words only the earliest takes part; the others go
whole if they are at least SPAN words long. A null or empty text has no words. Rows
that repeat id and text are one document; ids are integers, and a null one is
later than any other. An empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.llm import words
from fleetscope.sinks.storage import Scratch

SPAN = 50
GRAM = 8
GROUP = 2048
_LATEST = (1 << 63) - 1
_PLACE = np.uint64((1 << 20) - 1)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours."""
    rows = -(-len(x) // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(x)] = x
    blocks = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - width + 1
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def prefixes(hashes: np.ndarray, first: np.ndarray, span: int, gram: int):
    """For every suffix of at least ``span`` words: its start, the place of its
    prefix, and the hashes of all grams."""
    starts = words.inner_windows(first, span)
    grams = words.window_hashes(hashes, gram)
    if not len(starts):
        return starts, starts, grams
    # the smallest hash, and of equal ones the first place
    ranked = (grams & ~_PLACE) | (np.arange(len(grams), dtype=np.uint64) & _PLACE)
    smallest = _sliding_min(ranked, span - gram + 1)[starts]
    ahead = (smallest - starts.astype(np.uint64)) & _PLACE
    return starts, starts + ahead.astype(np.int64), grams


def _describe(docs: DataFrame, span: int, gram: int) -> DataFrame:
    """A row per document: its number of words, the hash and digest of all its
    words, and its distinct prefixes with their places."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            found = words.split_words(batch.column("text"))
            hashes = found.hashes()
            whole = words._range_hash(
                hashes, found.first[:-1], found.first[1:], words._WORD_BASE, words._WORD_INVERSE
            ) if len(hashes) else np.zeros(found.texts, dtype=np.uint64)
            _, places, grams = prefixes(hashes, found.first, span, gram)
            places = np.unique(places)
            bounds = np.searchsorted(places, found.first)
            digests = [
                hashlib.sha256(b" ".join((text or "").encode().split())).hexdigest()
                for text in batch.column("text").to_pylist()
            ]
            text_of = np.repeat(found.first[:-1], np.diff(bounds))
            offsets = pa.array(bounds.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("text_hash"),
                    pa.array(found.counts.astype(np.int64)), pa.array(words.signed(whole)), pa.array(digests),
                    pa.ListArray.from_arrays(offsets, pa.array(words.signed(grams[places]))),
                    pa.ListArray.from_arrays(offsets, pa.array((places - text_of).astype(np.int32))),
                ],
                ["id", "text_hash", "n_words", "whole", "digest", "prefixes", "places"],
            )

    schema = "id bigint, text_hash bigint, n_words bigint, whole bigint, digest string, prefixes array<bigint>, places array<int>"
    return docs.select("id", "text_hash", "text").mapInArrow(emit, schema)


def _suffixes(active: DataFrame, span: int, gram: int) -> DataFrame:
    """active (id, text, places, often) -> a row for every suffix whose prefix
    branches: group, node (hash of the suffix to its span), id, start, often."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            found = words.split_words(batch.column("text"))
            hashes = found.hashes()
            starts, places, grams = prefixes(hashes, found.first, span, gram)
            if not len(starts):
                continue
            column = batch.column("places")
            of_row = np.repeat(found.first[:-1], np.diff(column.offsets.to_numpy()))
            shared = column.flatten().to_numpy() + of_row
            often = batch.column("often").flatten().to_numpy(zero_copy_only=False)
            branches = np.zeros(len(grams) + 1, dtype=np.uint8)
            branches[shared] = 1 + often
            kind = branches[places]
            some = kind > 0
            starts, places, kind = starts[some], places[some], kind[some]
            nodes = words.window_hashes(hashes, span)[starts]
            text = np.searchsorted(found.first, starts, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(words.signed(grams[places])), pa.array(words.signed(nodes)),
                    batch.column("id").take(pa.array(text)), batch.column("text_hash").take(pa.array(text)),
                    pa.array((starts - found.first[text]).astype(np.int32)), pa.array(kind > 1),
                ],
                ["prefix", "node", "id", "text_hash", "start", "often"],
            )

    schema = "prefix bigint, node bigint, id bigint, text_hash bigint, start int, often boolean"
    return active.mapInArrow(emit, schema)


def _cut(active: DataFrame, span: int) -> DataFrame:
    """active (id, text_hash, text, starts) -> removed words and the digest of
    those kept."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            removed, digests = [], []
            texts = batch.column("text").to_pylist()
            starts = batch.column("starts")
            for text, at in zip(texts, range(batch.num_rows), strict=True):
                every = text.encode().split()
                from_here = starts[at].values.to_numpy()
                steps = np.zeros(len(every) + 1, dtype=np.int64)
                np.add.at(steps, from_here, 1)
                np.add.at(steps, from_here + span, -1)
                kept = np.cumsum(steps[:-1]) == 0
                removed.append(len(every) - int(kept.sum()))
                left = b" ".join([every[k] for k in np.flatnonzero(kept)])
                digests.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                ["id", "text_hash", "cut", "cut_digest"],
            )

    return active.select("id", "text_hash", "text", "starts").mapInArrow(
        emit, "id bigint, text_hash bigint, cut bigint, cut_digest string"
    )


def repeats(suffixes: DataFrame) -> DataFrame:
    """The suffixes that begin in an earlier document as well."""
    group = F.when(F.col("often"), F.xxhash64("prefix", "node")).otherwise(F.col("prefix"))
    in_group = Window.partitionBy("group").orderBy("node", "id")
    # below one node the earliest comes first: it is carried on while the node stays
    new_node = F.coalesce(F.lag("node").over(in_group) != F.col("node"), F.lit(True))
    marked = suffixes.withColumn("group", group).withColumn("head", F.when(new_node, F.col("id")))
    until_here = in_group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earliest = F.last("head", ignorenulls=True).over(until_here)
    late = marked.withColumn("earliest", earliest).filter("earliest < id")
    return late.select("id", "text_hash", "start")


def without_repeated_spans(
    docs: DataFrame, scratch: Scratch, id: str = "doc_id", text: str = "text", span: int = SPAN, gram: int = GRAM
) -> DataFrame:
    """id, n_words, n_removed, kept_sha256: one row per document."""
    own_id = docs[id].cast("bigint")
    docs = docs.select(F.coalesce(own_id, F.lit(_LATEST)).alias("id"), docs[text].alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    described = scratch.save(_describe(docs, span, gram))
    # of equal documents the earliest takes part
    alike = described.groupBy("whole", "n_words").agg(F.min("id").alias("earliest"))
    described = scratch.save(described.join(alike, ["whole", "n_words"]))
    own = described.filter((F.col("id") == F.col("earliest")) & (F.size("prefixes") > 0))
    listed = own.select("id", "text_hash", F.explode(F.arrays_zip("prefixes", "places")).alias("p"))
    listed = listed.select("id", "text_hash", F.col("p.prefixes").alias("prefix"), F.col("p.places").alias("place"))
    branching = scratch.save(
        listed.groupBy("prefix")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count(F.lit(1)).alias("n"))
        .filter("low != high")
        .select("prefix", (F.col("n") > GROUP).alias("often"))
    )
    shared = listed.join(branching, "prefix").groupBy("id", "text_hash").agg(
        F.array_sort(F.collect_set(F.struct("place", "often"))).alias("shared")
    )
    shared = scratch.save(
        shared.select(F.col("id").alias("of"), F.col("text_hash").alias("of_hash"),
                      F.col("shared.place").alias("places"), F.col("shared.often").alias("often"))
    )
    same = (docs["id"] == shared["of"]) & docs["text_hash"].eqNullSafe(shared["of_hash"])
    active = scratch.save(docs.join(shared, same).drop("of", "of_hash").dropDuplicates(["id", "text_hash"]))
    suffixes = scratch.save(_suffixes(active, span, gram))
    late = repeats(suffixes).groupBy("id", "text_hash").agg(F.collect_list("start").alias("starts"))
    cut = scratch.save(_cut(active.select("id", "text_hash", "text").join(late, ["id", "text_hash"]), span))
    scratch.drop(suffixes, active, shared, branching)
    copies = (F.col("id") != F.col("earliest")) & (F.col("n_words") >= span)
    joined = described.join(cut, ["id", "text_hash"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return joined.select(
        F.when(F.col("id") != _LATEST, F.col("id")).alias(id),
        "n_words",
        F.when(copies, F.col("n_words")).otherwise(F.coalesce("cut", F.lit(0))).alias("n_removed"),
        F.when(copies, F.lit(nothing)).otherwise(F.coalesce("cut_digest", "digest")).alias("kept_sha256"),
    )
