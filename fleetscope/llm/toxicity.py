"""Toxicity scores by a counterfactually regularised classifier.

A logistic regression on the presence of words and beginnings of words. It takes those whose share
differs between the classes of the training rows beyond chance, the clearest
first, and the identity terms. For every
training text that names a group, the term is swapped for each other of its
list, with its beginnings; the squared change of the score's logit is added to
the loss, so that terms naming groups come to weigh alike, and a small ridge draws what the labels
don't support to zero. The loss is convex and solved by Newton's method.

Labels are learnt from a bounded sample: the ``sample`` labelled rows that come
first in the order of a hash of their id (all of them, if there are fewer), texts
that are equal counting once. Scores need one pass over the texts, with some
hundred weights. Texts without any known word, empty and null ones included, get
the score of the bias. Repeated labels of an id count as toxic if any is;
repeated rows are scored alike. An empty table gives an empty result; without
labels of both kinds all scores are 0. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.llm import words
from fleetscope.sinks.storage import Scratch

SAMPLE = 20_000
CHOSEN = 256
STEMS = (4, 5, 6, 7, 8)  # bytes of a longer word's beginning
LEAST_TEXTS = 5
LEAST_CHI_SQUARE = 30.0  # beyond what chance shows among millions of words
RIDGE = 1.0
FAIRNESS = 10.0
THRESHOLD = 0.3

# fixed values: lists of terms that name groups; within a list they are swapped
IDENTITY_TERMS = (
    "women men woman man girls boys female male females males trans transgender nonbinary",
    "gay lesbian bisexual straight queer homosexual heterosexual homosexuals",
    "muslim christian jewish hindu buddhist sikh atheist catholic protestant",
    "muslims christians jews hindus buddhists sikhs atheists catholics protestants",
    "black white asian latino latina hispanic african european american arab indigenous",
    "mexican chinese indian german french spanish italian turkish russian polish",
    "immigrants refugees foreigners migrants natives citizens",
    "deaf blind disabled autistic old young elderly",
    "frauen männer muslime christen juden ausländer flüchtlinge",
    "femmes hommes musulmans chrétiens juifs étrangers immigrés",
    "mujeres hombres musulmanes cristianos judíos extranjeros inmigrantes",
)


def _identity_hashes() -> list[np.ndarray]:
    return [_features(pa.array([terms]), stems=())[1] for terms in IDENTITY_TERMS]


def _term_features() -> list[list[np.ndarray]]:
    """For every term of every list its hash, and those of its beginnings."""
    return [[_features(pa.array([term]))[1] for term in terms.split()] for terms in IDENTITY_TERMS]


def _features(texts: pa.Array, stems: tuple[int, ...] = STEMS) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every word of several texts, and of its beginnings."""
    found = words.bare_words(words.split_words(texts))
    small = found.data + 0x20 * words.latin_capitals(found.data).astype(np.uint8)
    found = replace(found, data=small)
    text, whole = found.text_of_word(), found.hashes(lower=True)
    if not stems:
        return text, whole
    starts, salts, of = [], [], []
    for size in stems:
        longer = found.ends - found.starts > size
        starts.append(found.starts[longer])
        of.append(text[longer])
        salts.append(np.full(len(starts[-1]), size, dtype=np.uint64))
    begin, size = np.concatenate(starts), np.concatenate(salts)
    cut = words.Words(found.data, begin, begin + size.astype(np.int64), found.first, found.text_starts)
    hashed = words.mix(cut.hashes(lower=True) + size)
    return np.concatenate([text, *of]), np.concatenate([whole, hashed])


def _present(texts: pa.Array, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, place in the sorted vocabulary)."""
    text, hashes = _features(texts)
    if not len(vocabulary) or not len(hashes):
        return text[:0], text[:0]
    place = np.searchsorted(vocabulary, hashes)
    place[place == len(vocabulary)] = 0
    hit = vocabulary[place] == hashes
    pairs = np.unique(text[hit] * len(vocabulary) + place[hit])
    return pairs // len(vocabulary), pairs % len(vocabulary)


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(text, toxic) of the training rows, each text once."""
    known = labels.filter("toxic IS NOT NULL").groupBy("id").agg(F.max("toxic").alias("toxic"))
    chosen = known.filter(~held_out(F.col("id"))).orderBy(F.md5(F.col("id").cast("string")), "id").limit(sample)
    # at most ``sample`` rows of two numbers
    rows = docs.join(F.broadcast(chosen), "id")
    once = rows.groupBy(F.xxhash64("text").alias("hash")).agg(
        F.first("text").alias("text"), (F.avg("toxic") >= 0.5).alias("toxic")
    )
    return once.select("text", "toxic")


def _choose_words(rows: DataFrame, chosen: int) -> np.ndarray:
    """The words that differ most between the classes, by chi-square."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            text, hashes = _features(batch.column("text"))
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)[text]
            pairs = np.unique(np.stack([hashes, text.astype(np.uint64)]), axis=1)
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)[pairs[1].astype(np.intp)]
            word, which = np.unique(pairs[0], return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(words.signed(word)),
                    pa.array(np.bincount(which, minlength=len(word))),
                    pa.array(np.bincount(which, weights=toxic, minlength=len(word)).astype(np.int64)),
                ],
                ["word", "n", "toxic"],
            )

    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("toxic").alias("toxic")).first()
    if not totals["toxic"] or totals["toxic"] == totals["n"]:
        return np.empty(0, dtype=np.uint64)
    counts = rows.mapInArrow(emit, "word bigint, n bigint, toxic bigint").groupBy("word").agg(
        F.sum("n").alias("n"), F.sum("toxic").alias("toxic")
    )
    share = totals["toxic"] / totals["n"]
    off = F.col("toxic") - F.col("n") * share
    chi_square = off * off / (F.col("n") * share * (1 - share))
    clear = counts.filter((F.col("n") >= LEAST_TEXTS) & (chi_square >= LEAST_CHI_SQUARE))
    best = clear.orderBy(chi_square.desc(), "word")
    found = [row["word"] for row in best.limit(chosen).collect()]
    return np.array(found, dtype=np.int64).view(np.uint64)


def _fit(rows: list[np.ndarray], toxic: np.ndarray, vocabulary: np.ndarray, ridge: float, fairness: float) -> np.ndarray:
    """Weights of the vocabulary, and last the bias."""
    size = len(vocabulary)
    x = np.zeros((len(rows), size + 1))
    for row, places in zip(x, rows, strict=True):
        row[places] = 1
    x[:, size] = 1
    penalty = np.diag(np.append(np.full(size, ridge), 1e-6))
    for terms in _term_features():
        has = np.zeros((len(terms), size + 1))
        for row, hashes in zip(has, terms, strict=True):
            row[np.flatnonzero(np.isin(vocabulary, hashes))] = 1
        named = x[:, np.searchsorted(vocabulary, [hashes[0] for hashes in terms])].sum(axis=0)
        for own, n in zip(has, named, strict=True):
            change = has - own  # swapping for each other term changes the logit by this
            penalty += 2 * fairness * n * change.T @ change
    weights = np.zeros(size + 1)
    for _ in range(30):
        score = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (score - toxic) + penalty @ weights
        curve = (x * (score * (1 - score))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def train(docs: DataFrame, labels: DataFrame, scratch: Scratch, sample: int = SAMPLE, chosen: int = CHOSEN) -> tuple[np.ndarray, np.ndarray]:
    """docs (id, text), labels (id, toxic) -> sorted vocabulary, weights."""
    rows = scratch.save(_sample(docs, labels, sample))
    picked = _choose_words(rows, chosen)
    if not len(picked):
        return picked, np.array([-np.inf])
    vocabulary = np.unique(np.concatenate([picked, *_identity_hashes()]))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            text, place = _present(batch.column("text"), vocabulary)
            bounds = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
            places = pa.ListArray.from_arrays(pa.array(bounds), pa.array(place.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([places, batch.column("toxic")], ["places", "toxic"])

    table = rows.mapInArrow(emit, "places array<int>, toxic boolean").collect()
    found = sorted((tuple(row["places"]), row["toxic"]) for row in table)  # sums don't depend on the order of tasks
    toxic = np.array([label for _, label in found], dtype=float)
    weights = _fit([np.array(p, dtype=np.intp) for p, _ in found], toxic, vocabulary, RIDGE, FAIRNESS)
    return vocabulary, weights


def toxicity(
    docs: DataFrame, labels: DataFrame, scratch: Scratch, id: str = "doc_id", text: str = "text",
    label_id: str = "doc_id", label: str = "toxic", threshold: float = THRESHOLD,
) -> DataFrame:
    """id, held_out, score, predicted: one row per document."""
    narrow = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    labelled = labels.select(labels[label_id].alias("id"), labels[label].cast("int").alias("toxic"))
    vocabulary, weights = train(narrow, labelled, scratch)
    model = docs.sparkSession.sparkContext.broadcast((vocabulary, weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights = model.value
        for batch in words.slices(batches):
            text, place = _present(batch.column("text"), vocabulary)
            logit = np.bincount(text, weights=weights[place], minlength=batch.num_rows) + weights[-1]
            scores = 1 / (1 + np.exp(-np.clip(logit, -700, 700)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                ["id", "held_out", "score", "predicted"],
            )

    kind = narrow.schema["id"].dataType.simpleString()
    marked = narrow.withColumn("held_out", held_out(F.col("id")))
    scored = marked.mapInArrow(score, f"id {kind}, held_out boolean, score double, predicted int")
    return scored.withColumnRenamed("id", id)
