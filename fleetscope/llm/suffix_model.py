"""Language-model scores by a probabilistic suffix tree over words.

Symbols are the words of the training texts and an end after each text. A node of
the tree is a run of one to ``DEPTH`` words as a context; the root is the
distribution of single symbols. Unknown words share the mass that words seen once
suggest (Good-Turing), as if there were as many of them. A context is counted if
it occurs ``LEAST`` times, in a corpus of any size, so that the tree grows with the
corpus and none of its contexts is lost when texts are added. It is retained if
what follows it diverges from what follows the context without its first word by
more than chance explains: a likelihood-ratio test over the followers seen
``KEPT`` times and one class of all others. A token is scored in the longest
retained suffix of what precedes it; its distribution takes ``DISCOUNT`` off every
kept follower, and spreads all mass that is left like the next shorter retained
suffix does, so that every state's probabilities sum up to one.

Texts are split into words once: every task cuts its texts into batches of about
``BATCH_TOKENS`` tokens, kept as numbers of the batch's words. A batch sends its
distinct words with their counts, and receives the totals. Then, depth by depth, it
sends its distinct runs of a counted context and the symbol after it, if that is
frequent enough, and receives their totals. Keys travel sorted, as packed bytes, to
one of many equal parts of all keys; a part, one task's group, adds up about
``PART_TOKENS`` of them. The totals are all that the test needs, so each run is
added to its context's sums by one of the batches that hold it. These sums are
added up and tested in the same way, and every batch learns which of its contexts
are retained. Nothing is broadcast or gathered; a word or run that is everywhere
is one key per batch. Spark deletes the shuffle files of each step at its end.

A null text is empty: its only token is the end. A very long text makes its batch
longer, and is split into words at once. A null id counts as training. Repeated
rows are separate texts. An empty table gives an empty result, and without any
training text every word is unknown and certain. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.llm import words
from fleetscope.sinks.storage import Scratch

DEPTH = 2
LEAST = 32  # occurrences of any context
DEEPER = 4  # a follower's symbol occurs at least a context's least count by this
KEPT = 3
DISCOUNT = 0.75
DIVERGENCE = 5.0  # standard deviations of the test statistic
BATCH_TOKENS = 2_500_000
PART_TOKENS = 1 << 21
END = np.uint64(0x9FB21C651E98DF25)  # the end of a text, as a word hash


def held_out(id: Column) -> Column:
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, ends included, and the bounds of the texts."""
    found = words.split_words(texts)
    hashes = np.insert(found.hashes(lower=True), found.first[1:], END)
    return hashes, found.first + np.arange(len(found.first))


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted distinct keys, a place of each, and the number of each place's key."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(keys), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[new], order[new], number


def _encoded(docs: DataFrame, kind: str) -> DataFrame:
    """Slices of the texts of each batch: their ids, the numbers of their tokens
    among the batch's words, and with one of the slices these words as hashes,
    frequent ones first, and their training counts."""

    def batch_of(number: int, slices: list) -> Iterator[pa.RecordBatch]:
        hashes = np.concatenate([h for _, h, _ in slices])
        train = np.concatenate([np.repeat(~b.column("held_out").to_numpy(zero_copy_only=False), n) for b, _, n in slices])
        word, _, token = _distinct(hashes)
        frequent = np.argsort(-np.bincount(token), kind="stable")
        rank = np.empty(len(word), dtype=np.int64)
        rank[frequent] = np.arange(len(word))
        token = rank[token]
        trained = np.bincount(token, weights=train, minlength=len(word)).astype(np.int64)
        at = 0
        for k, (batch, own, lengths) in enumerate(slices):
            columns = [
                pa.array([number], pa.int64()), *(_one_list(batch.column(c)) for c in ("id", "held_out")), _one_list(pa.array(lengths)),
                pa.array([words.packed(token[at : at + len(own)])]), pa.array([len(own)]),
                pa.array([word[frequent].tobytes() if not k else None], pa.binary()),
                pa.array([words.packed(trained) if not k else None], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["batch", "ids", "held_out", "lengths", "tokens", "n_tokens", "words", "trained"])
            at += len(own)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, slices = TaskContext.get().partitionId() << 32, 0, []
        for batch in words.slices(batches):
            hashes, first = _tokens(batch.column("text"))
            slices.append((batch.select(["id", "held_out"]), hashes, np.diff(first)))
            held += len(hashes)
            if held >= BATCH_TOKENS:
                yield from batch_of(number, slices)
                number, held, slices = number + 1, 0, []
        if slices:
            yield from batch_of(number, slices)

    return docs.mapInArrow(
        emit,
        f"batch bigint, ids array<{kind}>, held_out array<boolean>, lengths array<bigint>, "
        "tokens binary, n_tokens bigint, words binary, trained binary",
    )


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def least_counts(tokens: int, depth: int) -> list[float]:
    """How often contexts of 1, 2, ... words occur at least: as often among any
    number of training tokens."""
    return [float(LEAST)] * depth


def _follow(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """The node of a context and the symbol after it: ``xxhash64`` of both."""
    return words.xxhash64(context, symbol)


def _part_starts(parts: int) -> np.ndarray:
    """The least key of each part of the 64-bit keys."""
    return np.arange(parts, dtype=np.uint64) * np.uint64(((1 << 64) - 1) // parts)


SENT = "batch bigint, part bigint, keys binary, counts binary"
SUMS = "batch bigint, part bigint, keys binary, total_of binary, kept binary, seen binary, expected binary, gain binary, level bigint"


def _by_part(batch: int, keys: np.ndarray, parts: int, **values: np.ndarray) -> pa.Table:
    """A batch's sorted distinct keys and their values, one row for each part."""
    starts = _part_starts(parts)
    cuts = np.append(np.searchsorted(keys, starts), len(keys))
    some = np.flatnonzero(np.diff(cuts))
    bounds = [(cuts[p], cuts[p + 1]) for p in some.tolist()]
    columns = {
        "batch": pa.array(np.full(len(some), batch, dtype=np.int64)),
        "part": pa.array(some.astype(np.int64)),
        "keys": pa.array(
            [words.packed(np.diff(keys[a:b], prepend=starts[p])) for p, (a, b) in zip(some, bounds, strict=True)], pa.binary()
        ),
    }
    for name, x in values.items():
        pack = np.ndarray.tobytes if x.dtype == float else words.packed
        columns[name] = pa.array([pack(x[a:b]) for a, b in bounds], pa.binary())
    return pa.table(columns)


class _Part:
    """The rows of one part, put in order by batch: all keys, merged."""

    def __init__(self, given: pa.Table, parts: int) -> None:
        self.given = given.sort_by("batch")
        start = _part_starts(parts)[given.column("part")[0].as_py()]
        deltas = [words.unpacked(x.as_py()) for x in self.given.column("keys")]
        self.ends = np.cumsum([len(x) for x in deltas])
        keys = np.concatenate([start + np.cumsum(x, dtype=np.uint64) for x in deltas])
        self.order = np.argsort(keys, kind="stable")  # merges sorted runs
        keys = keys[self.order]
        self.firsts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))

    def values(self, name: str, floats: bool = False) -> np.ndarray:
        rows = [x.as_py() for x in self.given.column(name)]
        if floats:
            return np.frombuffer(b"".join(rows), dtype=float)[self.order]
        return np.concatenate([words.unpacked(x) for x in rows]).astype(np.int64)[self.order]

    def sums(self, name: str, floats: bool = False) -> np.ndarray:
        return np.add.reduceat(self.values(name, floats), self.firsts)

    def told(self, values: np.ndarray, own: np.ndarray | None = None) -> list[np.ndarray]:
        """For each row the values of its keys; ``own`` is added in one of the rows."""
        found = np.empty(len(self.order), dtype=values.dtype)
        found[self.order] = np.repeat(values, np.diff(np.append(self.firsts, len(self.order))))
        if own is not None:
            found[self.order[self.firsts]] += own
        return np.split(found, self.ends[:-1])


def _totals(sent: DataFrame, level: int, parts: int, least: int) -> DataFrame:
    """The totals of the keys that the batches have sent, for each batch and part in
    the order of its keys: twice the total, or 0 if that is below ``least``, and one
    more in one of the batches that hold the key. tokens, distinct and single: sums
    over the keys of which the row has that one."""

    def emit(given: pa.Table) -> pa.Table:
        part = _Part(given, parts)
        sums = part.sums("counts")
        sums[sums < least] = 0
        each = part.told(2 * sums, sums > 0)
        own = [x[x & 1 > 0] >> 1 for x in each]
        return pa.table(
            [
                part.given.column("batch"), part.given.column("part"), pa.array([words.packed(x) for x in each], pa.binary()),
                *(pa.array([int(f(x)) for x in own], pa.int64()) for f in (np.sum, len, lambda x: np.sum(x == 1))),
            ],
            ["batch", "part", "found", "tokens", "distinct", "single"],
        )

    schema = "batch bigint, part bigint, found binary, tokens bigint, distinct bigint, single bigint"
    return sent.groupBy("part").applyInArrow(emit, schema).withColumn("level", F.lit(level))


def _retained(sums: DataFrame, parts: int) -> DataFrame:
    """For each batch, level and part, in the order of its counted contexts: the mass
    that a retained one leaves to the next shorter, 0 for one that is not retained."""

    def emit(given: pa.Table) -> pa.Table:
        part = _Part(given, parts)
        total = part.values("total_of")[part.firsts]
        kept, seen = part.sums("kept"), part.sums("seen")
        expected, gain = part.sums("expected", True), part.sums("gain", True)
        other = total - seen
        chance = np.maximum(1 - expected, 1e-9) * total
        gain += np.where(other > 0, other * np.log(np.maximum(other, 1) / chance), 0.0)
        retained = 2 * gain > kept + DIVERGENCE * np.sqrt(2 * kept)
        rest = np.where(retained, (other + DISCOUNT * kept) / total, 0.0)
        columns = [part.given.column(c) for c in ("batch", "level", "part")]
        return pa.table([*columns, pa.array([x.tobytes() for x in part.told(rest)], pa.binary())], ["batch", "level", "part", "rest"])

    return sums.groupBy("level", "part").applyInArrow(emit, "batch bigint, level bigint, part bigint, rest binary")


@dataclass
class _Level:
    """Words (level 0) or runs of a context and a symbol that a batch holds. By
    number: key, training total, whether this batch is the one that stands for it,
    a place where it ends and its context; by place: the number that ends there."""

    keys: np.ndarray
    at: np.ndarray
    context: np.ndarray
    number: np.ndarray  # -1: none
    total: np.ndarray | None = None
    own: np.ndarray | None = None

    def told(self, given: pa.Table, level: int) -> None:
        """Take the totals, which come in the order of the keys."""
        mine = given.filter(pa.array(given.column("level").to_numpy() == level))
        mine = mine.filter(mine.column("found").is_valid()).sort_by("part")
        found = np.concatenate([np.empty(0, np.uint64), *(words.unpacked(x.as_py()) for x in mine.column("found"))])
        order = np.argsort(self.keys) if level == 0 else slice(None)
        self.total, self.own = np.empty(len(self.keys), dtype=np.int64), np.empty(len(self.keys), dtype=bool)
        self.total[order] = found >> np.uint64(1)
        self.own[order] = found & np.uint64(1)


class _Batch:
    """The texts of one batch and what it has been told of its words and runs."""

    def __init__(self, texts: pa.Table, given: pa.Table, least: list[float], depth: int, told: int) -> None:
        """With the runs of ``depth`` levels, of which the first ``told`` have totals."""
        texts = texts.combine_chunks()
        self.id = texts.column("batch")[0].as_py()
        self.ids, self.held_out, lengths = (texts.column(c).combine_chunks().flatten() for c in ("ids", "held_out", "lengths"))
        lengths = lengths.to_numpy()
        self.first = np.append(0, np.cumsum(lengths))
        self.train = np.repeat(~self.held_out.to_numpy(zero_copy_only=False), lengths)
        token = np.concatenate([words.unpacked(x.as_py()) for x in texts.column("tokens")]).astype(np.int64)
        word = np.frombuffer(texts.column("words").drop_null()[0].as_py(), dtype=np.uint64)
        none = np.empty(0, dtype=np.int64)
        self.levels = [_Level(word, none, none, token)]
        self.levels[0].told(given, 0)
        self.place = words.ranges(np.zeros(len(lengths), dtype=np.int64), lengths)
        for d in range(1, depth + 1):
            self.levels.append(self._follow_up(least, d))
            if d <= told:
                self.levels[d].told(given, d)

    def _follow_up(self, least: list[float], depth: int) -> _Level:
        """The runs after counted contexts of so many words."""
        symbols, contexts = self.levels[0], self.levels[-1]
        frequent = (symbols.total >= least[0] / DEEPER)[symbols.number]
        at = np.flatnonzero((self.place >= depth) & frequent)
        of = contexts.number[at - 1]
        some = of >= 0
        some &= np.append(contexts.total >= least[depth - 1], False)[of]
        at, of = at[some], of[some]
        keys, one, which = _distinct(_follow(contexts.keys[of], symbols.keys[symbols.number[at]]))
        number = np.full(len(self.place), -1, dtype=np.int64)
        number[at] = which
        return _Level(keys, at[one], of[one], number)

    def sums(self, least: list[float], tokens: int, parts: int) -> pa.Table:
        """For every counted context held here, sums over the followers of which
        this batch stands for the run."""
        tables = []
        share = self.levels[0].total / max(tokens, 1)
        for depth, (contexts, runs) in enumerate(zip(self.levels, self.levels[1:], strict=False), 1):
            shorter, share = share, runs.total / contexts.total[runs.context]
            own = np.flatnonzero(runs.own)
            of, n = runs.context[own], runs.total[own]
            # the same run after the context without its first word
            expected = shorter[contexts.number[runs.at[own]]]
            counted = np.flatnonzero(contexts.total >= least[depth - 1])

            order = np.argsort(contexts.keys[counted])
            counted = counted[order]

            def summed(x, of=of, size=len(contexts.keys), counted=counted):
                return np.bincount(of, weights=x, minlength=size)[counted]

            rows = _by_part(
                self.id, contexts.keys[counted], parts, total_of=contexts.total[counted],
                kept=summed(np.ones(len(n))).astype(np.int64), seen=summed(n).astype(np.int64),
                expected=summed(expected).astype(float), gain=summed(n * np.log(share[own] / expected)).astype(float),
            )
            tables.append(rows.append_column("level", pa.array(np.full(rows.num_rows, depth, dtype=np.int64))))
        return pa.concat_tables(tables)

    def chances(self, given: pa.Table, least: list[float], tokens: int, unknown: float) -> np.ndarray:
        """Probability of every token."""
        symbols = self.levels[0]
        of_word = np.where(symbols.total > 0, symbols.total * ((1 - unknown) / tokens), 1 / (tokens + 2))
        chance = of_word[symbols.number]
        for depth, (contexts, runs) in enumerate(zip(self.levels, self.levels[1:], strict=False), 1):
            mine = given.filter(pa.array(given.column("level").to_numpy() == depth))
            mine = mine.filter(mine.column("rest").is_valid()).sort_by("part")
            counted = np.flatnonzero(contexts.total >= least[depth - 1])
            counted = counted[np.argsort(contexts.keys[counted])]
            rest = np.zeros(len(contexts.keys) + 1)  # with one place for no context
            rest[counted] = np.frombuffer(b"".join(x.as_py() for x in mine.column("rest")), dtype=float)
            mass = np.append(np.where(runs.total > 0, (runs.total - DISCOUNT) / contexts.total[runs.context], 0.0), 0.0)
            at = np.flatnonzero(self.place >= depth)
            left = rest[contexts.number[at - 1]]
            at, left = at[some := left > 0], left[some]
            chance[at] = left * chance[at] + mass[runs.number[at]]
        return chance


def score_texts(
    docs: DataFrame, scratch: Scratch, id: str = "doc_id", text: str = "text",
    depth: int = DEPTH, least: list[float] | None = None,
) -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score. ``least``:
    how often contexts of 1, 2, ... words occur at least, not falling; by default
    as the corpus suggests, for ``depth`` words."""
    narrow = docs.select(docs[id].alias("id"), docs[text].alias("text")).withColumn("held_out", held_out(F.col("id")))
    kind = narrow.schema["id"].dataType.simpleString()
    texts = scratch.save(_encoded(narrow, kind), free=True)
    parts = 1 + (texts.agg(F.sum("n_tokens")).first()[0] or 0) // PART_TOKENS

    def send_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                word = np.frombuffer(row["words"], dtype=np.uint64)
                order = np.argsort(word)
                trained = words.unpacked(row["trained"])[order]
                yield from _by_part(row["batch"], word[order], parts, counts=trained).to_batches()

    held = texts.filter("words IS NOT NULL").select("batch", "words", "trained")
    told = scratch.save(_totals(held.mapInArrow(send_words, SENT), 0, parts, 1), free=True)
    summed = told.agg(*(F.sum(c).alias(c) for c in ("tokens", "distinct", "single"))).first()
    tokens, distinct, single = (x or 0 for x in summed)
    unknown = (single + 1) / (tokens + 2)
    least = least or least_counts(tokens, depth)
    texts = texts.drop("n_tokens", "trained")
    told = told.select("batch", "level", "part", "found")

    def with_told(given: DataFrame, apply: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        return texts.groupBy("batch").cogroup(given.groupBy("batch")).applyInArrow(apply, schema)

    def send_runs(level: int, texts: pa.Table, given: pa.Table) -> pa.Table:
        batch = _Batch(texts, given, least, level, level - 1)
        runs = batch.levels[level]
        some = runs.number >= 0
        counts = np.bincount(runs.number[some], weights=batch.train[some], minlength=len(runs.keys))
        return _by_part(batch.id, runs.keys, parts, counts=counts.astype(np.int64))

    def runs_of(level: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
        return lambda texts, given: send_runs(level, texts, given)

    for level in range(1, len(least) + 1):
        totals = scratch.save(_totals(with_told(told, runs_of(level), SENT), level, parts, KEPT), free=True)
        told = told.unionByName(totals.select("batch", "level", "part", "found"))

    def send_sums(texts: pa.Table, given: pa.Table) -> pa.Table:
        return _Batch(texts, given, least, len(least), len(least)).sums(least, tokens, parts)

    rests = scratch.save(_retained(with_told(told, send_sums, SUMS), parts), free=True)

    def score(texts: pa.Table, given: pa.Table) -> pa.Table:
        batch = _Batch(texts, given, least, len(least), len(least))
        counts = batch.levels[0].total[batch.levels[0].number]
        base = np.log10((counts + 1) / (tokens + distinct + 1))
        scores = np.log10(batch.chances(given, least, tokens, unknown)) if tokens else np.zeros(len(counts))
        ends = batch.first[:-1]
        return pa.table(
            [
                batch.ids, batch.held_out, pa.array(np.diff(batch.first)),
                pa.array(np.add.reduceat((counts > 0).astype(np.int64), ends)),
                pa.array(np.full(len(ends), tokens, dtype=np.int64)),
                pa.array(np.add.reduceat(base, ends)), pa.array(np.add.reduceat(scores, ends)),
            ],
            ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    schema = f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    given = told.unionByName(rests, allowMissingColumns=True)
    return with_told(given, score, schema).withColumnRenamed("id", id)
