"""Quality rules of documents, and of the hosts they come from.

Every document is measured and judged by base rules. Their failures are summed
up by host (here the source), each host's failure rate is shrunk towards the
others' by a beta prior fitted to all hosts by its moments, and a host whose
shrunk rate is above ``max_rate`` takes its remaining documents with it.

A null text has no words and fails. Documents of a null host form a host of
their own. Repeated rows are judged one by one and all count for their host. An
empty table gives an empty result. Work and memory per row are linear in its
text up to the sorting of its repeated windows; other columns pass unchanged,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.columns import fresh, let, words_of
from fleetscope.sinks.storage import Scratch

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # percent
MAX_RATE = 0.5
SYMBOLS = "#*$%&|<>"
BROADCAST_HOSTS = 10_000


def _covered(starts: Column) -> Column:
    """Words under the windows that start at these sorted places."""
    widths = F.transform(
        starts, lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - at, F.lit(WINDOW)))
    )
    return F.aggregate(widths, F.lit(0), lambda total, width: total + width)


def _repeated(windows: Column) -> Column:
    """Words under the windows whose hash occurs more than once."""
    placed = F.array_sort(
        F.transform(windows, lambda hash, at: F.struct(hash.alias("hash"), at.alias("at")))
    )

    def starts(sorted_windows: Column) -> Column:
        again = F.filter(
            sorted_windows,
            lambda w, k: F.coalesce(w["hash"] == F.get(sorted_windows, k - 1)["hash"], F.lit(False))
            | F.coalesce(w["hash"] == F.get(sorted_windows, k + 1)["hash"], F.lit(False)),
        )
        return F.array_sort(F.transform(again, lambda w: w["at"]))

    some = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(some, let(let(placed, starts), _covered)).otherwise(F.lit(0))


def _windows(hashes: Column) -> Column:
    places = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
    return F.transform(places, lambda at: F.xxhash64(*[F.get(hashes, at + k) for k in range(WINDOW)]))


def _repeat_words(words: Column) -> Column:
    hashes = F.transform(words, lambda word: F.xxhash64(word))
    repeated = let(hashes, lambda h: let(_windows(h), _repeated))
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(repeated).cast("bigint")


def measures(text: Column) -> Column:
    """The base measures of a text, as one struct."""

    def of(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("bigint"), lambda n, word: n + F.length(word)).alias("word_chars"),
            _repeat_words(words).alias("n_repeat_words"),
        )

    text = F.coalesce(text, F.lit(""))
    counted = let(words_of(text), of)
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return let(
        counted,
        lambda c: F.struct(
            c["n_words"].alias("n_words"),
            c["word_chars"].alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            c["n_repeat_words"].alias("n_repeat_words"),
        ),
    )


def base_failed(measured: Column) -> Column:
    return (measured["n_words"] < MIN_WORDS) | (
        100 * measured["n_repeat_words"] > MAX_REPEATED * measured["n_words"]
    )


def fails(text: Column) -> Column:
    """Whether a text fails the base rules, by the two measures they need."""

    def of(words: Column) -> Column:
        return F.struct(F.size(words).cast("bigint").alias("n_words"), _repeat_words(words).alias("n_repeat_words"))

    return let(let(words_of(F.coalesce(text, F.lit(""))), of), base_failed)


def rejected_hosts(measured: DataFrame, host: str, failed: str, max_rate: float = MAX_RATE) -> DataFrame:
    """One row per host whose shrunk failure rate is too high."""
    hosts = measured.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(failed)).alias("failures")
    )
    rate = F.col("failures") / F.col("n")
    moments = hosts.agg(F.avg(rate).alias("mean"), F.var_samp(rate).alias("variance")).first()
    mean, variance = moments["mean"] or 0.0, moments["variance"] or 0.0
    # the size of the prior, in documents; hosts that don't differ shrink fully
    prior = mean * (1 - mean) / variance - 1 if variance > 0 else 0.0
    prior = max(prior, 0.0)
    if variance == 0:
        return hosts.filter(F.lit(mean > max_rate)).select("host")
    shrunk = (F.col("failures") + F.lit(mean * prior)) / (F.col("n") + F.lit(prior))
    return hosts.filter(shrunk > max_rate).select("host")


def judge(measured: DataFrame, scratch: Scratch, host: str, failed: str, kept: str) -> DataFrame:
    """Adds the verdict: neither the document failed nor its host."""
    rejected = scratch.save(rejected_hosts(measured, host, failed))
    if rejected.count() <= BROADCAST_HOSTS:
        rejected = F.broadcast(rejected)
    (mark,) = fresh(measured, "host_rejected")
    rejected = rejected.select(F.col("host"), F.lit(True).alias(mark))
    (other,) = fresh(measured, "rejected_host")
    rejected = rejected.withColumnRenamed("host", other)
    joined = measured.join(rejected, measured[host].eqNullSafe(rejected[other]), "left")
    verdict = ~F.col(failed) & F.col(mark).isNull()
    return joined.withColumn(kept, verdict).drop(mark, other)


def quality_report(docs: DataFrame, scratch: Scratch, id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """id, the measures, base_failed, kept: one row per document."""
    measured = docs.select(
        docs[id].alias(id), docs[host].alias("host"), measures(docs[text]).alias("measured")
    ).select(id, "host", "measured.*", base_failed(F.col("measured")).alias("base_failed"))
    measured = scratch.save(measured)
    return judge(measured, scratch, "host", "base_failed", "kept").drop("host")


def keep_good(docs: DataFrame, scratch: Scratch, text: str = "text", host: str = "source") -> DataFrame:
    """The documents that pass, with their columns. They are measured twice, for
    their hosts and for themselves: stored verdicts would need a copy of all texts."""
    failed, kept = fresh(docs, "base_failed", "kept")
    judged = judge(docs.withColumn(failed, fails(docs[text])), scratch, host, failed, kept)
    return judged.filter(F.col(kept)).select(*[F.col(f"`{c}`") for c in docs.columns])
