"""Personal data by patterns, and by contexts bootstrapped from what they find.

Base patterns find e-mail addresses, IP addresses, card and phone numbers. They
are the seeds of a graph of instances (normalised strings) and lexical patterns
(the word, and the two words, before an instance). Candidates for further
instances are tokens with a digit or an @, and runs of digit groups over single
blanks, brackets and signs, of any length and after any distance from the words
of their context; such a run is one candidate, even if it holds two numbers.

In each round a pattern's confidence in a kind is the share of its distinct
instances known to be of that kind. Instances of other kinds or of an impossible
form count against it, unknown ones of a possible form count as ``DOUBTFUL``, and
``PRIOR`` instances against it smooth patterns that are seldom seen. An unknown
instance's confidence is one minus the product of the doubts of the words it
follows, over all documents; of a word's patterns the surest counts. Instances
above ``ACCEPT`` whose form is possible for the kind become known, and so do their
occurrences after confident patterns, as further spans. Rounds go on until one
accepts nothing. Spans of base patterns always stay. Doubts are decimals, so that
reruns agree at the bound; of two kinds as sure, the first by name counts.

Positions are code points. They follow from the lengths of the text between
matches, summed up per document by a window over its matches, so long texts cost
no more than linear time; the patterns start at the bounds of runs and don't
backtrack over them. The graph holds counts per pattern and instance: a frequent
word is aggregated before it is shuffled, and only its pattern row stays.

Null and empty texts have no spans. Rows that repeat id and text are searched
once and reported each. An empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.sinks.storage import Scratch

KINDS = ("email", "ip", "card", "phone")
ACCEPT = 0.8
TRUSTED = 0.5  # a pattern's least confidence
DOUBTFUL = 0.25  # weight against a pattern of an unknown instance that may be of the kind
PRIOR = 1.0  # instances against any pattern

# a match may begin where a run of its characters does, or the last match ended
_FROM = r"(?:\G|(?<!{0})){0}++"
PATTERNS = {
    "email": _FROM.format("[A-Za-z0-9._%+-]") + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _FROM.format("[0-9]") + r"(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
# what can be an identifier at all: groups of digits, or a token with a digit or an @
_APART = r"\x20\x09-\x0D,;:\"'<>()\[\]{}|="
_GROUP = r"[0-9]++(?![\p{L}\p{N}@])"
GROUPS = rf"(?<![\p{{L}}\p{{N}}])[+(]{{0,2}}{_GROUP}(?:[\x20.()/\-]{{1,2}}{_GROUP})++"
TOKEN = rf"(?<![^{_APART}])[^{_APART}0-9@]*+[0-9@][^{_APART}]*[\p{{L}}\p{{N}}]"
CANDIDATE = f"(?:{GROUPS}|{TOKEN})"
# forms that are possible for a kind, if context says so
FORMS = {
    "email": r"^[^@]+@[^@]+$",
    "ip": r"^[0-9A-Fa-f]{1,4}(?:[.:][0-9A-Fa-f]{0,4}){3,7}$",
    "card": r"^(?:[0-9][\x20.\-]?){13,19}$",
    "phone": r"^[+(]{0,2}(?:[0-9][\x20().\-/]{0,2}){7,15}$",
}
_LAST = r"^[^\p{L}\p{N}]*+([\p{L}\p{N}]++)"  # of a reversed text
_LAST_BUT_ONE = r"^[^\p{L}\p{N}]*+[\p{L}\p{N}]++[^\p{L}\p{N}]++([\p{L}\p{N}]++)"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes; only asked of 14 to 19 of them."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d, k: F.when(k % 2 == 1, 2 * d.cast("int")).otherwise(d.cast("int")))
    folded = F.transform(values, lambda v: F.when(v > 9, v - 9).otherwise(v))
    return F.aggregate(folded, F.lit(0), lambda total, v: total + v) % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = _digits(match)
    count = F.length(digits)
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
        .when(kind == "card", F.when(count.between(14, 19), _luhn(digits)).otherwise(F.lit(False)))
        .otherwise(count.between(10, 15))
    )


def _found(text: Column, pattern: str, possible: Column) -> Column:
    """Matches with the text before each: an array, null if none is possible."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    return F.when(possible, F.arrays_zip(gaps.alias("gap"), matches.alias("match")))


def _last_words(text: Column, name: str) -> list[Column]:
    """The last word of a text and the one before it, lower-cased; null if there
    is none. Reading backward, no more is read than these two."""
    back = F.reverse(F.lower(text))
    return [
        F.nullif(F.reverse(F.regexp_extract(back, pattern, 1)), F.lit("")).alias(f"{name}_{k}")
        for k, pattern in enumerate((_LAST, _LAST_BUT_ONE), 1)
    ]


def _matches(docs: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """docs (id, text_hash, text) -> id, text_hash, kind, from, to, match, word,
    second (the last word before it and the one before that): a row for every
    match."""
    text = F.col("text")
    digit = text.rlike("[0-9]")
    possible = {"email": text.contains("@"), "phone": text.contains("+"), "candidate": F.lit(True)}
    kinds = [
        F.struct(F.lit(kind).alias("kind"), _found(text, pattern, possible.get(kind, digit)).alias("found"))
        for kind, pattern in patterns.items()
    ]
    rows = docs.select("id", "text_hash", F.explode(F.array(*kinds)).alias("k"))
    rows = rows.select("id", "text_hash", "k.kind", F.posexplode("k.found").alias("at", "m"))
    rows = rows.select(
        "id", "text_hash", "kind", "at", F.col("m.match").alias("match"), F.length("m.gap").alias("gap"),
        *_last_words(F.col("m.gap"), "gap"), *_last_words(F.col("m.match"), "match"),
    ).filter("match IS NOT NULL")
    in_text = Window.partitionBy("id", "text_hash", "kind").orderBy("at")
    ends = F.sum(F.col("gap") + F.length("match")).over(in_text.rowsBetween(Window.unboundedPreceding, 0))
    # where the gap has fewer than two words, they are those of the matches and the gap before
    before = [F.lag(name).over(in_text) for name in ("match_1", "match_2", "gap_1")] + [F.lag("match_1", 2).over(in_text)]
    second = F.when(F.col("gap_1").isNull(), F.coalesce(*before[1:])).otherwise(F.coalesce("gap_2", before[0]))
    placed = rows.select("*", ends.cast("bigint").alias("to"), F.coalesce("gap_1", before[0]).alias("word"), second.alias("second"))
    return placed.select(
        "id", "text_hash", "kind", (F.col("to") - F.length("match")).alias("from"), "to", "match", "word", "second"
    )


def _with_patterns(rows: DataFrame) -> DataFrame:
    """A row for each of a match's patterns; none if no word stands before it."""
    both = F.array(F.col("word"), F.concat(F.col("second"), F.lit(" "), F.col("word")))
    return rows.filter("word IS NOT NULL").withColumn("pattern", F.explode(F.array_compact(both)))


def _uncovered(tokens: DataFrame, base: DataFrame) -> DataFrame:
    """The tokens that touch no base span, by running bounds per document."""
    both = tokens.withColumn("is_base", F.lit(False)).unionByName(
        base.withColumn("is_base", F.lit(True))
    )
    in_text = Window.partitionBy("id", "text_hash").orderBy("from", F.col("is_base").desc(), "to")
    before = in_text.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    backward = Window.partitionBy("id", "text_hash").orderBy(F.col("from").desc(), F.col("is_base").asc(), F.col("to").desc())
    after = backward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = both.withColumns(
        {
            "reached": F.max(F.when(F.col("is_base"), F.col("to"))).over(before),
            "next": F.min(F.when(F.col("is_base"), F.col("from"))).over(after),
        }
    )
    free = (F.coalesce("reached", F.lit(0)) <= F.col("from")) & (F.coalesce("next", F.col("to")) >= F.col("to"))
    return marked.filter(~F.col("is_base") & free).drop("is_base", "reached", "next")


def _confidence(kind: str) -> Column:
    """Of a pattern in a kind, over its distinct instances."""
    known, possible = F.col("kind"), F.array_contains("forms", kind)
    against = known.isNotNull() & (known != kind) | known.isNull() & ~possible
    for_it = F.count_if(known == kind)
    return for_it / (for_it + F.count_if(against) + DOUBTFUL * F.count_if(known.isNull() & possible) + PRIOR)


def _trusted(known: DataFrame) -> DataFrame:
    """pattern, kind, doubt: the kind that a pattern announces, if it does."""
    sure = known.groupBy("pattern").agg(*[_confidence(kind).alias(kind) for kind in KINDS])
    best = F.array_max(F.array(*[F.struct(F.col(k).alias("confidence"), F.lit(k).alias("kind")) for k in KINDS]))
    sure = sure.select("pattern", best.alias("best")).filter(F.col("best.confidence") >= TRUSTED)
    doubt = F.log(F.greatest(1 - F.col("best.confidence"), F.lit(1e-6)))
    return sure.select("pattern", F.col("best.kind").alias("kind"), doubt.cast("decimal(10,6)").alias("doubt"))


def _bootstrap(base: DataFrame, candidates: DataFrame, scratch: Scratch) -> DataFrame:
    """Further spans: id, text_hash, kind, from, to."""
    instance = F.lower("match").alias("instance")
    edges = _with_patterns(base).select("kind", "word", "pattern", instance)
    unknown = _with_patterns(candidates).select(F.lit(None).cast("string").alias("kind"), "word", "pattern", instance)
    graph = edges.unionByName(unknown).groupBy("word", "pattern", "instance").agg(F.min("kind").alias("kind"))
    forms = F.array_compact(F.array(*[F.when(F.col("instance").rlike(form), F.lit(kind)) for kind, form in FORMS.items()]))
    graph = scratch.save(graph.withColumn("forms", forms))
    accepted = scratch.save(graph.select("instance", "kind").limit(0))
    bound = F.lit(math.log(1 - ACCEPT) + 1e-6).cast("decimal(10,6)")
    while True:
        new = accepted.select("instance", F.col("kind").alias("new"))
        known = graph.join(new, "instance", "left").withColumn("kind", F.coalesce("kind", "new")).drop("new")
        trusted = scratch.save(_trusted(known))
        doubts = (
            known.filter("kind IS NULL").drop("kind").join(trusted, "pattern")
            .filter("array_contains(forms, kind)")
            .groupBy("instance", "kind", "word").agg(F.min("doubt").alias("doubt"))
            .groupBy("instance", "kind").agg(F.sum("doubt").alias("doubt"))
            .filter(F.col("doubt") <= bound)
        )
        found = doubts.groupBy("instance").agg(F.min_by("kind", F.struct("doubt", "kind")).alias("kind"))
        found = scratch.save(found)
        if found.isEmpty():
            break
        more = scratch.save(accepted.unionByName(found))
        scratch.drop(accepted, found, trusted)
        accepted = more
    named = candidates.drop("kind").withColumn("instance", F.lower("match")).join(accepted, "instance")
    named = _with_patterns(named).join(trusted.select("pattern", "kind"), ["pattern", "kind"], "left_semi")
    return named.select("id", "text_hash", "kind", "from", "to").distinct()


def _count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(F.array(*map(F.lit, KINDS)), s["kind"]), s["from"], s["to"])), ","
    )


def personal_data(docs: DataFrame, scratch: Scratch, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added: one row
    per document."""
    docs = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    marked = docs.filter("text RLIKE '[0-9@]'")
    marked = scratch.save(marked.dropDuplicates(["id", "text_hash"]))
    # few bytes, but much work each: dealt over all tasks, and so that the windows need no exchange
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = _matches(marked.repartition(tasks, "id", "text_hash"), PATTERNS | {"candidate": CANDIDATE})
    found = scratch.save(found.filter((F.col("kind") == "candidate") | _valid(F.col("kind"), F.col("match"))))
    base = found.filter("kind != 'candidate'")
    candidates = scratch.save(_uncovered(found.filter("kind = 'candidate'"), base))
    further = _bootstrap(base, candidates, scratch)
    spans = base.select("id", "text_hash", "kind", "from", "to", F.lit(True).alias("is_base")).unionByName(
        further.withColumn("is_base", F.lit(False))
    )
    number = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    span = F.struct("from", number.alias("kind"), "to", "is_base")
    listed = spans.groupBy("id", "text_hash").agg(F.array_sort(F.collect_list(span)).alias("all"))
    listed = listed.withColumn("base", F.filter("all", lambda s: s["is_base"]))
    listed = listed.select(
        F.col("id").alias("of"), F.col("text_hash").alias("of_hash"),
        *[_count(F.col("base"), k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        _joined(F.col("base")).alias("base"), _joined(F.col("all")).alias("spans"),
        (F.size("all") - F.size("base")).cast("bigint").alias("n_added"),
    )
    listed = scratch.save(listed)
    scratch.drop(marked, found, candidates)
    same = docs["id"].eqNullSafe(listed["of"]) & (docs["text_hash"] == listed["of_hash"])
    joined = docs.select("id", "text_hash").join(listed, same, "left")
    return joined.select(
        F.col("id").alias(id),
        *[F.coalesce(f"n_{kind}", F.lit(0)).cast("bigint").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("n_added", F.lit(0)).cast("bigint").alias("n_added"),
    )
