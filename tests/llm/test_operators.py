"""Operators against plain Python, over a whole small table and over odd rows."""

import collections
import hashlib
import math
import random
import re
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from fleetscope.llm import (
    decontamination, host_rules, line_dedup, mixing, ngram_join, pii, queries, stages, substring_dedup,
    suffix_model, token_counts, toxicity,
)
from fleetscope.llm import words as words_of_texts
from fleetscope.sinks.storage import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
LONG = " ".join(f"w{k}" for k in range(3000))
ODD = [
    (1, None, "a", 0),
    (2, "", None, 1),
    (3, " \t\n", "a", 2),
    (4, "one two three", "b", 3),
    (4, "one two three", "b", 3),  # a repeated row
    (None, "no id here, just a few words to read in one line", "c", 4),
    (5, LONG, "a", 5),
    (6, LONG + " more", None, 6),
    (7, "call +1 (234) 555-1234 or a.b@c.de, 4111 1111 1111 1111 at 10.0.0.255", "c", 7),
    (8, "the same line of ten words stands here once more\nthe same line of ten words stands here once again", "b", 8),
]
# columns that operators might use themselves
SCHEMA = "doc_id long, text string, source string, n_words long"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(*row, 1, "x") for row in ODD]
    return spark.createDataFrame(rows, SCHEMA + ", size int, kept string").coalesce(2)


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


def texts(spark, folder):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]


def words(text, lower=False):
    return WORD.findall((text or "").translate(LOWER) if lower else (text or ""))


def shingles(text):
    w = words(text, lower=True)
    return frozenset(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()


def test_token_counts_are_the_library_s(spark, odd, small):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    strange = ["<|endoftext|>", "don't''re 'RE x's", "a" * 500, " \n\n x\t\ty  ", "é漢字\U0001f600 ٣½", "'r", None]
    rows = texts(spark, small) + [(10_000 + k, t) for k, t in enumerate(strange)] + [(20_000 + k, r[1]) for k, r in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for row in token_counts.token_counts(docs, path).join(docs.distinct(), "doc_id").collect():
        wanted = len(library.encode(row["text"] or "", add_special_tokens=False).ids)
        assert (row["n_tokens"], row["n_bytes"]) == (wanted, len((row["text"] or "").encode()))
        assert row["over_limit"] == (wanted > 1024)


def test_components_are_those_of_all_pairs(spark, small, scratch):
    rows = texts(spark, small)
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    for row in queries.op9_ngram_jaccard_join(spark, small).collect():
        assert row["n_shingles"] == len(sets[row["doc_id"]])
        assert row["component_id"] == root(row["doc_id"])


def test_components_of_a_template_family_are_those_of_all_pairs(spark, scratch, monkeypatch):
    import random

    # all in one group, so that no other group makes up for a pair it leaves out
    keys = ngram_join._keys
    monkeypatch.setattr(ngram_join, "_keys", lambda *args: keys(*args).select(F.lit(1).cast("long").alias("key"), "node").distinct())
    chance = random.Random(5)
    base = [f"t{k}" for k in range(60)]
    rows = []
    for i in range(240):
        w = list(base)
        for k in chance.sample(range(0, 60, 4), chance.choice((2, 3, 4, 5))):
            w[k] = f"e{k}"  # an edit that other members may have as well
        rows.append((i, " ".join(w)))
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    assert len(set(label)) > 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in ngram_join.component_ids(docs, scratch).collect()}
    assert found == dict(enumerate(label))


def test_a_chunked_group_gives_the_components_of_all_pairs(spark, scratch, monkeypatch):
    monkeypatch.setattr(ngram_join, "_CHUNK_ROWS", 25)
    test_components_of_a_template_family_are_those_of_all_pairs(spark, scratch, monkeypatch)


def test_distances_of_sketches_never_exceed_those_of_sets():
    import numpy as np

    random = np.random.default_rng(3)
    for size in (1, 2, 31, 32, 33, 500, 3000):
        for extra in (0, 1, size // 5, size):
            a = np.unique(random.integers(0, 1 << 63, size, dtype=np.uint64))
            b = np.unique(np.append(a[extra // 2 :], random.integers(0, 1 << 63, extra, dtype=np.uint64)))
            apart = len(np.setxor1d(a, b))
            found = ngram_join.sketch_distance(ngram_join.parity_sketch(a), ngram_join.parity_sketch(b))
            assert found <= apart and (found - apart) % 2 == 0


def test_blocks_of_similar_sets_meet():
    import numpy as np

    random = np.random.default_rng(7)
    for size in (5, 6, 9, 12, 20, 50, 200, 1000):
        for _ in range(20):
            base = random.integers(0, 1 << 63, size, dtype=np.uint64)
            apart = size // 9  # similarity of at least 0.8
            other = np.append(base[apart:], random.integers(0, 1 << 63, apart, dtype=np.uint64))
            keys = [set(ngram_join.block_keys(np.unique(s)).tolist()) for s in (base, other)]
            assert keys[0] & keys[1] or set(base) == set(other)


def test_spans_that_earlier_documents_have_go(spark, small):
    rows = sorted(texts(spark, small))
    first, wanted = {}, {}
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if first.setdefault(tuple(w[k : k + 50]), i) < i:
                gone[k : k + 50] = [True] * 50
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        wanted[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    found = queries.op6_substring_dedup(spark, small).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found} == wanted


def test_near_lines_by_all_variants(spark, small, scratch):
    rows = sorted(texts(spark, small))
    first = {}
    for i, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            if len(w := tuple(words(line))) >= 5:
                first.setdefault(w, (i, k))
    near, seen = set(), set()
    for w in sorted(first, key=first.get):
        if len(w) < 10:
            continue
        less = [w[:k] + w[k + 1 :] for k in range(len(w))]
        keys = {(0, k, x) for k, x in enumerate(less)}
        if keys & seen or {(1, x) for x in less} & seen or (2, w) in seen:
            near.add(w)
        seen |= keys | {(1, w)} | {(2, x) for x in less}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cut, _, lost = line_dedup.without_repeated_lines(docs, scratch)
    wanted = {}
    for i, text in rows:
        lines = [(tuple(words(x)), (i, k), x) for k, x in enumerate((text or "").split("\n"))]
        wanted[i] = "\n".join(x for w, at, x in lines if len(w) < 5 or (first[w] == at and w not in near))
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == wanted


def test_the_query_and_the_stage_drop_short_lines_as_well(spark, tmp_path):
    rows = [
        (1, "All rights reserved.\none two three four five\n\nshort one"),
        (2, "All rights reserved.\none two three four six\n\nshort two\none two four"),
        (3, "two three four five\none two three four five six\nshort  one\none two three four"),
        (4, "one two three four five six seven eight nine\n1 2 3 4 5 6 7"),
        (5, "one two three four five six seven nine\n1 2 3 X 5 6 7\n1 2 X 4 5 X 7"),
    ]
    wanted = {1: rows[0][1], 2: "\nshort two\none two four", 3: "two three four five\none two three four", 4: rows[3][1], 5: "1 2 X 4 5 X 7"}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert dict(stages.line_dedup(spark, docs, str(tmp_path)).collect()) == wanted
    for row in queries.op7_line_dedup(spark, str(tmp_path)).collect():
        assert row["kept_sha256"] == hashlib.sha256(wanted[row["doc_id"]].encode()).hexdigest()


def test_variants_leave_out_only_words_where_the_edit_can_be(spark, scratch):
    shared = [f"w{k}" for k in range(30)]
    lines = [shared, [*shared[:29], "x"], ["y", *shared[1:]], [*shared[:15], "z", *shared[15:]], ["alone"] * 30]
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines)], "doc_id long, text string")
    table = line_dedup._line_table(docs, "doc_id", "text", 1, 5)
    firsts = table.select("h1", "h2", "parts", F.struct("late", "id", "text_hash", "at").alias("first"))
    active = line_dedup._active(firsts)
    found = firsts.join(active, "h1").join(docs, F.col("first.id") == docs["doc_id"])
    found = found.select(F.col("first").alias("place"), "h1", "h2", *line_dedup._SHARES, F.split("text", " ").alias("words"))
    counts = line_dedup._variants(found).groupBy("place.id").count().collect()
    # each edited line shares one part: the whole, and two variants for each word of a third
    assert {i: n for i, n in counts if i in (1, 2, 3)} == pytest.approx({1: 21, 2: 21, 3: 21}, abs=4)
    assert 4 not in dict(counts)


@pytest.mark.parametrize("seed", range(3))
def test_near_lines_of_odd_blanks_by_brute_force(spark, scratch, seed):
    rng = random.Random(seed)
    blanks = [" ", "  ", "\t", " \r", "\x0b\f ", "   "]
    rows, lines = [], [[rng.choice("abcd") for _ in range(rng.randint(1, 14))] for _ in range(25)]
    for i in range(60):
        text = []
        for _ in range(rng.randint(0, 4)):
            w = list(rng.choice(lines))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at, kind = rng.randrange(len(w) + 1), rng.randrange(3)
                w[at : at + (kind > 0)] = [rng.choice("abcdX\u00a0")] if kind < 2 else []
            text.append("".join(x + rng.choice(blanks) for x in ["", *w]) if rng.random() < 0.5 else " ".join(w))
        rows.append((i, rng.choice([None, ""]) if not text else "\n".join(text)))

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
        long, short = (a, b) if len(a) > len(b) else (b, a)
        return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))

    seen, wanted, n_near = [], {}, 0
    for i, text in rows:
        kept = []
        for line in (text or "").split("\n"):
            w = tuple(words(line))
            close = [x for x in seen if x != w and min(len(x), len(w)) >= 5 and near(x, w)]
            n_near += bool(close) and w not in seen
            if not w or (w not in seen and not close):
                kept.append(line)
            if w:
                seen.append(w)
        wanted[i] = None if text is None else "\n".join(kept)
    assert n_near > 10
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cut, _, _ = line_dedup.without_repeated_lines(docs, scratch, least=1, near=5)
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == wanted


def test_base_rules_by_definition(spark, small):
    for row in queries.op4_quality_rules(spark, small).join(
        spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text"), "doc_id"
    ).collect():
        w = words(row["text"])
        at = collections.defaultdict(list)
        for k in range(len(w) - 7):
            at[tuple(w[k : k + 8])].append(k)
        repeated = {k + j for places in at.values() if len(places) > 1 for k in places for j in range(8)}
        lines = [x for x in (row["text"] or "").split("\n") if words(x)]
        assert row["n_words"] == len(w) and row["word_chars"] == sum(map(len, w))
        assert row["n_symbols"] == sum(c in "#*$%&|<>" for c in row["text"] or "")
        assert row["n_dup_lines"] == len(lines) - len(set(lines))
        assert row["n_repeat_words"] == len(repeated)
        assert row["base_failed"] == (len(w) < 20 or 100 * len(repeated) > 30 * len(w))
        assert row["kept"] == (not row["base_failed"])


def test_a_failing_host_goes_whole(spark, scratch):
    good, bad = " ".join(f"x{k}" for k in range(30)), "short"
    rows = [(k, good, "fine") for k in range(50)] + [(100 + k, good if k < 5 else bad, "poor") for k in range(50)]
    rows += [(200 + k, good, f"host{k % 5}") for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = host_rules.quality_report(docs, scratch).filter("kept").collect()
    assert {r["doc_id"] for r in kept} == {i for i, _, s in rows if s != "poor"}


def test_mix_comes_near_its_targets(spark, small, scratch):
    rows = queries.op2_source_mixing(spark, small).collect()
    again = queries.op2_source_mixing(spark, small).collect()
    assert sorted(rows) == sorted(again)
    sources = dict(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "source").collect())
    taken, of, largest = collections.Counter(), {}, collections.Counter()
    for r in rows:
        largest[sources[r["doc_id"]]] = max(largest[sources[r["doc_id"]]], r["size"])
        of[sources[r["doc_id"]]] = r
        taken[sources[r["doc_id"]]] += r["taken"]
        assert r["taken"] <= 3 * r["size"] and r["taken"] == r["size"] * len(r["shards"])
    total = sum(r["source_size"] for r in of.values())
    assert math.isclose(sum(r["target"] for r in of.values()), total)
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(of))}
    free = [r["target"] / weights[s] for s, r in of.items() if r["target"] < 3 * r["source_size"]]
    assert max(free) - min(free) < 1e-6 * max(free)
    for s, r in of.items():
        # the first document that doesn't fit may close the gap: half of it remains at most
        assert abs(taken[s] - r["target"]) <= largest[s] / 2


def test_benchmark_passages_are_found_whatever_their_numbers(spark, scratch):
    item = "Alice bought 12 apples for 30 cents each and then she sold half of them to Bob at the market"
    other = item.replace("12", "77").replace("30", "45").replace("Alice", "Carol")
    mixed_up = "Alice bought 12 apples for 30 cents each. Nothing else here is like the item at all, not one bit"
    docs = spark.createDataFrame(
        [(1, f"before {item} after"), (2, f"see: {other}!"), (3, "nothing in common"), (4, None), (5, mixed_up), (6, item.upper())],
        "doc_id long, text string",
    )
    benchmark = spark.createDataFrame([(0, item), (1, None), (2, "")], "item_id long, text string")
    found = {r["doc_id"]: r for r in decontamination.contaminated(docs, benchmark, scratch).collect()}
    assert {1, 2, 6} <= set(found) and not {3, 4} & set(found)
    assert found[2]["reworded"] and found[2]["n_refilled"] >= 2


def test_every_version_of_a_benchmark_passage_counts_alone(spark, scratch):
    item = "Alice bought 3 big red apples for her 5 small children and then Alice gave 3 red apples back to Bob the old grocer"
    version = lambda name, n, other: (
        item.replace("Alice", name).replace("3", n).replace("5", other).replace("Bob", "Ed")
    )
    carol = version("Carol", "77", "45")
    rows = [
        (1, f"{carol}. {version('Carol', '80', '46')}"),
        (2, f"{carol} {'and so on ' * 30} {version('Dora', '80', '46')}"),
        (3, f"Question: {carol}"),
        (4, version("Alice", "4", "4")),
        (5, carol.replace("then", "then, later,") + " " + version("Dora", "80", "46").replace("then", "then, later,")),
        (6, "Alice bought 3 big red apples"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(0, item)], "item_id long, text string")
    found = decontamination.contaminated(docs, benchmark, scratch).collect()
    assert {r["doc_id"]: r["n_exact"] for r in found} == dict.fromkeys((1, 2, 3, 4, 5), 0)


def test_names_end_at_punctuation():
    import pyarrow as pa

    shapes = [decontamination.Template(pa.array([t])).shape.tolist() for t in ("Question: Carol ran", "Carol Jones ran", "Dr. Jones ran")]
    assert [len(x) for x in shapes] == [3, 2, 2]


def test_base_spans_by_definition(spark, odd, scratch):
    rows = {r["doc_id"]: r for r in pii.personal_data(odd, scratch).collect()}
    text = ODD[8][1]
    wanted = [("phone", "+1 (234) 555-1234"), ("email", "a.b@c.de"), ("card", "4111 1111 1111 1111"), ("ip", "10.0.0.255")]
    spans = ",".join(f"{kind}:{text.index(x)}:{text.index(x) + len(x)}" for kind, x in wanted)
    assert rows[7]["spans"] == spans
    assert rows[7]["base_sha256"] == hashlib.sha256(spans.encode()).hexdigest()
    assert rows[1]["spans"] == "" and rows[1]["base_sha256"] == hashlib.sha256(b"").hexdigest()


def test_contexts_discover_unseen_identifiers(spark, scratch):
    rows = [(k, f"please dial number +1 234 555 {1000 + k} now") for k in range(30)]
    rows.append((99, "please dial number 2345559876 now"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    row = pii.personal_data(docs, scratch).filter("doc_id = 99").first()
    assert row["n_phone"] == 0 and row["spans"] == "phone:19:29" and row["n_added"] == 1


def spans_by_definition(text):
    """Base spans (kind, from, to): leftmost matches of the contract's patterns."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def luhn(digits):
        doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
        return sum(v - 9 if v > 9 else v for v in doubled) % 10 == 0

    found = []
    for order, (kind, pattern) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            passes = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(part) <= 255 for part in m.group().split(".")),
                "card": lambda digits=digits: 14 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda digits=digits: 10 <= len(digits) <= 15,
            }
            if passes[kind]():
                found.append((m.start(), order, kind, m.end()))
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found))


def test_base_spans_of_all_documents(spark, medium, scratch):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    wanted = {i: spans_by_definition(text) for i, text in texts(spark, medium)}
    found = pii.personal_data(docs, scratch).collect()
    assert {r["doc_id"]: r["base_sha256"] for r in found} == {i: hashlib.sha256(x.encode()).hexdigest() for i, x in wanted.items()}
    assert sum(map(bool, wanted.values())) > 30


def test_numbers_in_groups_are_discovered(spark, scratch):
    rows = [(k, f"please dial number +1 234 555 {1000 + k} now") for k in range(30)]
    numbers = ["(555) 123-4567", "030 123 45 67", "030/1234567", "555.123.4567"]
    rows += [(100 + k, f"please dial number{' ' * 200}{x}, now") for k, x in enumerate(numbers)]
    rows.append((200, "at 7 dial number 5551234567."))  # the words before reach over another number
    rows += [(300, "page number 12 of 030 123 45 68"), (301, "number 5"), (302, "a" * 3000 + " 030 123 45 69")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.personal_data(docs, scratch).collect()}
    for k, x in enumerate(numbers):
        assert found[100 + k]["spans"] == f"phone:218:{218 + len(x)}" and found[100 + k]["n_added"] == 1
    assert found[200]["spans"] == "phone:17:27"
    assert all(found[k]["n_added"] == 0 for k in (*range(30), 300, 301, 302))


def test_chained_contexts_are_followed_to_their_end(spark, scratch):
    """Every link of the chain is known by the numbers of the one before only."""
    contexts = ["dial extension", "fax line", "pager code", "desk contact", "night bell"]
    rows = [f"to dial extension +1 234 555 {1000 + k} please" for k in range(60)]
    wanted = set()
    for link, (one, next_one) in enumerate(zip(contexts, contexts[1:], strict=False)):
        for k in range(36 - 8 * link):
            number = f"{link + 2}34555{1000 + k}"
            rows += [f"to {one} {number} please", f"to {next_one} {number} please"]
            wanted.add(number)
    rows += [f"to invoice total {7000000 + k} please" for k in range(50)]  # as long, but of no trusted context
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = set()
    for r in pii.personal_data(docs, scratch).filter("n_added > 0").collect():
        _, start, end = r["spans"].split(":")
        found.add(rows[r["doc_id"]][int(start) : int(end)])
    assert found == wanted


def test_personal_data_of_an_empty_table(spark, odd, scratch):
    assert pii.personal_data(odd.limit(0), scratch).count() == 0


class PlainTree:
    """The suffix tree in plain Python, from the docstring of the module."""

    def __init__(self, trained, least):
        self.n = collections.Counter()
        for tokens in trained:
            for k in range(len(tokens)):
                for size in range(1, min(k + 1, len(least) + 1) + 1):
                    self.n[tuple(tokens[k - size + 1 : k + 1])] += 1
        self.root = {run[0]: n for run, n in self.n.items() if len(run) == 1}
        self.tokens = sum(self.root.values())
        self.single = sum(n == 1 for n in self.root.values()) + 1
        self.unknown = self.single / (self.tokens + 2)
        self.kept, self.rest = collections.defaultdict(dict), {}
        for run, n in self.n.items():
            context = run[:-1]
            if context and n >= suffix_model.KEPT and self.n[context] >= least[len(context) - 1]:
                if self.root[run[-1]] >= least[0] / suffix_model.DEEPER:
                    self.kept[context][run[-1]] = n
        for context, kept in list(self.kept.items()):
            total, short = self.n[context], context[1:]
            of = self.n[short] if short else self.tokens
            expected = {w: self.n[(*short, w)] / of for w in kept}
            gain = sum(n * math.log(n / total / expected[w]) for w, n in kept.items())
            other = total - sum(kept.values())
            if other:
                gain += other * math.log(other / (max(1 - sum(expected.values()), 1e-9) * total))
            if 2 * gain > len(kept) + suffix_model.DIVERGENCE * math.sqrt(2 * len(kept)):
                self.rest[context] = (other + suffix_model.DISCOUNT * len(kept)) / total

    def chance(self, past, word):
        p = self.root[word] * (1 - self.unknown) / self.tokens if word in self.root else 1 / (self.tokens + 2)
        for size in range(1, len(past) + 1):
            context = tuple(past[len(past) - size :])
            if context in self.rest:
                n = self.kept[context].get(word)
                p = self.rest[context] * p + ((n - suffix_model.DISCOUNT) / self.n[context] if n else 0)
        return p


def symbols_of(spark, folder):
    tokens = {i: [*words(t, lower=True), None] for i, t in texts(spark, folder)}
    return tokens, [t for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2]


@pytest.mark.parametrize("least", [[8.0, 12.0, 12.0], None])
def test_scores_of_the_tree_by_definition(spark, medium, scratch, least):
    tokens, trained = symbols_of(spark, medium)
    bounds = least or suffix_model.least_counts(sum(map(len, trained)), suffix_model.DEPTH)
    tree = PlainTree(trained, bounds)
    depths = collections.Counter(map(len, tree.rest))
    assert all(depths[k] for k in range(1, len(bounds) + 1))
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    for r in suffix_model.score_texts(docs, scratch, least=least).collect():
        own = tokens[r["doc_id"]]
        wanted = sum(math.log10(tree.chance(own[max(0, k - len(bounds)) : k], w)) for k, w in enumerate(own))
        assert r["score"] == pytest.approx(wanted, rel=1e-9)


def test_the_tree_grows_and_its_states_sum_up_to_one(spark, small, medium):
    sizes = []
    for folder in (small, medium):
        _, trained = symbols_of(spark, folder)
        tree = PlainTree(trained, suffix_model.least_counts(sum(map(len, trained)), suffix_model.DEPTH))
        sizes.append(len(tree.rest))
        for context in [(), *sorted(tree.rest, key=tree.n.get)[-3:]]:
            known = sum(tree.chance(context, w) for w in tree.root)
            assert known + tree.single * tree.chance(context, "\n") == pytest.approx(1)
    assert sizes[1] > 2 * sizes[0] > 0


def test_contexts_are_counted_alike_in_a_corpus_of_any_size(spark, scratch):
    assert suffix_model.least_counts(1_000, 2) == suffix_model.least_counts(10**12, 2) == [suffix_model.LEAST] * 2
    kept = [f"{a} then {b}" for a, b in [("red", "one"), ("blue", "two")] for _ in range(60)]
    scores = []
    for more in (0, 4_000):
        rows = [*kept, *[f"f{k % 50} g{k * 7 % 90} h{k * 11 % 70} i j k l m" for k in range(more)]]
        docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
        scored = {r["doc_id"]: r["score"] - r["base_score"] for r in suffix_model.score_texts(docs, scratch).collect()}
        scores.append(scored[0])
    # what stands after "then" depends on the word before: known with other texts as well
    assert scores[0] > 1 and scores[1] > 3


def test_scores_leave_little_on_the_disk(spark, medium):
    local = [f.getPath() for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def shuffled():
        return {p: p.stat().st_size for d in local for p in Path(d).rglob("shuffle_*.data")}

    class Watched(Scratch):
        def save(self, *args, **options):
            saved = super().save(*args, **options)
            left.append(sum(n for p, n in shuffled().items() if p not in before))
            return saved

    before, left, scratch = shuffled(), [], Watched(spark, "test")
    size = Path(f"{medium}/documents.parquet").stat().st_size
    scored = suffix_model.score_texts(spark.read.parquet(f"{medium}/documents.parquet"), scratch)
    saved = sum(p.stat().st_size for p in Path(scratch.folder.removeprefix("file:")).rglob("part-*"))
    assert max(left) < 0.1 * size and 0 < saved < 2.5 * size
    assert scored.count() == 1000


def test_keys_of_many_parts_and_batches_add_up(spark, medium, scratch, monkeypatch):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    one = {r["doc_id"]: r for r in suffix_model.score_texts(docs, scratch).collect()}
    monkeypatch.setattr(suffix_model, "PART_TOKENS", 30_000)
    for r in suffix_model.score_texts(docs.repartition(7), scratch).collect():
        wanted = one[r["doc_id"]]
        assert r["score"] == pytest.approx(wanted["score"], rel=1e-9) and r["n_known"] == wanted["n_known"]


@pytest.mark.parametrize("values", [[], [0], [0, 255], [1, 256, 3], [2**64 - 1, 0]])
def test_packed_numbers_come_back(values):
    x = np.array(values, dtype=np.uint64)
    assert words_of_texts.unpacked(words_of_texts.packed(x)).tolist() == values


def test_nodes_are_sparks_hashes(spark):
    rows = [(0, 0), (-1, 5), (1 << 62, -(1 << 63)), (123456789, -987654321)]
    found = spark.createDataFrame(rows, "a long, b long").select("a", "b", F.xxhash64("a", "b").alias("h")).collect()
    a, b, h = (np.array([r[k] for r in found], dtype=np.int64) for k in range(3))
    assert (words_of_texts.xxhash64(a.view(np.uint64), b.view(np.uint64)).view(np.int64) == h).all()


def test_scores_and_base_scores(spark, small):
    rows = texts(spark, small)
    tokens = {i: [*words(t, lower=True), None] for i, t in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    counts = collections.Counter(x for i, w in tokens.items() if not held[i] for x in w)
    n, v = sum(counts.values()), len(counts)
    total = collections.Counter()
    for r in queries.op3_lm_scoring(spark, small).collect():
        w = tokens[r["doc_id"]]
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(w), n)
        assert r["n_known"] == sum(counts[x] > 0 for x in w)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["score"] < 0
        if r["held_out"]:
            total.update(base=r["base_score"], score=r["score"])
    assert total["score"] > total["base"]


def test_toxicity_on_held_out_rows(spark, medium):
    labels = spark.read.parquet(f"{medium}/labels.parquet")
    found = queries.op5_toxicity(spark, medium).join(labels, "doc_id").filter("held_out").collect()
    assert found and all(0 <= r["score"] <= 1 for r in found)
    right = sum(r["predicted"] == r["toxic"] for r in found)
    clean = [r["predicted"] for r in found if not r["toxic"]]
    assert right / len(found) > 0.9 and sum(clean) / len(clean) < 0.05


def test_group_terms_weigh_alike_with_their_beginnings():
    import numpy as np
    import pyarrow as pa

    rows = [("immigrants bad", 1)] * 80 + [("immigrants fine", 0)] * 20 + [("citizens bad", 1)] * 20 + [("citizens fine", 0)] * 80
    picked = toxicity._features(pa.array(["immigrants citizens bad fine"]))[1]
    vocabulary = np.unique(np.concatenate([picked, *toxicity._identity_hashes()]))
    rows += [("immigrants here", 1)] * 30 + [("citizens here", 0)] * 30

    def present(texts):
        text, place = toxicity._present(pa.array(texts), vocabulary)
        return [place[text == k] for k in range(len(texts))]

    toxic = np.array([t for _, t in rows], dtype=float)
    weights = toxicity._fit(present([t for t, _ in rows]), toxic, vocabulary, toxicity.RIDGE, toxicity.FAIRNESS)
    one, other = (1 / (1 + np.exp(-weights[p].sum() - weights[-1])) for p in present(["immigrants here", "citizens here"]))
    assert abs(one - other) < 0.05


def test_odd_rows_come_through(spark, odd, scratch):
    n = odd.count()
    labels = spark.createDataFrame([(4, 1), (7, 0), (7, None), (None, 1)], "doc_id long, toxic int")
    benchmark = spark.createDataFrame([(0, "x")], "item_id long, text string")
    assert ngram_join.component_ids(odd, scratch).count() == n
    assert substring_dedup.without_repeated_spans(odd, scratch).count() == n
    assert suffix_model.score_texts(odd, scratch).count() == n
    assert toxicity.toxicity(odd, labels, scratch).count() == n
    assert pii.personal_data(odd, scratch).count() == n
    assert host_rules.quality_report(odd, scratch).count() == n
    assert mixing.mix(odd, scratch)[0].count() == n
    assert line_dedup.without_repeated_lines(odd, scratch)[0].count() == n
    assert decontamination.contaminated(odd, benchmark, scratch).count() == 0


def test_one_of_each_stays_and_null_ids_come_last(spark, odd, scratch):
    near = "the same line of ten words stands here once again"
    first = near.replace("again", "more")
    rows = [(None, near, "a"), (1, first, "b"), (1, first, "b"), (2, None, "a"), (2, None, "a"), (3, first, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, of string")
    kept = ngram_join.keep_one_of_each(docs, scratch)
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2] and kept.columns == docs.columns
    cut, _, lost = line_dedup.without_repeated_lines(docs, scratch)
    assert {(r["doc_id"], r["text"]) for r in cut.collect()} == {(None, ""), (1, first), (2, None), (3, "")}


@pytest.mark.parametrize("which", ["odd", "empty"])
def test_stages_keep_their_columns(spark, odd, small, which):
    docs = odd if which == "odd" else odd.limit(0)
    for stage in (stages.quality_rules, stages.line_dedup, stages.ngram_jaccard_join, stages.benchmark_decontamination):
        found = stage(spark, docs, small)
        assert found.columns == docs.columns and found.count() <= docs.count()
    mixed = stages.source_mixing(spark, docs, small)
    assert set(docs.columns) < set(mixed.columns) and mixed.filter(F.col("shard").isNull()).count() == 0
