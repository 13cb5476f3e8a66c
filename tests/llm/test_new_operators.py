"""Encoding, the filter audit and clustering, against SQL, the library and plain Python."""

import hashlib
import itertools
import json
import random

import duckdb
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fleetscope.llm import filter_audit, oracles, queries, stream_bpe, va_file
from fleetscope.llm.token_counts import character_symbols
from fleetscope.sinks.storage import Scratch

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PARTS = "abcdefghij"
ODD_TEXTS = [
    None, "", " \t\n ", "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext", "don't''re 'RE x's",
    "a" * 9000, "=-" * 4000, " " * 5000 + "x", "é漢字\U0001f600 ٣½", "'r", "\u0000﻿ ",
]


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")


@pytest.fixture(scope="module")
def content():
    with open(VOCABULARY, "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def against_sql(found, sql, **tables):
    with duckdb.connect() as connection:
        for name, source in tables.items():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{source}'")
        wanted = connection.sql(sql)
        columns = sorted(wanted.columns)
        expected = sorted(map(repr, wanted.select(*columns).fetchall()))
    assert sorted(found.columns) == columns
    assert sorted(repr(tuple(row)) for row in found.select(*columns).collect()) == expected
    return expected


# --- encoding and decoding


def digests(text, library):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False).encode()
    packed = np.array(ids, dtype="<u4").tobytes()
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded).hexdigest()


def test_ids_and_texts_are_the_library_s(spark, medium, library, tmp_path, monkeypatch):
    docs = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(ODD_TEXTS)], "doc_id long, text string")
    both = docs.union(odd)
    found = {r[0]: tuple(r)[1:] for r in _round_trip(spark, both, tmp_path).collect()}
    texts = {r[0]: r[1] for r in both.collect()}
    assert found == {i: digests(t, library) for i, t in texts.items()}


def _round_trip(spark, docs, folder):
    docs.write.parquet(f"{folder}/documents.parquet")
    return queries.op11_bpe_round_trip(spark, str(folder))


def test_encoding_ignores_clashing_columns_repeats_and_empty_tables(spark, tmp_path, library):
    rows = [(1, "two words", 5, "x"), (1, "two words", 6, "y"), (None, None, 7, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string")
    found = [tuple(r) for r in _round_trip(spark, docs, tmp_path / "odd").collect()]
    wanted = [(r[0], *digests(r[1], library)) for r in rows]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    empty = _round_trip(spark, docs.limit(0), tmp_path / "empty")
    assert empty.collect() == [] and empty.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_decoding_keeps_other_columns_and_mends_broken_characters(spark, library):
    broken = [[0], [10545], [10545, 120], [50256, 0, 99], []]
    packed = [(k, np.array(ids, dtype="<u4").tobytes()) for k, ids in enumerate(broken)] + [(9, None)]
    tokens = spark.createDataFrame(packed, "k long, ids binary")
    found = dict(map(tuple, stream_bpe.decode(tokens, VOCABULARY).collect()))
    wanted = {k: library.decode(ids, skip_special_tokens=False) for k, ids in enumerate(broken)}
    assert found == wanted | {9: ""}


@pytest.mark.parametrize("seed", range(3))
def test_streams_are_emitted_within_the_window(content, library, seed):
    lookahead = stream_bpe.sufficient_lookahead(content)
    encoder = stream_bpe.Encoder(content, lookahead)
    chance = random.Random(seed)
    for letters in ("ab", "=", "_-=", "etaoinshr", "日本", "0123456789", "ÃÂ", "Aa"):
        text = "".join(chance.choice(letters) for _ in range(4 * lookahead))
        if len({library.pre_tokenizer.pre_tokenize_str(text)[0][1]}) != 1:
            continue
        stream, ids, data = encoder.stream, [], text.encode()
        for at in range(0, len(data), 700):
            ids += stream.feed(data[at : at + 700])
            assert len(stream.ends) < stream.window + lookahead
        assert len(data) < stream.window or ids  # some have come before the end
        ids = [encoder.ids[t] for t in [*ids, *stream.finish()]]
        assert ids == encoder.piece(data)
        if len(library.pre_tokenizer.pre_tokenize_str(text)) == 1:
            assert ids == library.encode(text, add_special_tokens=False).ids


def test_a_lookahead_bounds_what_can_still_change(content, library):
    """Beyond it, tokens of a prefix are those of any continuation."""
    lookahead = stream_bpe.sufficient_lookahead(content)
    encoder = stream_bpe.Encoder(content, lookahead)
    chance = random.Random(11)
    for letters in ("ab", "=-", "e"):
        data = "".join(chance.choice(letters) for _ in range(2 * lookahead)).encode()
        whole = encoder.piece(data)
        for cut in (lookahead + 100, lookahead + 101, 2 * lookahead - 7):
            before = encoder.piece(data[:cut])
            sizes = np.cumsum([encoder.stream.sizes[encoder.ids.index(i)] for i in before])
            stable = int((sizes <= cut - lookahead).sum())
            assert before[:stable] == whole[:stable]


def test_lookahead_of_small_merge_lists():
    def lookahead(*merges):
        letters = sorted({c for m in merges for c in m if c != " "})
        vocab = {v: i for i, v in enumerate([*letters, *(m.replace(" ", "") for m in merges)])}
        file = {"model": {"vocab": vocab, "merges": list(merges)}, "added_tokens": []}
        return stream_bpe.sufficient_lookahead(json.dumps(file).encode())

    assert lookahead("a b") == 0  # nothing of higher priority overlaps
    assert lookahead("b c", "a b") == 1  # ab waits for one more byte
    assert lookahead("c d", "b c", "a b") == 2  # and a chain for two


def test_long_texts_are_cut_at_pieces(content, library, monkeypatch):
    monkeypatch.setattr(stream_bpe, "SECTION", 3000)
    encoder = stream_bpe.Encoder(content, stream_bpe.sufficient_lookahead(content))
    chance = random.Random(3)
    words = ["don't", "'re", "  ", "\n\n\t ", "<|endoftext|>", "漢字", "x" * 4000, "12 345", " word", "..."]
    for _ in range(12):
        text = "".join(chance.choice(words) for _ in range(chance.randint(200, 900)))
        ids, bounds = encoder.encode(pa.array([text]), character_symbols())
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
        assert bounds.tolist() == [0, len(ids)]


# --- SQL of earlier operators


@pytest.mark.parametrize("name", ["op6_substring_dedup", "op9_ngram_jaccard_join"])
@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_earlier_operators_are_those_of_sql(spark, scale, name):
    folder = f"/root/testdata/{scale}"
    found = queries.QUERIES[name](spark, folder)
    assert against_sql(found, queries.ORACLE_SQL[name], documents=f"{folder}/documents.parquet")


# --- filter audit


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_audit_is_that_of_sql(spark, scale):
    folder = f"/root/testdata/{scale}"
    found = queries.op12_filter_audit(spark, folder)
    tables = {name: f"{folder}/{name}.parquet" for name in ("documents", "labels")}
    rows = against_sql(found, oracles.FILTER_AUDIT, **tables)
    assert len(rows) % 600 == 0 and rows


def plain_audit(rows, marks):
    """By applying every order to every document."""
    import re

    texts = {}
    for i, text, _ in rows:
        if i is not None:
            texts[text or ""] = min(i, texts.get(text or "", i))
    failing = []
    for i, text, part in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and i > texts[text],
        }
        failing.append((part or "", fails, marks.get(i, (0, 0))))
    out = {}
    for part in {p for p, _, _ in failing}:
        removed_by = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = [(f, m) for p, f, m in failing if p == part]
            every = list(left)
            for step, letter in enumerate(order, 1):
                going = [(f, m) for f, m in left if f[letter]]
                left = [(f, m) for f, m in left if not f[letter]]
                removed_by[letter] += len(going)
                out[part, "".join(order), step] = [
                    len(left), len(going), sum(f[letter] for f, _ in every) - len(going),
                    sum(f[letter] and sum(f.values()) == 1 for f, _ in every),
                    sum(m[0] for _, m in going), sum(m[1] for _, m in going),
                ]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(removed_by[order[step - 1]])
    return {key: tuple(values) for key, values in out.items()}


LONG = " ".join(f"w{k}" for k in range(4000))
AUDITED = [
    (1, None, "en"), (2, "", None), (3, " \t\n", ""), (4, LONG, "en"), (5, LONG, "de"), (5, LONG, "de"),
    (6, LONG + " #", "de"), (7, "A" * 300, "en"), (None, LONG, "en"), (None, "only here", "en"), (8, "A b " * 200, "fr"),
    (9, " A b " * 200, "fr"), (10, "a b " * 200, "fr"), (11, "", "fr"), (12, "100 % of it", "fr"),
]
MARKS = [(4, 1, 0), (5, 0, 1), (5, 1, 0), (6, None, 1), (None, 1, 1), (99, 1, 1), (11, 1, 1)]


def test_audit_of_odd_rows_is_that_of_plain_python(spark, scratch):
    rows = [(*row, 1, "x", 3) for row in AUDITED]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n int, part string, mask int")
    labels = spark.createDataFrame(MARKS, "doc_id long, quality int, toxic int")
    found = filter_audit.audit(docs.repartition(3), labels, scratch).drop("filter")
    marks = {4: (1, 0), 5: (1, 1), 6: (0, 1), 11: (1, 1)}
    assert {tuple(r)[:3]: tuple(r)[3:] for r in found.collect()} == plain_audit(AUDITED, marks)


def test_audit_of_nothing_is_empty(spark, scratch):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame(MARKS, "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels, scratch).collect() == []


def test_every_level_of_the_recursion_has_its_prefixes(spark):
    masks = spark.createDataFrame([(0,), (5,), (31,)], "mask int")
    rows = filter_audit.prefix_levels(masks, "ABCDE").collect()
    for step in range(1, 6):
        here = {r["filter_order"] for r in rows if r["step"] == step}
        assert here == {"".join(p) for p in itertools.permutations("ABCDE", step)}
    assert len(rows) == 3 * (5 + 20 + 60 + 120 + 120)
    with pytest.raises(ValueError):
        filter_audit.prefix_levels(masks, "ABCDEFG")


# --- clustering


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_clusters_are_those_of_sql(spark, scale):
    folder = f"/root/testdata/{scale}"
    found = queries.op13_centroid_clustering(spark, folder)
    against_sql(found, oracles.CENTROID_CLUSTERING, embeddings=f"{folder}/embeddings.parquet")


def plain_clusters(rows, dims, k, rounds, scale=64):
    """In the order of ids; exact, on Python numbers."""
    import math

    limit = 1 << ((62 - (dims - 1).bit_length()) // 2 - 1)
    usable = [
        (i, [max(-limit, min(limit, math.floor(min(max(x * scale, -1e18), 1e18)))) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    hashed = lambda i: (i is None, "" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest())
    centroids = [v for _, v in sorted(usable, key=lambda r: (hashed(r[0]), r[0] is None, r[0] or 0, r[1]))[:k]]

    def nearest(v):
        away = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
        return away.index(min(away)), min(away)

    for _ in range(rounds):
        groups = {}
        for _, v in usable:
            groups.setdefault(nearest(v)[0], []).append(v)
        for j, members in groups.items():
            centroids[j] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    found = [(i, *nearest(v)) for i, v in usable]
    total = sum(d for _, _, d in found)
    inertia = {j: sum(d for _, c, d in found if c == j) for j in range(len(centroids))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, inertia[j], total, sha[j]) for i, j, d in found), key=repr)


@pytest.mark.parametrize("bits", [1, 3, 6])
def test_clusters_of_odd_rows_are_those_of_plain_python(spark, scratch, bits):
    chance = random.Random(bits)
    rows = [(i, [chance.choice([-2.5, 0.1, 0.1, 3.0]) + chance.random() for _ in range(4)]) for i in range(200)]
    rows += [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(300, 400)]  # one vector, many rows
    rows += [(7, [9.0, 9.0, 9.0, 9.0]), (None, [0.5] * 4), (None, [0.5] * 4), (500, None), (501, [1.0] * 3)]
    rows += [(502, [1.0, None, 1.0, 1.0]), (503, [float("nan")] * 4), (504, [float("inf")] * 4), (505, [1e30, -1e30, 0.0, 1.0])]
    table = spark.createDataFrame(
        [(i, v, 1, 2.0, "x") for i, v in rows],
        "vec_id long, embedding array<double>, cluster int, distance double, place string",
    )
    found, _ = va_file.cluster(table.repartition(5), scratch, dims=4, k=6, bits=bits)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_clusters(rows, 4, 6, 3)


def test_few_vectors_and_none(spark, scratch):
    table = spark.createDataFrame([(1, [0.0, 1.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    found, centroids = va_file.cluster(table, scratch, dims=2)
    assert len(centroids) == 2
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_clusters([(1, [0.0, 1.0]), (2, [0.0, 1.0])], 2, 16, 3)
    nothing, _ = va_file.cluster(table.limit(0), scratch, dims=2)
    assert nothing.collect() == [] and nothing.columns == found.columns


def test_cells_bound_every_distance(spark):
    numbers = np.random.default_rng(2)
    vectors = numbers.integers(-40, 40, (500, 8))
    centroids = numbers.integers(-40, 40, (5, 8))
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "id long, vector array<bigint>")
    true = ((vectors[:, None] - centroids) ** 2).sum(axis=2)
    decided = []
    for bits in (1, 2, 4, 6):
        cells = va_file.cut_cells(table, 8, bits)
        packed = cells.compress(vectors)
        assert packed.shape == (500, bits)  # eight cells of so many bits
        left = va_file.Bounds(cells, centroids).possible(cells.expand(packed))
        assert left[np.arange(500), true.argmin(axis=1)].all()
        decided.append((left.sum(axis=1) == 1).mean())
    assert decided == sorted(decided) and decided[-1] > 0.9


def test_rounds_between_fetch_only_what_may_have_moved(spark, scratch):
    numbers = np.random.default_rng(4)
    centres = numbers.integers(-30, 30, (4, 8))
    vectors = centres[numbers.integers(0, 4, 600)] + numbers.integers(-2, 3, (600, 8))
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "id long, vector array<bigint>")
    file = va_file.VaFile(table, scratch, 8)
    moved = centres + 1
    assert file.undecided(centres, moved).count() < 30
    changed = file.sums(centres) + file.changes(centres, moved)
    assert (changed == file.sums(moved)).all()
    plan = file.undecided(centres, moved)._jdf.queryExecution().executedPlan().toString()
    assert "vector" not in plan.split("ReadSchema")[1]
