"""Streaming byte-pair encoding with bounded lookahead, and streaming decoding.

Whether two halves of a vocabulary entry merge can depend on what follows only
through a chain of merges, each of which overlaps the one before, reaches farther
to the right and has a higher priority. The longest such chain of a merge list,
in bytes, is its sufficient lookahead: ``sufficient_lookahead`` computes it from
the list alone. The encoder reads one byte after another and knows for every
prefix of the input which token it ends with: the one entry that may stand after
the token before it. Following these ends back from the place that was read
gives the prefix's tokens, and those that end a whole lookahead behind it are
stable: they are emitted and forgotten. What is kept never exceeds twice the
lookahead plus a token, however long the input without a break is.

A text is cut into the library's pieces section by section, and a section starts
at a piece, so a very long text takes the memory of a section (of its longest
piece, if that is longer). Pieces of up to 64 bytes are encoded once and kept in
a cache of bounded size. The decoder turns tokens into bytes and reads these by
a state machine whose state is a character's first bytes; bytes that are no text
become U+FFFD, as with the library.

Token ids are stored as little-endian unsigned 32-bit numbers in one binary
column. A null or empty text has no tokens, null ids no text; ids outside the
vocabulary are skipped in decoding. Special tokens are found in texts wherever
they stand. Repeated rows are encoded one by one. An empty table gives an empty
result; columns that are not named are ignored by ``encode`` and kept by
``decode``.
"""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fleetscope.llm import words
from fleetscope.llm.token_counts import (
    BEFORE,
    FIRST,
    HERE,
    REST,
    SPECIAL,
    PieceCounter,
    _code_points,
    character_symbols,
    scan_states,
)

CACHED_PIECES = 300_000
CACHED_BYTES = 64
CACHED_TRANSITIONS = 300_000
SECTION = words.SLICE_BYTES  # of texts that are cut at once
_TEXTS = 4 * words.SLICE_BYTES  # whose pieces are looked up at once
_UNSURE = 64  # bytes before a section's end in which its cuts may still change


def _spelled(model: dict) -> dict[str, bytes]:
    """The bytes of every vocabulary entry."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = sorted(set(range(256)) - set(printable))
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}
    return {t: bytes(byte_of[c] for c in t) for t in model["vocab"]}


@cache
def sufficient_lookahead(content: bytes) -> int:
    """How many bytes beyond a token's end can decide whether it is one."""
    model = json.loads(content)["model"]
    spelled = _spelled(model)
    merged = []
    for pair in model["merges"]:
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merged.append(spelled[left] + spelled[right])
    entries = set(merged)
    # by overlap: how far the entries of higher priority can reach that begin
    # with these bytes, or hold this entry before their end
    begins: dict[bytes, int] = {}
    holds: dict[bytes, int] = {}
    farthest = 0
    for entry in merged:
        size = len(entry)
        reach = max(holds.get(entry, 0), *(begins.get(entry[a:], 0) for a in range(size)))
        farthest = max(farthest, reach)
        for b in range(1, size):
            beyond = size - b + reach
            start = entry[:b]
            if beyond > begins.get(start, 0):
                begins[start] = beyond
            for a in range(1, b):
                inner = entry[a:b]
                if inner in entries and beyond > holds.get(inner, 0):
                    holds[inner] = beyond
    return farthest


class StreamEncoder:
    """The tokens of one piece, byte by byte, in constant memory.

    A state is what may still become a token: places in the trie of entries, each
    with the token before its first byte. Whether a place's entry may stand after
    that token is decided once, when the state's transition is first taken."""

    def __init__(self, table: PieceCounter, sizes: list[int], lookahead: int) -> None:
        self.table, self.sizes, self.lookahead = table, sizes, lookahead
        self.window = 2 * lookahead + max(sizes)
        self._forget()

    def _forget(self) -> None:
        """No state but the first is known, and the input begins anew."""
        start = (0,)
        self.states = [start]  # of each, place << 16 | token before + 1
        self.number_of = {start: 0}
        self.moves: dict[int, int] = {}  # next state << 16 | last token + 1
        self.state = 0
        self.ends: list[int] = []  # the token each prefix ends with, since the last stable one

    def _move(self, state: int, byte: int) -> int:
        """The next state, and the token that the input now ends with."""
        child, token, adjacent = self.table.child, self.table.token, self.table.adjacent
        longer, last = [], 0
        for entry in self.states[state]:
            to = child.get((entry >> 16) << 8 | byte)
            if to is None:
                continue
            before = entry & 0xFFFF
            longer.append(to << 16 | before)
            found = token[to]
            if found >= 0 and not last and (not before or adjacent(before - 1, found)):
                last = found + 1
        longer.append(last)
        after = tuple(longer)
        number = self.number_of.get(after)
        if number is None:
            number = self.number_of[after] = len(self.states)
            self.states.append(after)
        move = self.moves[state << 8 | byte] = number << 16 | last
        return move

    def feed(self, data: bytes) -> list[int]:
        """Reads on; returns the tokens that have become stable."""
        stable: list[int] = []
        for at in range(0, len(data), self.lookahead + 1):
            state, ends, moves = self.state, self.ends, self.moves
            for byte in data[at : at + self.lookahead + 1]:
                move = moves.get(state << 8 | byte) or self._move(state, byte)
                state = move >> 16
                ends.append((move & 0xFFFF) - 1)
            if len(moves) >= CACHED_TRANSITIONS:
                here = self.states[state]
                self._forget()
                state, self.ends = self.number_of.setdefault(here, 1), ends
                self.states += [here] * state  # the first state is there already
            self.state = state
            if len(ends) >= self.window:
                emitted, until = self._settled(len(ends) - self.lookahead)
                stable += emitted
                self.ends = ends[until:]
        return stable

    def _settled(self, until: int) -> tuple[list[int], int]:
        """Tokens that end no later than ``until``, and where the last one does."""
        tokens, at, end = [], len(self.ends), 0
        while at > 0:
            if at <= until:
                end = end or at
                tokens.append(self.ends[at - 1])
            at -= self.sizes[self.ends[at - 1]]
        if at < 0:
            raise AssertionError("a token crosses one that was stable")
        return tokens[::-1], end

    def finish(self) -> list[int]:
        """The tokens that are left; the encoder is ready for the next piece."""
        tokens, _ = self._settled(len(self.ends))
        self.state, self.ends = 0, []
        return tokens


class Encoder:
    """Texts to token ids."""

    def __init__(self, content: bytes, lookahead: int) -> None:
        file = json.loads(content)
        vocabulary = file["model"]["vocab"]
        spelled = _spelled(file["model"])
        self.special = {t["content"].encode(): t["id"] for t in file["added_tokens"]}
        # the table numbers entries in the order of the file
        number = {entry: i for i, entry in enumerate(spelled.values())}
        self.ids = [0] * len(number)
        sizes = [0] * len(number)
        for name, entry in spelled.items():
            self.ids[number[entry]], sizes[number[entry]] = vocabulary[name], len(entry)
        self.stream = StreamEncoder(PieceCounter(content), sizes, lookahead)
        self.pieces: dict[bytes, list[int]] = {}

    def piece(self, data: bytes) -> list[int]:
        """The token ids of one piece."""
        known = self.pieces.get(data)
        if known is None:
            ids = self.ids
            known = [ids[t] for t in chain(self.stream.feed(data), self.stream.finish())]
            if len(data) <= CACHED_BYTES:
                if len(self.pieces) >= CACHED_PIECES:
                    self.pieces.clear()
                self.pieces[data] = known
        return known

    def _cut(self, data: np.ndarray, bounds: np.ndarray, symbol_of: np.ndarray):
        """Starts of the pieces of texts (data[bounds[i]:bounds[i + 1]]), and the
        ids of those that are special tokens (-1: none)."""
        leads = np.flatnonzero((data & 0xC0) != 0x80)
        symbols = symbol_of[_code_points(data, leads)]
        raw, found = data.tobytes(), {}
        for name, token in self.special.items():
            at = raw.find(name)
            while at >= 0:
                if at + len(name) <= bounds[np.searchsorted(bounds, at, "right")]:
                    first, end = np.searchsorted(leads, [at, at + len(name)])
                    symbols[first], symbols[first + 1 : end] = SPECIAL, REST
                    found[at] = token
                    at = raw.find(name, at + len(name))
                else:
                    at = raw.find(name, at + 1)
        text_starts = np.unique(bounds[:-1][np.diff(bounds) > 0])
        symbols[np.searchsorted(leads, text_starts)] += FIRST
        outputs = scan_states(symbols)
        begins = (outputs & HERE) > 0
        begins[:-1] |= (outputs[1:] & BEFORE) > 0
        starts = leads[begins]
        special = np.full(len(starts), -1)
        if found:
            special[np.searchsorted(starts, sorted(found))] = [found[at] for at in sorted(found)]
        return starts, special

    def _cut_all(self, data: np.ndarray, bounds: np.ndarray, symbol_of: np.ndarray):
        """The same of more texts than are cut at once, with the pieces' ends, and
        keys that are equal for equal pieces."""
        cuts, at = [], 0
        while at < len(bounds) - 1:
            to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + SECTION, "right")) - 1)
            low, high = bounds[at], bounds[to]
            if low < high:
                some = data[low:high]
                starts, special = self._cut(some, bounds[at : to + 1] - low, symbol_of)
                ends = np.append(starts[1:], len(some))
                keys = _piece_keys(some, starts, ends)
                marked = special >= 0
                keys[marked] = special[marked].astype(np.uint64) + np.uint64(0xFF << 54)
                cuts.append((starts + low, ends + low, special, keys))
            at = to
        return tuple(np.concatenate(part) for part in zip(*cuts, strict=True))

    def section(self, data: np.ndarray, bounds: np.ndarray, symbol_of: np.ndarray, whole: bool):
        """The ids of the texts, one after another, and the bounds of each text's
        ids. Of one text that goes on beyond ``data`` (not ``whole``), only what
        can't change any more; last comes where that ends."""
        if not len(data):
            return np.empty(0, dtype="<u4"), np.zeros(len(bounds), dtype=np.int64), 0
        starts, ends, special, keys = self._cut_all(data, bounds, symbol_of)
        raw = data.tobytes()
        until = len(data)
        if not whole:
            sure = int(np.searchsorted(starts, len(data) - _UNSURE, "right")) - 1
            if sure <= 0:
                return np.empty(0, dtype="<u4"), np.zeros(len(bounds), dtype=np.int64), 0
            until = int(starts[sure])
            starts, ends, special, keys = starts[:sure], ends[:sure], special[:sure], keys[:sure]
        _, where, which = np.unique(keys, return_index=True, return_inverse=True)
        tokens = [
            self.piece(raw[a:b]) if token < 0 else [token]
            for a, b, token in zip(starts[where].tolist(), ends[where].tolist(), special[where].tolist())
        ]
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        flat = np.fromiter(chain.from_iterable(tokens), "<u4", int(sizes.sum()))
        first = np.cumsum(sizes) - sizes
        counts = sizes[which]
        ids = flat[words.ranges(first[which], counts)]
        before = np.append(0, np.cumsum(counts))
        return ids, before[np.searchsorted(starts, bounds)], until

    def encode(self, texts: pa.Array, symbol_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and the bounds of each text's ids."""
        texts = texts.cast(pa.large_string())
        if texts.null_count:
            texts = texts.fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
        offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
        if offsets[0] == offsets[-1]:
            return np.empty(0, dtype="<u4"), np.zeros(len(offsets), dtype=np.int64)
        data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
        bounds = offsets - offsets[0]
        if len(data) <= SECTION or len(texts) > 1:
            return self.section(data, bounds, symbol_of, True)[:2]
        parts, at, size = [], 0, SECTION
        while at < len(data):
            to = min(at + size, len(data))
            while to < len(data) and data[to] & 0xC0 == 0x80:
                to -= 1
            some = data[at:to]
            ids, _, until = self.section(some, np.array([0, len(some)]), symbol_of, to == len(data))
            parts.append(ids)
            at, size = at + until, SECTION if until else 2 * size
        ids = np.concatenate(parts)
        return ids, np.array([0, len(ids)])


def _piece_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal for equal pieces: the bytes themselves of up to seven, a hash of
    63 bits of more."""
    sizes = ends - starts
    keys = sizes.astype(np.uint64) << np.uint64(56)
    padded = np.append(data, np.zeros(8, dtype=np.uint8))
    for k in range(min(7, int(sizes.max(initial=0)))):
        byte = padded[starts + k].astype(np.uint64) << np.uint64(8 * k)
        keys |= np.where(sizes > k, byte, np.uint64(0))
    long = np.flatnonzero(sizes > 7)
    if len(long):
        hashed = words._range_hash(words._BYTES[data], starts[long], ends[long], words._BASE, words._INVERSE)
        keys[long] = hashed | np.uint64(1 << 63)
    return keys


class TextDecoder:
    """Token ids to text, as they come. Between calls it holds the first bytes
    of a character, three at most."""

    def __init__(self, entries: np.ndarray, first: np.ndarray) -> None:
        self.entries, self.first = entries, first  # bytes of all tokens, bounds of each
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray) -> str:
        known = ids[ids < len(self.first) - 1].astype(np.int64)
        start = self.first[known]
        spelled = self.entries[words.ranges(start, self.first[known + 1] - start)]
        return self.state.decode(spelled.tobytes())

    def finish(self) -> str:
        left = self.state.decode(b"", True)
        self.state.reset()
        return left


def token_bytes(content: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the tokens in the order of their ids, and their bounds."""
    file = json.loads(content)
    spelled = _spelled(file["model"])
    entry = {number: spelled[name] for name, number in file["model"]["vocab"].items()}
    entry |= {t["id"]: t["content"].encode() for t in file["added_tokens"]}
    in_order = [entry.get(number, b"") for number in range(max(entry) + 1)]
    first = np.append(0, np.cumsum([len(e) for e in in_order]))
    return np.frombuffer(b"".join(in_order), dtype=np.uint8), first


_encoders: dict[int, Encoder] = {}
_DECODED_AT_ONCE = 1 << 18  # ids


def _content(vocabulary: str) -> bytes:
    with open(vocabulary, "rb") as file:
        return file.read()


def encode(docs: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, n_tokens and ids of every text. ``vocabulary`` is the path of a
    tokenizer file on the driver; its content, of fixed size, is broadcast."""
    content = _content(vocabulary)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((content, character_symbols(), sufficient_lookahead(content)))
    key = hash(content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content, symbol_of, lookahead = shared.value
        encoder = _encoders.get(key)
        if encoder is None:
            _encoders.clear()
            encoder = _encoders[key] = Encoder(content, lookahead)
        for batch in words.slices(batches, "text", _TEXTS):
            ids, first = encoder.encode(batch.column("text"), symbol_of)
            buffers = [None, pa.py_buffer((4 * first).astype(np.int32)), pa.py_buffer(ids.tobytes())]
            column = pa.Array.from_buffers(pa.binary(), batch.num_rows, buffers)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(first)), column], ["id", "n_tokens", "ids"]
            )

    narrow = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, n_tokens bigint, ids binary").toDF(id, "n_tokens", "ids")


def decode(tokens: DataFrame, vocabulary: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """``tokens`` with ``text`` in the place of ``ids``."""
    shared = tokens.sparkSession.sparkContext.broadcast(token_bytes(_content(vocabulary)))
    others = [name for name in tokens.columns if name != ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = TextDecoder(*shared.value)
        for batch in batches:
            texts = []
            for packed in batch.column(ids):
                held = packed.as_buffer()
                numbers = np.frombuffer(held, dtype="<u4") if held is not None else np.empty(0, "<u4")
                parts = [
                    decoder.feed(numbers[at : at + _DECODED_AT_ONCE])
                    for at in range(0, len(numbers), _DECODED_AT_ONCE)
                ]
                texts.append("".join(parts) + decoder.finish())
            columns = [batch.column(name) for name in others] + [pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*others, text])

    schema = tokens.select(*others).schema.add(text, "string")
    return tokens.select(*others, ids).mapInArrow(run, schema)
