"""Token counts of a byte-level BPE vocabulary by finite-state transducers.

Two deterministic transducers are compiled from the vocabulary file. The first
cuts a text into pieces, as the library's splitting pattern does: twelve states,
and each transition says whether a piece starts at this character or started at
the one before. Texts are cut into chunks of fixed length; every chunk yields
the map from each possible state before it to the state after it, the maps
compose by a parallel prefix scan, and with the state before each chunk known
all chunks emit at once.

The second reads the bytes of one piece. Its state holds all that the rest of
the piece can depend on: for every start from which some vocabulary entry may
still be completed, the entry's prefix, the token that ends there, and how many
tokens lie before. A transition is annotated with the tokens it adds (or takes
back, when bytes merge). States are determinised when first met and kept in a
cache of bounded size; so are the counts of whole pieces.

Nulls and empty texts have no tokens. Repeated rows are counted one by one. An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fleetscope.llm import words

CHUNK = 256
SETTLING = 8  # characters after which a chunk is asked whether its map is constant
CACHED_PIECES = 400_000
CACHED_TRANSITIONS = 300_000

# symbols: letters by their role in contractions, number, other, quote, white space
LETTER, STMD, R, V, EL, E, NUMBER, OTHER, QUOTE, SPACE, WHITE, SPECIAL, REST = range(13)
FIRST = 13  # added to the symbol of a text's first character
SYMBOLS = 2 * FIRST
(
    ANEW, LETTERS, NUMBERS, OTHERS, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L, ONE_SPACE, ONE_WHITE,
    MORE_SPACE, MORE_WHITE,
) = range(12)
STATES = 12
HERE, BEFORE = 1, 2  # a piece starts at this character, or at the one before


@cache
def piece_transducer() -> tuple[np.ndarray, np.ndarray]:
    """Next state and output, by state and symbol, flattened."""
    after = np.zeros((STATES, SYMBOLS), dtype=np.uint8)
    out = np.zeros((STATES, SYMBOLS), dtype=np.uint8)
    letters = (LETTER, STMD, R, V, EL, E)
    run = {LETTERS: letters, NUMBERS: (NUMBER,), OTHERS: (OTHER, QUOTE)}
    run_of = {symbol: state for state, symbols in run.items() for symbol in symbols}
    alone = run_of | {QUOTE: QUOTED, SPACE: ONE_SPACE, WHITE: ONE_WHITE}
    contraction = {STMD: ANEW, R: QUOTED_R, V: QUOTED_V, EL: QUOTED_L}
    completed = {QUOTED_R: E, QUOTED_V: E, QUOTED_L: EL}
    for state in range(STATES):
        for symbol in range(REST):
            to, starts = (ANEW, HERE) if symbol == SPECIAL else (alone[symbol], HERE)
            if symbol == SPECIAL:
                starts |= BEFORE if state in completed else 0
            elif state in run and symbol in run[state]:
                to, starts = state, 0
            elif state == QUOTED and symbol in contraction:
                to, starts = contraction[symbol], 0
            elif state == QUOTED and symbol in run[OTHERS]:
                to, starts = OTHERS, 0
            elif state in completed:
                if symbol == completed[state]:
                    to, starts = ANEW, 0
                elif symbol in letters:
                    to, starts = LETTERS, BEFORE
                else:
                    starts = HERE | BEFORE
            elif state in (ONE_SPACE, ONE_WHITE, MORE_SPACE, MORE_WHITE):
                more = state in (MORE_SPACE, MORE_WHITE)
                if symbol in (SPACE, WHITE):
                    to, starts = (MORE_SPACE if symbol == SPACE else MORE_WHITE), 0
                else:
                    starts = BEFORE if more else 0
                    if state in (ONE_SPACE, MORE_SPACE):
                        to = run_of[symbol]  # the last space belongs to the run
                    else:
                        starts |= HERE
            after[state, symbol], out[state, symbol] = to, starts
        after[state, REST], out[state, REST] = ANEW, 0
    for state in range(STATES):
        pending = BEFORE if state in completed else 0
        for symbol in range(FIRST):
            after[state, symbol + FIRST] = after[ANEW, symbol]
            out[state, symbol + FIRST] = out[ANEW, symbol] | pending
    return after.ravel(), out.ravel()


@cache
def character_symbols() -> np.ndarray:
    """The symbol of every code point, as the library itself classifies it."""
    from tokenizers import Regex
    from tokenizers.normalizers import Replace

    points = np.array([p for p in range(0x110000) if not 0xD800 <= p < 0xE000])
    characters = "".join(map(chr, points))
    symbols = np.full(0x110000, OTHER, dtype=np.uint8)
    for pattern, symbol in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", WHITE)):
        marked = Replace(Regex(pattern), "\x01").normalize_str(characters)
        is_one = np.frombuffer(marked.encode("utf-32-le"), dtype=np.uint32) == 1
        symbols[points[is_one & (points != 1)]] = symbol
    for characters, symbol in (("stmd", STMD), ("r", R), ("v", V), ("l", EL), ("e", E)):
        symbols[[ord(c) for c in characters]] = symbol
    symbols[ord("'")], symbols[ord(" ")] = QUOTE, SPACE
    return symbols


def scan_states(symbols: np.ndarray) -> np.ndarray:
    """The output of every transition, from the maps of equally long chunks."""
    after, out = piece_transducer()
    n = len(symbols)
    chunks = -(-n // CHUNK)
    padded = np.full(chunks * CHUNK, REST, dtype=np.intp)
    padded[:n] = symbols
    columns = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T)
    maps = np.empty((chunks, STATES), dtype=np.intp)
    maps[:] = np.arange(STATES)
    open_chunks = np.arange(chunks)  # whose map still tells states apart
    for at in range(0, CHUNK, SETTLING):
        some = maps[open_chunks]
        for column in columns[at : at + SETTLING]:
            some *= SYMBOLS
            some += column[open_chunks, None]
            some = after.take(some).astype(np.intp)
        maps[open_chunks] = some
        settled = (some == some[:, :1]).all(axis=1)
        if settled.any():  # one state is left: a single walk to the chunk's end
            walk, state = open_chunks[settled], some[settled, 0]
            for column in columns[at + SETTLING :]:
                state = after.take(state * SYMBOLS + column[walk]).astype(np.intp)
            maps[walk] = state[:, None]
        open_chunks = open_chunks[~settled]
        if not len(open_chunks):
            break
    step = 1
    while step < chunks:  # prefix scan: every map comes to cover twice as many chunks
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].copy(), axis=1)
        step *= 2
    state = np.zeros(chunks, dtype=np.intp)
    state[1:] = maps[:-1, ANEW]
    outputs = np.empty((CHUNK, chunks), dtype=np.uint8)
    for row, column in zip(outputs, columns, strict=True):
        index = state * SYMBOLS + column
        row[:] = out.take(index)
        state = after.take(index).astype(np.intp)
    flat = outputs.T.reshape(-1)[:n]
    _finish(flat, int(symbols[-1]), int(state[-1]) if n == chunks * CHUNK else None, maps, symbols)
    return flat


def _finish(flat, last, state, maps, symbols) -> None:
    """A contraction cut off by the end leaves its letter as a piece of its own."""
    after, _ = piece_transducer()
    if state is None:  # padding has moved the state on: walk the last chunk again
        at = (len(symbols) - 1) // CHUNK * CHUNK
        state = int(maps[-2, ANEW]) if at else ANEW
        for symbol in symbols[at:]:
            state = int(after[state * SYMBOLS + int(symbol)])
    if state in (QUOTED_R, QUOTED_V, QUOTED_L):
        flat[-1] |= HERE


class PieceCounter:
    """Counts the tokens of single pieces by the lazily compiled transducer."""

    def __init__(self, vocabulary: bytes) -> None:
        model = json.loads(vocabulary)["model"]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(printable)]
        byte_of = {chr(b): b for b in printable}
        byte_of |= {chr(256 + i): b for i, b in enumerate(hidden)}
        spelled = {t: bytes(byte_of[c] for c in t) for t in model["vocab"]}
        number = {b: i for i, b in enumerate(spelled.values())}
        self.rank = {}  # of the pair of two tokens
        self.parts = {}  # of a token: its halves and the rank that joins them
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            key = number[spelled[left]], number[spelled[right]]
            self.rank[key] = rank
            self.parts.setdefault(number[spelled[left] + spelled[right]], (*key, rank))
        self.child: dict[int, int] = {}
        self.token: list[int] = [-1]
        for entry, token in number.items():
            node = 0
            for byte in entry:
                to = self.child.get(node << 8 | byte)
                if to is None:
                    to = self.child[node << 8 | byte] = len(self.token)
                    self.token.append(-1)
                node = to
            self.token[node] = token
        self.allowed: dict[tuple[int, int], bool] = {}
        self.spines: tuple[dict, dict] = ({}, {})
        self.pieces: dict[bytes, int] = {}
        self._forget()

    def _forget(self) -> None:
        start = ((0, -1, 0),)
        self.states = [start]
        self.number_of = {start: 0}
        self.moves: dict[int, tuple[int, int]] = {}

    def _spine(self, token: int, half: int) -> list[tuple[int, int, int]]:
        """The outermost tokens on one side while a token is being built: each
        with the ranks at which it appears and disappears."""
        spine = self.spines[half].get(token)
        if spine is None:
            spine, part, until = [], token, len(self.rank)
            while part in self.parts:
                rank = self.parts[part][2]
                spine.append((part, rank, until))
                part, until = self.parts[part][half], rank
            spine.append((part, -1, until))
            self.spines[half][token] = spine
        return spine

    def adjacent(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart: no merge joins what lies on both
        sides of their border while they are being built."""
        known = self.allowed.get((left, right))
        if known is None:
            known, ranks, rights = True, self.rank, self._spine(right, 0)
            for a, a_from, a_until in self._spine(left, 1):
                for b, b_from, b_until in rights:
                    if b_from >= a_until or a_from >= b_until:
                        continue  # never there at the same time
                    rank = ranks.get((a, b))
                    # of equal pairs the leftmost is joined first
                    if rank is not None and max(a_from, b_from) < rank < a_until:
                        known = known and rank > b_until
            if len(self.allowed) >= CACHED_TRANSITIONS:
                self.allowed.clear()
            self.allowed[left, right] = known
        return known

    def _move(self, state: int, byte: int) -> tuple[int, int]:
        live, last, added = [], -1, 0
        for node, before, count in self.states[state]:
            to = self.child.get(node << 8 | byte)
            if to is None:
                continue
            live.append((to, before, count))
            token = self.token[to]
            if token >= 0 and last < 0 and (before < 0 or self.adjacent(before, token)):
                last, added = token, count + 1
        after = (*((node, before, count - added) for node, before, count in live), (0, last, 0))
        to = self.number_of.get(after)
        if to is None:
            to = self.number_of[after] = len(self.states)
            self.states.append(after)
        self.moves[state << 8 | byte] = to, added
        return to, added

    def count(self, piece: bytes) -> int:
        known = self.pieces.get(piece)
        if known is not None:
            return known
        if len(self.moves) >= CACHED_TRANSITIONS:
            self._forget()
        state, total, moves = 0, 0, self.moves
        for byte in piece:
            move = moves.get(state << 8 | byte) or self._move(state, byte)
            state = move[0]
            total += move[1]
        if len(piece) <= 64:
            if len(self.pieces) >= CACHED_PIECES:
                self.pieces.clear()
            self.pieces[piece] = total
        return total


def _code_points(data: np.ndarray, leads: np.ndarray) -> np.ndarray:
    points = data[leads].astype(np.uint32)
    wide = np.flatnonzero(points >= 0xC0)
    if len(wide):
        at, first = leads[wide], points[wide]
        following = [data[np.minimum(at + k, len(data) - 1)].astype(np.uint32) & 0x3F for k in (1, 2, 3)]
        two = (first & 0x1F) << 6 | following[0]
        three = (first & 0x0F) << 12 | following[0] << 6 | following[1]
        four = (first & 0x07) << 18 | following[0] << 12 | following[1] << 6 | following[2]
        points[wide] = np.where(first < 0xE0, two, np.where(first < 0xF0, three, four))
    return np.minimum(points, 0x10FFFF)


def count_tokens(
    texts: pa.Array, counter: PieceCounter, symbol_of: np.ndarray, special: tuple[bytes, ...]
) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and tokens of every text."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    sizes = np.diff(offsets)
    if not sizes.sum():
        return sizes, np.zeros(len(texts), dtype=np.int64)
    bounds = offsets - offsets[0]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    leads = np.flatnonzero((data & 0xC0) != 0x80)
    symbols = symbol_of[_code_points(data, leads)]
    raw = data.tobytes()
    specials = set()
    for name in special:
        at = raw.find(name)
        while at >= 0:
            text = np.searchsorted(bounds, at, "right")
            if at + len(name) <= bounds[text]:
                first, end = np.searchsorted(leads, [at, at + len(name)])
                symbols[first], symbols[first + 1 : end] = SPECIAL, REST
                specials.add(at)
            at = raw.find(name, at + len(name))
    text_starts = np.unique(bounds[:-1][sizes > 0])
    symbols[np.searchsorted(leads, text_starts)] += FIRST
    outputs = scan_states(symbols)
    begins = (outputs & HERE) > 0
    begins[:-1] |= (outputs[1:] & BEFORE) > 0
    starts = leads[begins]
    ends = np.append(starts[1:], len(data))
    keys = words._range_hash(words._BYTES[data], starts, ends, words._BASE, words._INVERSE)
    _, where, which = np.unique(keys, return_index=True, return_inverse=True)
    firsts, lasts = starts[where].tolist(), ends[where].tolist()
    distinct = np.fromiter(
        (counter.count(raw[a:b]) for a, b in zip(firsts, lasts, strict=True)), np.int64, len(where)
    )
    counts = distinct[which]
    if specials:
        counts[np.searchsorted(starts, sorted(specials))] = 1
    sums = np.append(0, np.cumsum(counts))
    at = np.searchsorted(starts, bounds)
    return sizes, sums[at[1:]] - sums[at[:-1]]


_counters: dict[int, PieceCounter] = {}


def token_counts(
    docs: DataFrame,
    vocabulary: str,
    id: str = "doc_id",
    text: str = "text",
    limit: int = 1024,
    slice_bytes: int = 4 * words.SLICE_BYTES,
) -> DataFrame:
    """``id``, bytes, tokens, and whether there are more than ``limit`` tokens.

    ``vocabulary`` is the path of a tokenizer file on the driver; its content,
    of fixed size, is broadcast."""
    with open(vocabulary, "rb") as file:
        content = file.read()
    special = tuple(t["content"].encode() for t in json.loads(content)["added_tokens"])
    shared = docs.sparkSession.sparkContext.broadcast((content, character_symbols(), special))
    key = hash(content)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        content, symbol_of, special = shared.value
        counter = _counters.get(key)
        if counter is None:
            _counters.clear()
            counter = _counters[key] = PieceCounter(content)
        for batch in words.slices(batches, "text", slice_bytes):
            sizes, counts = count_tokens(batch.column("text"), counter, symbol_of, special)
            columns = [batch.column("doc_id"), sizes, counts, counts > limit]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c) for c in columns],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    narrow = docs.select(docs[id].alias("doc_id"), docs[text].alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return narrow.mapInArrow(count, schema)
