"""Byte-level BPE without regular expressions.

Pre-tokenising: every code point gets a class from a table; classes and a look at the neighbours give symbols; a symbol
is a function from automaton state to automaton state.  These functions are composed: within fixed blocks column by
column over all blocks at once, then over the blocks by doubling, since composition is associative.  Each block then
knows its entry state, and one more sweep gives the states and the token boundaries.  The slices between boundaries go
to a cache of merged pieces; merging takes the pair of lowest rank, the leftmost of equal ones.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrivium.llm.common import text_batches, whole_text
from quadrivium.session import ship_package

CACHE_PIECES = 400_000
CACHED_BYTES = 64
#: Longer pieces are merged with a heap.
SHORT_PIECE = 48

OTHER, LETTER, NUMBER, SPACE, BLANK = range(5)  # classes; BLANK is the plain space
#: Symbols: white space with white space or the end behind it is INNER; before anything else it is LAST, or LEAD for the
#: plain space, which joins what follows.  QUOTE1 and QUOTE2 are apostrophes that begin an ending of 1 or 2 letters.
S_OTHER, S_LETTER, S_NUMBER, S_INNER, S_LEAD, S_LAST, S_QUOTE1, S_QUOTE2, S_RESET = range(9)
#: States: before a token, in letters, numbers, others, after a leading space, in white space, 1 or 2 letters of an ending left.
FRESH, IN_LETTER, IN_NUMBER, IN_OTHER, LED, IN_SPACE, ENDING1, ENDING2 = range(8)
STATES = 8
BLOCK = 64


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a token begins) for symbol and state."""
    step = np.zeros((9, STATES), np.uint8)
    begins = np.ones((9, STATES), bool)
    for symbol, state in ((S_LETTER, IN_LETTER), (S_NUMBER, IN_NUMBER), (S_OTHER, IN_OTHER)):
        step[symbol] = state
        begins[symbol, [state, LED]] = False
    step[S_LETTER, ENDING1], step[S_LETTER, ENDING2] = FRESH, ENDING1
    begins[S_LETTER, [ENDING1, ENDING2]] = False
    step[S_INNER], begins[S_INNER, IN_SPACE] = IN_SPACE, False
    step[S_LEAD], step[S_LAST], step[S_RESET] = LED, FRESH, FRESH
    for symbol, state in ((S_QUOTE1, ENDING1), (S_QUOTE2, ENDING2)):
        step[symbol] = state
        step[symbol, [IN_OTHER, LED]] = IN_OTHER
        begins[symbol, [IN_OTHER, LED]] = False
    return step, begins


STEP, BEGINS = _automaton()
_CLASSES: list[np.ndarray] = []


def classes() -> np.ndarray:
    """The class of every code point."""
    if not _CLASSES:
        out = np.zeros(0x110000, np.uint8)
        for low, high in ((0, 0xD800), (0xE000, 0x110000)):
            text = "".join(map(chr, range(low, high)))
            for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\p{White_Space}+", SPACE)):
                for m in regex.finditer(pattern, text):
                    out[low + m.start():low + m.end()] = kind
        out[32] = BLANK
        _CLASSES.append(out)
    return _CLASSES[0]


def symbols(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Symbols of concatenated texts; ``ends`` are the places of the one separator after each text."""
    kind = classes()[points]
    kind[ends] = SPACE
    white = kind >= SPACE
    before_word = np.empty(len(points), bool)
    before_word[:-1] = ~white[1:]
    before_word[-1:] = False
    out = np.array([S_OTHER, S_LETTER, S_NUMBER, S_INNER, S_INNER], np.uint8)[kind]
    out[white & before_word] = S_LAST
    out[(kind == BLANK) & before_word] = S_LEAD
    quotes = np.flatnonzero(points == ord("'"))
    if len(quotes):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        one, two = padded[quotes + 1], padded[quotes + 2]
        out[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = S_QUOTE1
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        out[quotes[pair]] = S_QUOTE2
    out[ends] = S_RESET
    return out


def boundaries(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a token (or a separator) begins at each code point."""
    n = len(points)
    rows = max(1, -(-n // BLOCK))
    grid = np.full(rows * BLOCK, S_RESET, np.uint8)
    grid[:n] = symbols(points, ends)
    base = np.ascontiguousarray(grid.reshape(rows, BLOCK).T).astype(np.intp) * STATES
    step, begins = STEP.ravel(), BEGINS.ravel()
    whole = np.tile(np.arange(STATES, dtype=np.uint8), (rows, 1))
    for column in base:  # the function of each block
        whole = step[column[:, None] + whole]
    span = 1
    while span < rows:  # compose by doubling: afterwards row i maps the state before row 0 to the state after row i
        whole[span:] = np.take_along_axis(whole[span:], whole[:-span].astype(np.intp), 1)
        span *= 2
    state = np.empty(rows, np.uint8)
    state[0], state[1:] = FRESH, whole[:-1, FRESH]
    out = np.empty((BLOCK, rows), bool)
    for k, column in enumerate(base):
        at = column + state
        out[k] = begins[at]
        state = step[at]
    return out.T.reshape(-1)[:n]


def slices(texts: list[str]) -> list[list[bytes]]:
    """The pre-tokenised pieces of each text, as UTF-8."""
    joined = "\n".join(texts) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    first = np.flatnonzero(boundaries(points, ends))
    width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    offset = np.concatenate([[0], np.cumsum(width)])
    places = offset[first].tolist()
    data = joined.encode()
    pieces = [data[s:e] for s, e in zip(places, [*places[1:], len(data)])]
    stops = np.searchsorted(first, ends).tolist()  # each separator begins a piece of its own
    return [pieces[s:e] for s, e in zip([0, *(e + 1 for e in stops)], stops)]


class Merges(dict):
    """piece -> its ids as little-endian unsigned 32-bit integers, in two bounded generations."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.old: dict[bytes, bytes] = {}

    def __missing__(self, piece: bytes) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            ids = array("I", self.merge(piece)).tobytes()
        if len(piece) <= CACHED_BYTES:
            if len(self) >= CACHE_PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def merge(self, piece: bytes) -> list[int]:
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        if len(piece) > SHORT_PIECE:
            return self.merge_long(piece)
        parts = [piece[k:k + 1] for k in range(len(piece))]
        none = len(ranks)
        pairs = [ranks.get(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            k = pairs.index(best)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del pairs[k]
            if k < len(pairs):
                pairs[k] = ranks.get(parts[k] + parts[k + 1], none)
            if k:
                pairs[k - 1] = ranks.get(parts[k - 1] + parts[k], none)
        return [ranks[p] for p in parts]

    def merge_long(self, piece: bytes) -> list[int]:
        """The same merges with a heap of (rank, place): n log n for any length."""
        ranks, n = self.ranks, len(piece)
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, k, k + 2) for k in range(n - 1) if (r := ranks.get(piece[k:k + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, k, stop = heapq.heappop(heap)
            right = after[k]
            if not alive[k] or right >= n or end[right] != stop:
                continue
            alive[right] = False
            end[k], after[k] = stop, after[right]
            if after[k] < n:
                before[after[k]] = k
                far = end[after[k]]
                if (r := ranks.get(piece[k:far])) is not None:
                    heapq.heappush(heap, (r, k, far))
            if before[k] >= 0:
                left = before[k]
                if (r := ranks.get(piece[left:stop])) is not None:
                    heapq.heappush(heap, (r, left, stop))
        return [ranks[piece[k:end[k]]] for k in range(n) if alive[k]]

    def encode(self, texts: list[str]) -> list[bytes]:
        get = self.__getitem__
        return [b"".join(map(get, pieces)) for pieces in slices(texts)]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))

    def offsets(self, ids: bytes) -> np.ndarray:
        """The byte offset of each token in the decoded text."""
        sizes = np.fromiter((len(self.tokens[i]) for i in memoryview(ids).cast("I")), np.int64)
        return np.cumsum(sizes) - sizes


_LOADED: dict[str, Merges] = {}


def loaded(path: str) -> Merges:
    if path not in _LOADED:
        _LOADED[path] = Merges(path)
    return _LOADED[path]


def _mapped(rows: DataFrame, fields: str, make) -> DataFrame:
    """``rows`` (key, value) through ``make(values) -> columns``, batch by batch; the key stays."""
    ship_package(rows.sparkSession)
    kind = rows.schema[0].dataType.simpleString()
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, rows=500, size=2_000_000):
            yield pa.RecordBatch.from_arrays([batch.column(0), *make(batch.column(1).to_pylist())], ["_id", *names])

    return rows.mapInArrow(run, f"_id {kind}, {fields}")


def encode_documents(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_tokens, ids`` (little-endian unsigned 32-bit) and ``offsets`` (byte offset of each
    token, little-endian 64-bit).

    A null text is empty and has no ids.  Repeated rows are encoded each.  Other columns are ignored.
    """

    def make(texts: list[str]) -> list[pa.Array]:
        bpe = loaded(ranks)
        ids = bpe.encode(texts)
        return [pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary()),
                pa.array([bpe.offsets(i).tobytes() for i in ids], pa.binary())]

    rows = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text"))
    return _mapped(rows, "n_tokens long, ids binary, offsets binary", make).withColumnRenamed("_id", id_col)


def decode_documents(encoded: DataFrame, ranks: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id and ``decoded`` bytes of ids that ``encode_documents`` made; null ids are empty."""

    def make(ids: list[bytes]) -> list[pa.Array]:
        return [pa.array([loaded(ranks).decode(i) for i in ids], pa.binary())]

    rows = encoded.select(F.col(id_col).alias("_id"), F.coalesce(ids_col, F.lit(b"")).alias("_ids"))
    return _mapped(rows, "decoded binary", make).withColumnRenamed("_id", id_col)


def round_trip(docs: DataFrame, ranks: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of encoding and decoding each text: id, ``n_tokens, ids_sha256, decoded_sha256``."""

    def make(texts: list[str]) -> list[pa.Array]:
        bpe = loaded(ranks)
        ids = bpe.encode(texts)
        return [pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                pa.array([hashlib.sha256(bpe.decode(i)).hexdigest() for i in ids])]

    rows = docs.select(F.col(id_col).alias("_id"), whole_text(text_col).alias("_text"))
    return _mapped(rows, "n_tokens long, ids_sha256 string, decoded_sha256 string", make).withColumnRenamed("_id", id_col)
