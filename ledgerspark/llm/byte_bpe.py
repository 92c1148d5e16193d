"""Byte-level BPE by ranks, encoding and decoding, over arrays.

Pre-tokenisation needs no regular expression. Each code point has a class; with a look at
the next ones it becomes a symbol of a small automaton whose state says what the current
piece is. Each symbol is a function from states to states; functions compose, and the
compositions form a finite set, so that one table lookup composes two of them. Prefix
compositions over a whole batch are then an associative scan over numbers, and the state
before each code point says where pieces begin. Distinct pieces are merged once and cached.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.pieces import IdTable, ragged, slices
from ledgerspark.llm.text import whole_text

# Classes of code points.
OTHER, LETTER, NUMBER, WHITE, SPACE = range(5)
# White space beyond categories: the Unicode property White_Space (fixed values).
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
# Symbols: the class, and for white space and apostrophes what follows.
S_OTHER, S_LETTER, S_NUMBER, S_WHITE_LAST, S_WHITE_MORE, S_SPACE_LAST, S_SPACE_MORE, S_ONE, S_TWO = range(9)
# States: nothing may be continued; in white space; after a space that opens a piece; in
# letters, numbers, others; in a contraction with one or two letters to come.
BEGIN, IN_WHITE, AFTER_SPACE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE_LEFT, TWO_LEFT = range(8)
N_STATES, N_SYMBOLS = 8, 9


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether a piece begins at this symbol."""
    if state == TWO_LEFT:
        return ONE_LEFT, False
    if state == ONE_LEFT:
        return BEGIN, False
    if symbol in (S_LETTER, S_NUMBER):
        run = IN_LETTERS if symbol == S_LETTER else IN_NUMBERS
        return run, state not in (run, AFTER_SPACE)
    if symbol in (S_OTHER, S_ONE, S_TWO):
        if state in (IN_OTHERS, AFTER_SPACE):
            return IN_OTHERS, False
        return {S_OTHER: IN_OTHERS, S_ONE: ONE_LEFT, S_TWO: TWO_LEFT}[symbol], True
    # The last of a run stands apart from the run: a space opens the next piece, any other
    # is a piece of its own. A run at the end of the text has no such last one.
    if symbol == S_SPACE_LAST:
        return AFTER_SPACE, True
    if symbol == S_WHITE_LAST:
        return BEGIN, True
    return IN_WHITE, state != IN_WHITE


class Automaton:
    """Tables of the automaton and of the composition of its transition functions."""

    def __init__(self) -> None:
        step = [[_step(q, s) for s in range(N_SYMBOLS)] for q in range(N_STATES)]
        self.begins = np.array([[b for _, b in row] for row in step]).ravel()
        # A symbol's function; and as first symbol of a text, where the state is forgotten.
        generators = [tuple(step[q][s][0] for q in range(N_STATES)) for s in range(N_SYMBOLS)]
        generators += [(step[BEGIN][s][0],) * N_STATES for s in range(N_SYMBOLS)]
        identity = tuple(range(N_STATES))
        number = {identity: 0}
        queue = [identity]
        for f in queue:
            for g in generators:
                h = tuple(g[q] for q in f)
                if h not in number:
                    number[h] = len(number)
                    queue.append(h)
        functions = np.array(queue, np.uint8)
        self.size = len(queue)
        self.generator = np.array([number[g] for g in generators], np.uint16)
        self.act = functions.ravel()  # function * N_STATES + state
        self.compose = np.array(
            [[number[tuple(g[f])] for g in functions] for f in functions], np.uint16
        ).ravel()  # first * size + second

    def prefix(self, functions: np.ndarray, width: int = 64) -> np.ndarray:
        """Composition of all functions up to and with each one.

        Rows of ``width`` are scanned side by side, then their totals in the same way, and
        each row is composed with what stands before it.
        """
        n = len(functions)
        if n <= 64:
            out = functions.copy()
            for i in range(1, n):
                out[i] = self.compose[int(out[i - 1]) * self.size + int(functions[i])]
            return out
        rows = -(-n // width)
        padded = np.zeros(rows * width, np.uint16)  # 0 is the identity
        padded[:n] = functions
        grid = np.ascontiguousarray(padded.reshape(rows, width).T)
        for j in range(1, width):
            grid[j] = self.compose[grid[j - 1].astype(np.int32) * self.size + grid[j]]
        before = np.zeros(rows, np.uint16)
        before[1:] = self.prefix(grid[-1, :-1], width)
        grid = self.compose[before.astype(np.int32)[None, :] * self.size + grid]
        return grid.T.ravel()[:n]


@lru_cache(1)
def automaton() -> Automaton:
    return Automaton()


@lru_cache(1)
def classes() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            table[c] = LETTER
        elif kind == "N":
            table[c] = NUMBER
    table[list(WHITE_SPACE)] = WHITE
    table[0x20] = SPACE
    return table


def piece_starts(text: str, lengths: np.ndarray) -> np.ndarray:
    """Places in the joined text at which pieces begin; ``lengths`` of the texts in it.

    Pieces are those of the public pattern: contractions ``'s 't 're 've 'm 'll 'd``, runs
    of letters, of numbers or of others with a space before them, and white space.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    kind = classes()[points]
    ends = np.cumsum(lengths)
    white = kind >= WHITE
    goes_on = np.zeros(n, bool)  # something other than white space follows
    goes_on[:-1] = ~white[1:]
    goes_on[ends[lengths > 0] - 1] = False
    symbol = kind.copy()
    symbol[kind == WHITE] = S_WHITE_MORE
    symbol[kind == SPACE] = S_SPACE_MORE
    symbol[(kind == WHITE) & goes_on] = S_WHITE_LAST
    symbol[(kind == SPACE) & goes_on] = S_SPACE_LAST
    marks = np.flatnonzero(points == 0x27)
    if len(marks):
        text_end = ends[np.searchsorted(ends, marks, "right")]
        at = np.zeros((2, len(marks)), np.uint32)
        for d in (1, 2):
            inside = marks + d < text_end
            at[d - 1, inside] = points[marks[inside] + d]
        one = np.isin(at[0], [ord(c) for c in "stmd"])
        two = np.zeros(len(marks), bool)
        for a, b in ("re", "ve", "ll"):
            two |= (at[0] == ord(a)) & (at[1] == ord(b))
        symbol[marks[one]] = S_ONE
        symbol[marks[two]] = S_TWO
    machine = automaton()
    code = symbol.astype(np.int32)
    first = (ends - lengths)[lengths > 0]
    code[first] += N_SYMBOLS
    done = machine.prefix(machine.generator[code])
    before = np.zeros(n, np.int32)
    before[1:] = machine.act[done[:-1].astype(np.int32) * N_STATES + BEGIN]
    before[first] = BEGIN
    return np.flatnonzero(machine.begins[before * N_SYMBOLS + symbol])


def load_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: base64 of the token and its rank per line."""
    with open(path, "rb") as file:
        pairs = (line.split() for line in file if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: the adjacent pair of lowest rank, leftmost first, is joined until none has a rank.

    Neighbours are linked and pairs wait in a heap, so a piece of n bytes takes n log n steps.
    """
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that begins here
    left = list(range(-1, n - 1))
    alive = [True] * n
    heap = []
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    while heap:
        rank, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not alive[i] or middle >= n or end[middle] != stop:
            continue  # one of the parts has grown meanwhile
        alive[middle] = False
        end[i] = stop
        if stop < n:
            left[stop] = i
            joined = ranks.get(piece[i : end[stop]])
            if joined is not None:
                heapq.heappush(heap, (joined, i, end[stop]))
        j = left[i]
        if j >= 0:
            joined = ranks.get(piece[j:stop])
            if joined is not None:
                heapq.heappush(heap, (joined, j, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class _Cache(dict):
    """Piece -> number in the table; merges what it does not know."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks, self.table = ranks, IdTable()

    def __missing__(self, piece: str) -> int:
        self[piece] = number = self.table.add_one(merge(piece.encode(), self.ranks))
        return number


class ByteBpe:
    """Encodes and decodes batches of texts with the ranks of a file."""

    def __init__(self, path: str, max_pieces: int = 400_000, max_ids: int = 8_000_000) -> None:
        self.ranks = load_ranks(path)
        self.max_pieces, self.max_ids = max_pieces, max_ids
        self.cache = _Cache(self.ranks)
        size = max(self.ranks.values()) + 1
        self.token_length = np.zeros(size, np.int64)
        by_id = sorted((i, token) for token, i in self.ranks.items())
        for i, token in by_id:
            self.token_length[i] = len(token)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.token_bytes = np.frombuffer(b"".join(token for _, token in by_id), np.uint8)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of ids of each."""
        if len(self.cache) > self.max_pieces or self.cache.table.used > self.max_ids:
            self.cache = _Cache(self.ranks)
        lengths = np.array([len(t) for t in texts], np.int64)
        joined = "".join(texts)
        starts = piece_starts(joined, lengths)
        cuts = starts.tolist()
        numbers = list(
            map(self.cache.__getitem__, [joined[a:b] for a, b in zip(cuts, [*cuts[1:], len(joined)])])
        )
        ids, sizes = self.cache.table.gather(np.array(numbers, np.int64))
        ends = np.cumsum(lengths)
        bounds = np.searchsorted(starts, np.concatenate([[0], ends]), "left")
        totals = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(totals[bounds])

    def offsets(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """First byte of each token within its text."""
        lengths = self.token_length[ids]
        before = np.cumsum(lengths) - lengths
        ends = np.cumsum(counts)
        return before - np.repeat(before[np.minimum(ends - counts, max(len(ids) - 1, 0))], counts) if len(ids) else before

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """Bytes of each text from its ids."""
        lengths = self.token_length[ids]
        data = self.token_bytes[ragged(self.token_start[ids], lengths)].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
        return [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


_CODERS: dict[str, ByteBpe] = {}


def coder(path: str) -> ByteBpe:
    if path not in _CODERS:
        _CODERS[path] = ByteBpe(path)
    return _CODERS[path]


def byte_bpe(docs: DataFrame, ranks: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids, offsets (first byte of each token) for every row.

    A null or empty text has no ids. Rows are encoded one by one: repeated rows and null
    ids give a row each; further columns are ignored; an empty table gives none. No special
    tokens: their strings are ordinary text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(ranks)
        for batch in batches:
            texts = batch.column("body").to_pylist()
            for a, b in slices(texts, 500_000):
                ids, counts = bpe.encode(texts[a:b])
                bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(values.astype(np.int32)))
                    for values in (ids, bpe.offsets(ids, counts))
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), *lists], ["doc_id", "ids", "offsets"]
                )

    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("body"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, offsets array<int>")


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """doc_id, content (the bytes) from doc_id and ids; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(ranks)
        for batch in batches:
            lists = batch.column("ids").to_pylist()
            counts = np.array([len(x or ()) for x in lists], np.int64)
            ids = np.array([i for x in lists for i in x or ()], np.int64)
            content = [
                None if x is None else b for x, b in zip(lists, bpe.decode(ids, counts))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(content, pa.binary())], ["doc_id", "content"]
            )

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, content binary")


def round_trip_digests(
    docs: DataFrame, ranks: str, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: :func:`byte_bpe` and back, as digests.

    Encodes and decodes in one pass, so that ids and bytes stay within the task. Nulls,
    empty texts and repeated rows as in :func:`byte_bpe`.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(ranks)
        for batch in batches:
            texts = batch.column("body").to_pylist()
            for a, b in slices(texts, 500_000):
                ids, counts = bpe.encode(texts[a:b])
                content = bpe.decode(ids, counts)
                data = memoryview(ids.astype("<u4").tobytes())
                ends = np.concatenate([[0], np.cumsum(counts)]) * 4
                digests = [
                    hashlib.sha256(data[x:y]).hexdigest()
                    for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array(counts),
                        pa.array(digests),
                        pa.array([hashlib.sha256(c).hexdigest() for c in content]),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("body"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
