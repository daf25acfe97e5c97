"""Byte-level BPE: automaton scans find the slices, cached pair merging encodes them."""

import base64
import heapq
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.llm.common import per_worker

# The symbols a text is turned into, one per code point. A blank is LAST when a non-blank follows it.
OTHER, LETTER, NUMBER, SPACE_LAST, BLANK_LAST, BLANK, SHORT, LONG = range(8)
# What the slice up to a code point is: a run, a space that may open one, a contraction with one or
# two letters to come, or closed.
IN_LETTERS, IN_NUMBERS, IN_OTHER, OPENED, IN_BLANKS, ONE_MORE, TWO_MORE, CLOSED = range(8)

# The characters of the pattern's \s, and its contractions after the apostrophe.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0            "
    "    　"
)
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

CHUNK = 1 << 20  # code points scanned at a time
WIDTH = 256  # code points a block of the scan holds
CACHED_LENGTH = 64
SHORT_SLICE = 48
CACHED_SLICES = 1 << 20


def step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a new slice starts at the symbol."""
    fresh = (IN_OTHER, IN_LETTERS, IN_NUMBERS, OPENED, CLOSED, IN_BLANKS, ONE_MORE, TWO_MORE)[symbol]
    if state == TWO_MORE:
        return ONE_MORE, False
    if state == ONE_MORE:
        return CLOSED, False
    if symbol in (OTHER, SHORT, LONG) and state in (IN_OTHER, OPENED):
        return IN_OTHER, False
    if fresh == state and state in (IN_LETTERS, IN_NUMBERS, IN_BLANKS):
        return state, False
    if state == OPENED and symbol in (LETTER, NUMBER):
        return fresh, False
    return fresh, True


class Scanner:
    """Slice starts of texts laid end to end.

    A symbol is a function from state to state. The functions that arise by chaining them are few, so
    each gets a number and chaining becomes a table lookup; as chaining is associative, blocks are
    chained side by side, then the blocks' totals, and last the state before each code point is read.
    """

    def __init__(self):
        symbols = [tuple(step(s, x)[0] for s in range(8)) for x in range(8)]
        symbols += [(step(CLOSED, x)[0],) * 8 for x in range(8)]  # first of a text: what was before is over
        known = {tuple(range(8)): 0}
        functions = [tuple(range(8))]
        for f in functions:
            for g in symbols:
                if (h := tuple(g[s] for s in f)) not in known:
                    known[h] = len(functions)
                    functions.append(h)
        self.of_symbol = np.array([known[f] for f in symbols], np.int16)
        self.chain = np.array([[known[tuple(g[s] for s in f)] for g in functions] for f in functions], np.int16)
        self.apply = np.array(functions, np.int8)
        self.cuts = np.array([[step(s, x)[1] for x in range(8)] + [True] * 8 for s in range(8)])
        kinds = np.full(0x110000, OTHER, np.int8)
        heads = np.frombuffer("".join(unicodedata.category(chr(c))[0] for c in range(0x110000)).encode(), np.uint8)
        kinds[heads == ord("L")] = LETTER
        kinds[heads == ord("N")] = NUMBER
        kinds[[ord(c) for c in WHITE_SPACE]] = BLANK
        self.kinds = kinds

    def symbols(self, points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        found = self.kinds[points].copy()
        ends = np.zeros(len(points) + 1, bool)
        ends[firsts] = True
        ends[-1] = True
        blank = found == BLANK
        last = blank & ~np.append(blank[1:], True) & ~ends[1:]
        found[last] = BLANK_LAST
        found[last & (points == 32)] = SPACE_LAST
        quotes = np.flatnonzero(points == 39)
        padded = np.append(points, [0, 0])
        for tail in CONTRACTIONS:
            hit = quotes[~ends[quotes + 1]]
            hit = hit[padded[hit + 1] == ord(tail[0])]
            if len(tail) == 2:
                hit = hit[~ends[hit + 2]]
                hit = hit[padded[hit + 2] == ord(tail[1])]
            found[hit] = SHORT if len(tail) == 1 else LONG
        found[firsts] += 8
        return found

    def prefixes(self, functions: np.ndarray) -> np.ndarray:
        """The chain of the functions up to and including each."""
        n = len(functions)
        if n <= WIDTH:
            out = functions.copy()
            for i in range(1, n):
                out[i] = self.chain[out[i - 1], out[i]]
            return out
        rows = -(-n // WIDTH)
        grid = np.zeros(rows * WIDTH, np.int16)
        grid[:n] = functions
        grid = np.ascontiguousarray(grid.reshape(rows, WIDTH).T)
        for k in range(1, WIDTH):
            grid[k] = self.chain[grid[k - 1], grid[k]]
        before = np.zeros(rows, np.int16)
        before[1:] = self.prefixes(grid[-1])[:-1]
        return self.chain[before[None, :], grid].T.reshape(-1)[:n]

    def starts(self, points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        symbols = self.symbols(points, firsts)
        before = np.zeros(len(points), np.int16)
        before[1:] = self.prefixes(self.of_symbol[symbols])[:-1]
        return np.flatnonzero(self.cuts[self.apply[before, CLOSED], symbols])


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a slice: again and again the adjacent pair of least rank, leftmost first, is joined."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    return _merge_short(piece, ranks) if n <= SHORT_SLICE else _merge_long(piece, ranks)


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """By a look at all pairs for each join."""
    none = 1 << 62
    parts = [piece[i:i + 1] for i in range(len(piece))]
    pairs = [ranks.get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
    while pairs and (least := min(pairs)) != none:
        i = pairs.index(least)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
    return [ranks[part] for part in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """By a heap of pairs over a linked list."""
    n = len(piece)
    after, before = list(range(1, n + 2)), list(range(-1, n + 1))
    heap = []

    def offer(left):
        mid = after[left]
        if mid < n and (rank := ranks.get(piece[left:after[mid]])) is not None:
            heapq.heappush(heap, (rank, left, mid, after[mid]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, left, mid, end = heapq.heappop(heap)
        if after[left] != mid or after[mid] != end:
            continue
        after[left], before[end], after[mid] = end, left, -1
        offer(left)
        if left:
            offer(before[left])
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at:after[at]]])
        at = after[at]
    return out


class Encoder:
    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.scanner = Scanner()
        self.cache: dict[str, bytes] = {}
        size = max(self.ranks.values()) + 1
        self.lengths = np.zeros(size, np.int64)
        self.places = np.zeros(size, np.int64)
        at, parts = 0, []
        for token, rank in self.ranks.items():
            self.lengths[rank], self.places[rank] = len(token), at
            at += len(token)
            parts.append(token)
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)

    def missing(self, piece: str) -> bytes:
        if ids := self.cache.get(piece):
            return ids
        ids = array("I", merge(piece.encode(), self.ranks)).tobytes()
        if len(piece) <= CACHED_LENGTH:
            if len(self.cache) >= CACHED_SLICES:
                self.cache.clear()
            self.cache[piece] = ids
        return ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and where each text's begin (one more entry than texts)."""
        whole = "".join(texts)
        edges = np.cumsum([0, *map(len, texts)])
        if not whole:
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        starts = self.scanner.starts(points, np.unique(edges[:-1][edges[:-1] < len(points)]))
        at = starts.tolist()
        pieces = [whole[a:b] for a, b in zip(at, [*at[1:], len(whole)], strict=True)]
        coded = list(map(self.cache.get, pieces))
        if None in coded:
            coded = [ids or self.missing(piece) for piece, ids in zip(pieces, coded, strict=True)]
        ids = np.frombuffer(b"".join(coded), "<u4")
        counts = np.zeros(len(coded) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)) // 4, out=counts[1:])
        return ids, counts[np.searchsorted(starts, edges)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray, base: np.ndarray, total: int) -> np.ndarray:
        """Bytes of the ids, each put at its text's base plus its offset."""
        lengths = self.lengths[ids]
        out = np.zeros(total, np.uint8)
        end = np.cumsum(lengths)
        inside = np.arange(end[-1] if len(end) else 0) - np.repeat(end - lengths, lengths)
        out[np.repeat(base + offsets, lengths) + inside] = self.bytes[np.repeat(self.places[ids], lengths) + inside]
        return out


def _chunks(texts: list[str]):
    """Index ranges of about CHUNK code points."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK:
            yield start, i
            start, size = i, 0
        size += len(text)
    if texts:
        yield start, len(texts)


def encode(docs: DataFrame, vocabulary: str, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id long, ids array<int>, offsets array<int>) of every whole text; null counts as empty.

    ``offsets`` holds the byte at which each id's bytes begin in the UTF-8 text: decoding, also of a
    range of ids, places them by it. ``vocabulary`` is a rank file that every executor can open. No
    special tokens. Rows are independent: nothing is shuffled, repeated rows give equal rows, other
    columns are not read. An empty text has no ids.
    """

    def rows(batches):
        coder = per_worker(f"bpe {vocabulary}", lambda: Encoder(vocabulary))
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in _chunks(texts):
                ids, edges = coder.encode(texts[a:b])
                ends = np.cumsum(coder.lengths[ids])
                begins = ends - coder.lengths[ids]
                base = np.append(ends, 0)[edges[:-1] - 1] * (edges[:-1] > 0)
                edges32 = pa.array(edges.astype(np.int32))
                offsets = (begins - np.repeat(base, np.diff(edges))).astype(np.int32)
                yield pa.record_batch(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.ListArray.from_arrays(edges32, pa.array(ids.astype(np.int32))),
                        pa.ListArray.from_arrays(edges32, pa.array(offsets)),
                    ],
                    names=["doc_id", "ids", "offsets"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        rows, "doc_id long, ids array<int>, offsets array<int>"
    )


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encode``'s rows with ``decoded`` (binary) in place of ``offsets``."""

    def rows(batches):
        coder = per_worker(f"bpe {vocabulary}", lambda: Encoder(vocabulary))
        for batch in batches:
            for a in range(0, len(batch), 256):
                part = batch.slice(a, 256)
                lists, at = part.column(1), part.column(2)
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                offsets = at.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                ends = np.cumsum(counts)
                sizes = np.zeros(len(counts), np.int64)
                full = counts > 0
                last = ends[full] - 1
                sizes[full] = offsets[last] + coder.lengths[ids[last]]
                edges = np.concatenate([[0], np.cumsum(sizes)])
                out = coder.decode(ids, offsets, np.repeat(edges[:-1], counts), int(edges[-1]))
                decoded = pa.Array.from_buffers(
                    pa.large_binary(), len(part), [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(out)]
                ).cast(pa.binary())
                yield pa.record_batch([part.column(0), lists, decoded], names=["doc_id", "ids", "decoded"])

    return encoded.mapInArrow(rows, "doc_id long, ids array<int>, decoded binary")
