"""Documents packed into token windows by multiway differencing."""

import heapq
import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.llm.common import per_worker

WINDOW = 4096
GROUP_WINDOWS = 384  # windows balanced against each other
CACHED_WORDS = 1 << 20
TEXTS = 256  # encoded together
RUN = 256  # new words encoded as one text, a separator between them
SEPARATOR = "|"


class WordTokenizer:
    """Ids of whole texts, word by word.

    The tokenizer drops white space and never looks across it, so the words between ASCII blanks are
    encoded once each; all else (case, Unicode forms, other blanks, its pattern) is left to it.
    """

    def __init__(self, path: str, special_as_text: bool = True):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.cache: dict[bytes, bytes] = {}
        self.separator = self.tokenizer.encode(SEPARATOR, add_special_tokens=False).ids
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]

    def coded(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word. A text of many words costs less than as many texts.

        Words that hold the separator or a special token, which may reach beyond its word, and runs that do
        not come apart into as many words are encoded one by one.
        """
        out: dict[bytes, bytes] = {}
        texts = [w.decode() for w in words]
        plain = [k for k, t in enumerate(texts) if SEPARATOR not in t and not any(s in t for s in self.special)]
        runs = [plain[a:a + RUN] for a in range(0, len(plain), RUN)] if len(self.separator) == 1 else []
        joined = [f" {SEPARATOR} ".join(texts[k] for k in run) for run in runs]
        for run, code in zip(runs, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
            ids = np.array(code.ids, "<u4")
            cuts = np.flatnonzero(ids == self.separator[0])
            if len(cuts) == len(run) - 1:
                data = ids.tobytes()
                starts, ends = [0, *(4 * cuts + 4).tolist()], [*(4 * cuts).tolist(), len(data)]
                out.update((words[k], data[a:b]) for k, a, b in zip(run, starts, ends, strict=True))
        rest = [k for k, w in enumerate(words) if w not in out]
        single = self.tokenizer.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False)
        out.update((words[k], np.array(c.ids, "<u4").tobytes()) for k, c in zip(rest, single, strict=True))
        return [out[w] for w in words]

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [text.split() for text in texts]
        new = list(set().union(*split).difference(self.cache))
        if new:
            if len(self.cache) > CACHED_WORDS:
                self.cache.clear()
                new = list(set().union(*split))
            self.cache.update(zip(new, self.coded(new), strict=True))
        return [b"".join(map(self.cache.__getitem__, words)) for words in split]


def differencing(sizes: np.ndarray, windows: int) -> list[list[int]]:
    """Items of each window after Karmarkar-Karp differencing into ``windows`` parts.

    Every item starts as a partial partition: itself and empty parts. The two partitions of widest
    spread are merged, the largest part of one with the smallest of the other, until one is left.
    Parts are nodes of a forest whose leaves are the items.
    """
    left, right = [], []
    count = len(sizes)
    parts, heap = {}, []
    for i in np.argsort(-sizes, kind="stable").tolist():
        heap.append((-int(sizes[i]), len(heap), i))
    heapq.heapify(heap)
    serial = len(heap)

    def opened(key):
        if key in parts:
            return parts.pop(key)
        return np.array([sizes[key]], np.int64), np.array([key], np.int64)

    while len(heap) > 1:
        big, big_nodes = opened(heapq.heappop(heap)[2])
        more, more_nodes = opened(heapq.heappop(heap)[2])
        if len(big) < len(more):
            big, big_nodes, more, more_nodes = more, more_nodes, big, big_nodes
        # Parts are kept from large to small, empty ones left out: the smallest of one are its empty ones.
        room = windows - len(big)
        free = min(room, len(more))
        shared = len(more) - free
        sums, nodes = big.copy(), big_nodes.copy()
        if shared:
            tail = slice(len(big) - shared, len(big))
            sums[tail] += more[free:][::-1]
            made = count + len(left) + np.arange(shared)
            left.extend(nodes[tail].tolist())
            right.extend(more_nodes[free:][::-1].tolist())
            nodes[tail] = made
        sums, nodes = np.concatenate([sums, more[:free]]), np.concatenate([nodes, more_nodes[:free]])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        key = count + serial
        spread = int(sums[0]) - (int(sums[-1]) if len(sums) == windows else 0)
        parts[key] = sums, nodes
        heapq.heappush(heap, (-spread, serial, key))
        serial += 1
    out = []
    for root in opened(heap[0][2])[1].tolist() if heap else []:
        items, stack = [], [root]
        while stack:
            node = stack.pop()
            if node < count:
                items.append(node)
            else:
                stack += [left[node - count], right[node - count]]
        out.append(sorted(items))
    return out



def windows_of(sizes: np.ndarray, capacity: int = WINDOW) -> list[list[int]]:
    """Near-equal windows of at most ``capacity``: one more window whenever one would exceed it."""
    if not len(sizes):
        return []
    count = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        found = differencing(sizes, count)
        over = max(int(sizes[w].sum()) for w in found) - capacity
        if over <= 0:
            return found
        count += max(1, over * count // capacity)


def cut(length: int, capacity: int, filler: int) -> list[tuple[int, int]]:
    """(start, length) pieces of a document: full windows, then its rest, cut where it gives a filler."""
    pieces = [(at, min(capacity, length - at)) for at in range(0, length, capacity)]
    at, rest = pieces[-1]
    if filler and rest > 2 * filler:
        pieces[-1:] = [(at, rest - filler), (at + rest - filler, filler)]
    return pieces


def pack(
    docs: DataFrame, tokenizer: str, id_col="doc_id", text_col="text", capacity: int = WINDOW, end_id: int = 2, group_windows: int = GROUP_WINDOWS,
    special_as_text: bool = True,
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``capacity`` tokens.

    Columns: doc_id, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset. A document is its tokens and ``end_id``; a null text counts as empty and has
    just that id. Tasks take documents until they have ``group_windows`` windows' worth of tokens,
    cut off full windows and balance the rest over near-equal windows, so memory is bounded by a
    group plus one document and nothing is shuffled. Sequence ids hold the task's partition number.
    ``tokenizer`` is a file that every executor can open. With ``special_as_text`` the strings of special
    tokens are ordinary text; without it they get their ids, as from the library's defaults. Repeated rows are packed as often as they
    occur; other columns are not read; an empty table gives no pieces.
    """

    def rows(batches):
        coder = per_worker(f"words {special_as_text} {tokenizer}", lambda: WordTokenizer(tokenizer, special_as_text))
        end = np.array([end_id], "<u4").tobytes()
        sequence = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        held, total = [], 0

        def packed():
            nonlocal sequence
            pieces = []
            for k, (_, ids) in enumerate(held):
                filler = 64 if k % 4 == 0 else 0
                pieces += [(k, *piece) for piece in cut(len(ids) // 4, capacity, filler)]
            sizes = np.array([p[2] for p in pieces], np.int64)
            full = np.flatnonzero(sizes == capacity)
            rest = np.flatnonzero(sizes < capacity)
            windows = [[int(i)] for i in full] + [[int(rest[i]) for i in w] for w in windows_of(sizes[rest], capacity)]
            out = []
            for window in windows:
                at = 0
                for i in window:
                    k, start, length = pieces[i]
                    doc_id, ids = held[k]
                    out.append((doc_id, start, length, ids[4 * start:4 * (start + length)], len(ids) // 4, sequence, at))
                    at += length
                sequence += 1
            for a in range(0, len(out), 4096):
                columns = zip(*out[a:a + 4096], strict=True)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
                yield pa.record_batch(
                    [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                    names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
                )

        for batch in batches:
            for a in range(0, len(batch), TEXTS):
                part = batch.slice(a, TEXTS)
                texts = [t or b"" for t in part.column(1).to_pylist()]
                for doc_id, ids in zip(part.column(0).to_pylist(), coder.ids(texts), strict=True):
                    held.append((doc_id, ids + end))
                    total += len(ids) // 4 + 1
                    if total >= group_windows * capacity:
                        yield from packed()
                        held, total = [], 0
        if held:
            yield from packed()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        rows, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    )
