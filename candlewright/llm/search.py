"""Ranked lexical search: an Aho-Corasick automaton of all item terms counts them in the text itself."""

import heapq
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewright.llm.common import per_worker

#: Separators are the ASCII characters other than letters and digits. Only A-Z are lower-cased.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLDED = bytes(
    byte + 32 if 65 <= byte <= 90 else byte if byte >= 128 or 48 <= byte <= 57 or 97 <= byte <= 122 else 32 for byte in range(256)
)
#: Items and bytes of item text in one automaton; more items are taken in blocks, each over all documents.
ITEMS, ITEM_BYTES = 20_000, 1 << 20
CELLS = 1 << 21  # of documents times items scored at a time
PIECE = 1 << 22  # bytes of a text scanned at a time
TASKS = 256  # whose best rows are ranked together first
SPACE = 32


def folded(text: bytes) -> bytes:
    return text.translate(FOLDED)


def pieces(text: bytes, size: int = PIECE):
    """A folded text cut at separators into pieces of about ``size``, a space before and after each."""
    at = 0
    while at < len(text):
        end = text.find(b" ", at + size)
        end = len(text) if end < 0 else end
        yield b" " + text[at:end] + b" "
        at = end


def terms_of(text: str) -> list[str]:
    """Different terms of an item, in order of their first place."""
    return list(dict.fromkeys(t.decode() for t in folded(text.encode()).split()))


class Counter:
    """Term counts of texts. Terms stand between spaces in the automaton, so it only finds whole ones."""

    def __init__(self, terms: list[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for k, term in enumerate(terms):
            self.automaton.add_word(f" {term} ", k)
        if terms:
            self.automaton.make_automaton()
        self.terms = len(terms)

    def counts(self, text: bytes):
        """(number of all terms, ids of the known ones, how often each occurs)."""
        size, found = 0, np.zeros(0, np.int64)
        for piece in pieces(folded(text)):
            blank = np.frombuffer(piece, np.uint8) == SPACE
            size += int((blank[:-1] & ~blank[1:]).sum())
            if self.terms:
                hits = np.fromiter((k for _, k in self.automaton.iter(piece.decode())), np.int64)
                found = np.concatenate([found, hits])
        ids, times = np.unique(found, return_counts=True)
        return size, ids, times


class Index:
    """Terms of a block of items and which items hold each."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = items
        number: dict[str, int] = {}
        held = [(number.setdefault(t, len(number)), k) for k, (_, text) in enumerate(items) for t in terms_of(text)]
        self.terms = list(number)
        held.sort()
        self.item = np.array([k for _, k in held], np.int64)
        self.start = np.searchsorted([t for t, _ in held], np.arange(len(self.terms) + 1))


class Best:
    """The ``k`` best documents of each item so far, better ones with a smaller key."""

    def __init__(self, k: int):
        self.k, self.heaps = k, {}

    def add(self, item: int, score: int, last: bool, doc_id: int):
        heap = self.heaps.setdefault(item, [])
        entry = (score, not last, -doc_id)
        if len(heap) < self.k:
            heapq.heappush(heap, entry)
        elif entry > heap[0]:
            heapq.heapreplace(heap, entry)

    def least(self, items: int) -> np.ndarray:
        """The score below which a document cannot enter."""
        out = np.ones(items, np.int64)
        for item, heap in self.heaps.items():
            if len(heap) == self.k:
                out[item] = heap[0][0]
        return out


def _batches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")).where("text IS NOT NULL")


def _statistics(docs: DataFrame, shared, name: str):
    """N, L and the document frequency of each term: one small row a term and task."""

    def count(batches):
        index = shared.value
        counter = per_worker(name, lambda: Counter(index.terms))
        frequency = np.zeros(len(index.terms) + 2, np.int64)
        for batch in batches:
            for text in batch.column(1):
                size, ids, _ = counter.counts(text.as_py())
                frequency[ids] += 1
                frequency[-2] += size > 0
                frequency[-1] += size
        kept = np.flatnonzero(frequency)
        yield pa.record_batch([pa.array(kept), pa.array(frequency[kept])], names=["term", "n"])

    found = docs.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    n = np.zeros(len(shared.value.terms) + 2, np.int64)
    for row in found:
        n[row.term] = row.n
    return int(n[-2]), int(n[-1]), n[:-2]


def weights(total: int, frequency: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(df) + 1))) for df in frequency], np.int64)


def top_documents(docs: DataFrame, items: DataFrame, k: int = 50, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text") -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``k`` highest-scoring documents with a score above 0.

    The score is a whole-number form of BM25 over the item's different terms. Every row of ``docs`` is a
    document, also a repeated one or one without an id (last among equal scores); null texts and texts without a
    term are none. Items alike in id and text count once; different texts under one id are items of
    their own; null item texts have no terms and so no rows. No documents or no items give no rows.

    Items are taken in blocks of at most about ``ITEMS`` items and ``ITEM_BYTES`` of text, which bounds the
    automaton and what is broadcast. For each block the documents are read twice: for the statistics,
    then for the scores. A task sends on ``k`` rows an item at most.
    """
    texts = _batches(docs, id_col, text_col)
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text")).where("text IS NOT NULL").distinct()
    n_items, n_bytes = asked.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n_items // ITEMS), -(-n_bytes // ITEM_BYTES))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    parts = [_block(texts, [(r.item_id, r.text) for r in asked.where(block == b).orderBy("item_id", "text").collect()], k) for b in range(blocks)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _block(texts: DataFrame, items: list[tuple[int, str]], k: int) -> DataFrame:
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(Index(items))
    name = f"automaton {spark.sparkContext.applicationId} {shared._jbroadcast.id()}"
    total, length, frequency = _statistics(texts, shared, name)
    weight = weights(total, frequency)

    def score(batches):
        index = shared.value
        counter = per_worker(name, lambda: Counter(index.terms))
        best, width = Best(k), len(index.items)
        strip = max(1, CELLS // max(1, width))
        held = []

        def settle():
            if not held:
                return
            cells = np.concatenate([h[1] for h in held])
            parts = np.concatenate([h[2] for h in held])
            # Sums below 2^53 are whole in doubles; larger ones are added as integers.
            if len(parts) and parts.sum(dtype=float) < 2.0**53:
                scores = np.bincount(cells, weights=parts, minlength=len(held) * width).astype(np.int64)
            else:
                scores = np.zeros(len(held) * width, np.int64)
                np.add.at(scores, cells, parts)
            scores = scores.reshape(len(held), width)
            for at, item in np.argwhere(scores >= best.least(width)[None, :]).tolist():
                doc_id = held[at][0]
                best.add(item, int(scores[at, item]), doc_id is None, doc_id or 0)
            held.clear()

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc_id, text in zip(ids, batch.column(1), strict=True):
                size, found, times = counter.counts(text.as_py())
                if not len(found):
                    continue
                m = 100 - 50 + (50 * size * total) // length
                part = weight[found] * ((1000000000 * times) // (1000 * times + 20 * m))
                first, n = index.start[found], index.start[found + 1] - index.start[found]
                # The items of all found terms, run after run.
                runs = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
                held.append((doc_id, index.item[runs] + len(held) * width, np.repeat(part, n)))
                if len(held) == strip:
                    settle()
        settle()
        rows = [(*index.items[item], score, None if not known else -minus) for item, heap in best.heaps.items() for score, known, minus in heap]
        for a in range(0, len(rows), 4096):
            columns = zip(*rows[a:a + 4096], strict=True)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=["item_id", "text", "score", "doc_id"])

    found = texts.mapInArrow(score, "item_id long, text string, score long, doc_id long")
    # Two steps, so that the last ranking of an item reads k rows for every TASKS tasks.
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    found = found.withColumn("part", F.expr(f"spark_partition_id() div {TASKS}"))
    near = found.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "text", "part").orderBy(*order))).where(F.col("rank") <= k)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "text").orderBy(*order)))
    return ranked.where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
