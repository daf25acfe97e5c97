"""Ranked search against a plain Python version."""

import math
import random
import re
from collections import Counter

import pytest

from candlewright.llm import search

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text):
    return re.findall(TERM, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plainly(docs, items, k=50):
    found = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    found = [(doc_id, c) for doc_id, c in found if c]
    total, length = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    rows = []
    for item_id, text in set(items):
        scored = []
        for doc_id, c in found:
            m = 100 - 50 + (50 * sum(c.values()) * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        rows += [(item_id, rank, doc_id, -minus) for rank, (minus, _, doc_id) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1)]
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    words = ["the", "The", "É", "é", "naïve", "日本", "x1", "42", "a", "A'b", "c-d", " ", "\x85z", "𝒳", "the the", "_", "of"]
    docs = [(k, rng.choice([" ", "\n", ", ", "\x00"]).join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for k in range(120)]
    docs += [(None, "the x1"), (None, None), (5, docs[5][1]), (7, "the x1"), (8, ""), (9, " ... "), (10, "w " * 30 + "the" * 50_000 + " the")]
    docs += [(11, "tail " * 300_000 + "42")]
    items = [(1, "The x1 the"), (2, "é, É naïve"), (3, None), (4, ""), (5, "none at all here"), (1, "The x1 the"), (1, "42"), (6, "the of a A'b c-d 日本 𝒳"), (None, "of")]
    return docs, items


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, 1, "z") for i, t in docs], "doc_id long, text string, score long, part string"),
        spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, rank int"),
    )


@pytest.mark.parametrize("k", [3, 50])
def test_equals_plain_version(spark, texts, k):
    docs, items = frames(spark, *texts)
    got = sorted(map(tuple, search.top_documents(docs.repartition(5), items, k).collect()), key=repr)
    assert got == plainly(*texts, k=k)


def test_blocks_of_items_change_nothing(spark, texts, monkeypatch):
    monkeypatch.setattr(search, "ITEMS", 2)
    monkeypatch.setattr(search, "TASKS", 2)
    docs, items = frames(spark, *texts)
    got = sorted(map(tuple, search.top_documents(docs.repartition(5), items).collect()), key=repr)
    assert got == plainly(*texts)


def test_small_pieces_and_cells(monkeypatch):
    counter = search.Counter(["a", "bb", "é"])
    text = "a bb,a É é bb-bb a".encode()
    whole = [x.tolist() if hasattr(x, "tolist") else x for x in counter.counts(text)]
    assert whole == [8, [0, 1, 2], [3, 3, 1]]
    cut = search.pieces
    monkeypatch.setattr(search, "pieces", lambda t: cut(t, 1))
    assert [x.tolist() if hasattr(x, "tolist") else x for x in counter.counts(text)] == whole


def test_empty_tables(spark, texts):
    docs, items = frames(spark, *texts)
    assert search.top_documents(docs.limit(0), items).count() == 0
    empty = search.top_documents(docs, items.limit(0))
    assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]
    blank = docs.where("text = ''")
    assert search.top_documents(blank, items).count() == 0
