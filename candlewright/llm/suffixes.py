"""Repeated passages, byte by byte: difference-cover suffix sorting of the text that may repeat."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.llm.common import row_key, thinned, untouched
from candlewright.session import stored

LENGTH = 200  # bytes of a repeated string
GRAM = 96  # bytes of the substring that names a window's class
SLICE = 1 << 18  # bytes of a document scanned at a time
BUCKET = 1 << 19  # bytes of text sorted at a time
CLASS_LIMIT = 1 << 19  # bytes of one class's contexts; beyond it windows are counted as rows

_numbers = np.random.default_rng(20_240_101)
BYTE_CODES = _numbers.integers(1, 1 << 63, 256, dtype=np.uint64)
FACTORS = _numbers.integers(1 << 62, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)


def _mixed(left: np.ndarray, right: np.ndarray, level: int) -> np.ndarray:
    out = left * FACTORS[level] + right
    out ^= out >> np.uint64(29)
    return out


def _grams(text: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` (64 to 128) bytes from each place on."""
    out, size = BYTE_CODES[text], 1
    level = 0
    while size < 64:
        out, size, level = _mixed(out[:-size], out[size:], level), 2 * size, level + 1
    return out if length == 64 else _mixed(out[: len(out) - (length - 64)], out[length - 64 :], 7)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        values, size = np.minimum(values[:-size], values[size:]), 2 * size
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


PLACE = np.uint64((1 << 21) - 1)


def window_runs(text: np.ndarray):
    """Runs of neighbouring windows with one class: (first start, last start, class, context).

    The class of a window of LENGTH bytes is its gram of least hash (leading bits, then the leftmost),
    so equal windows, wherever they stand, have equal classes. The context is a hash of all bytes
    from the run's first window to its last.
    """
    grams = _grams(text, GRAM)
    keyed = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
    least = _least(keyed, LENGTH - GRAM + 1)
    edges = np.flatnonzero(np.diff(least)) + 1
    first, last = np.append(0, edges), np.append(edges, len(least)) - 1
    named = grams[(least[first] & PLACE).astype(np.int64)]
    pieces = _grams(text, 64)
    context = named ^ (last - first).astype(np.uint64)
    for at in (first, first + 64, first + 128, last + LENGTH - 128, last + LENGTH - 64):
        context = _mixed(context, pieces[at], 6)
    return first, last, named.view(np.int64), context.view(np.int64)


def _runs_of(text: bytes):
    """The runs of a whole document, found slice by slice; runs end where slices do."""
    for start in range(0, max(1, len(text) - LENGTH + 1), SLICE):
        part = np.frombuffer(text, np.uint8, min(len(text) - start, SLICE + LENGTH - 1), start)
        if len(part) >= LENGTH:
            first, last, named, context = window_runs(part)
            yield first + start, last - first, named, context


def runs(docs: DataFrame, key: Column, text_col="text") -> DataFrame:
    """(row_key, start, more, class, context) for every run of windows of every whole text."""

    def rows(batches):
        for batch in batches:
            held, size = [], 0
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for start, more, named, context in _runs_of(text or b""):
                    held.append((np.full(len(start), key, np.int64), start, more, named, context))
                    size += len(start)
                if size > 100_000:
                    yield packed(held)
                    held, size = [], 0
            if held:
                yield packed(held)

    def packed(held):
        columns = [pa.array(np.concatenate(c)) for c in zip(*held, strict=True)]
        return pa.record_batch(columns, names=["row_key", "start", "more", "class", "context"])

    return docs.select(key.alias("row_key"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        rows, "row_key long, start long, more long, class long, context long"
    )


def suffix_array(text: np.ndarray, covered: int = 1, depth: int = LENGTH) -> np.ndarray:
    """Places in the order of the suffixes, compared over their first ``depth`` bytes at least.

    Difference cover of three: places not divisible by three are the sample. Their triples are sorted
    and named; unless the names tell all of them apart, or already stand for ``depth`` bytes, the
    string of names is sorted the same way. The other suffixes are sorted by their character and the
    rank of the sample suffix behind it, and merged in.
    """
    n = len(text)
    if n < 3:
        return np.argsort(text, kind="stable") if n < 2 or text[0] != text[1] else np.arange(n)[::-1]
    padded = np.concatenate([text.astype(np.int64), np.zeros(3, np.int64)])
    base = int(padded.max()) + 1
    ones, twos, zeros = np.arange(1, n, 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sample = np.concatenate([ones, twos])
    triples = (padded[sample] * base + padded[sample + 1]) * base + padded[sample + 2]
    distinct, names = np.unique(triples, return_inverse=True)
    if len(distinct) == len(sample):
        order = np.empty(len(sample), np.int64)
        order[names] = np.arange(len(sample))
    elif 3 * covered >= depth:
        order = np.argsort(names, kind="stable")
    else:
        # A separator keeps the two halves' names apart.
        joined = np.concatenate([names[: len(ones)] + 1, [0], names[len(ones) :] + 1])
        inner = suffix_array(joined, 3 * covered, depth)
        inner = inner[inner != len(ones)]
        order = inner - (inner > len(ones))
    rank = np.zeros(n + 3, np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    ranks = len(sample) + 2
    zeros = zeros[np.argsort(padded[zeros] * ranks + rank[zeros + 1], kind="stable")]
    sorted_sample = sample[order]
    one, two = sorted_sample[sorted_sample % 3 == 1], sorted_sample[sorted_sample % 3 == 2]
    before = np.searchsorted(padded[one] * ranks + rank[one + 1], padded[zeros] * ranks + rank[zeros + 1])
    before += np.searchsorted(
        (padded[two] * base + padded[two + 1]) * ranks + rank[two + 2],
        (padded[zeros] * base + padded[zeros + 1]) * ranks + rank[zeros + 2],
    )
    out = np.full(n, -1, np.int64)
    place = np.maximum.accumulate(before) + np.arange(len(zeros))
    out[place] = zeros
    out[out < 0] = sorted_sample
    return out


def repeated_starts(contexts: list[bytes]) -> list[np.ndarray]:
    """For each context, whether each of its windows of LENGTH bytes stands elsewhere among them."""
    sizes = np.array([len(c) for c in contexts])
    text = np.frombuffer(b"".join(c + b"\0" for c in contexts), np.uint8).astype(np.int64) + 1
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    text[begins[1:] - 1] = 0
    window = np.zeros(len(text), bool)
    for begin, size in zip(begins[:-1], sizes, strict=True):
        window[begin : begin + size - LENGTH + 1] = True
    order = suffix_array(text)
    order = order[window[order]]
    # Eight bytes at a time, each pair of neighbours is compared over its whole prefix.
    packed = np.concatenate([text, np.zeros(8, np.int64)]).astype(np.uint64)
    words = np.zeros(len(text), np.uint64)
    for k in range(7):
        words = (words << np.uint64(9)) | packed[k : k + len(text)]
    same = np.ones(max(0, len(order) - 1), bool)
    a, b = order[:-1], order[1:]
    for at in [*range(0, LENGTH - 7, 7), LENGTH - 7]:
        live = np.flatnonzero(same)
        same[live] = words[a[live] + at] == words[b[live] + at]
    found = np.zeros(len(text), bool)
    found[a[same]] = True
    found[b[same]] = True
    return [found[begin : begin + size - LENGTH + 1] for begin, size in zip(begins[:-1], sizes, strict=True)]


def _spans(starts: np.ndarray) -> list[dict]:
    """Byte ranges covered by the windows flagged, relative to the context."""
    at = np.flatnonzero(np.diff(np.concatenate([[0], starts.astype(np.int8), [0]])))
    return [{"lo": int(a), "hi": int(b) - 1 + LENGTH} for a, b in zip(at[::2], at[1::2], strict=True)]


SPANS = "array<struct<lo:long,hi:long>>"


def _sorted_in_buckets(contexts: DataFrame, total: int) -> DataFrame:
    """(class, context, spans) by suffix sorting; all contexts of a class meet in one bucket."""

    def rows(batches):
        def solved(held):
            flags = repeated_starts([h[2] for h in held])
            kept = [(c, x, _spans(f)) for (c, x, _), f in zip(held, flags, strict=True) if f.any()]
            kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
            columns = list(zip(*kept, strict=True)) or [[], [], []]
            return pa.record_batch(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], kind)],
                names=["class", "context", "spans"],
            )

        held, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if size >= BUCKET and row[0] != held[-1][0]:
                    yield solved(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[2])
        if held:
            yield solved(held)

    parts = max(1, -(-total // (4 * BUCKET)))
    return (
        contexts.select("class", "context", "text").repartition(parts, "class").sortWithinPartitions("class")
        .mapInArrow(rows, f"class long, context long, spans {SPANS}")
    )


def _counted_windows(contexts: DataFrame) -> DataFrame:
    """(class, context, spans) with each window as a row: for classes too large to meet in one task."""

    def rows(batches):
        for batch in batches:
            for named, context, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                data = np.frombuffer(text, np.uint8)
                one = _grams(data, GRAM)
                n = len(data) - LENGTH + 1
                two = _mixed(one[:n], one[LENGTH - GRAM :][:n], 5)
                middle = _mixed(one[52 : 52 + n], two, 3)
                at = np.arange(n)
                yield pa.record_batch(
                    [pa.array(np.full(n, named)), pa.array(np.full(n, context)), pa.array(at), pa.array(two.view(np.int64)), pa.array(middle.view(np.int64))],
                    names=["class", "context", "at", "h1", "h2"],
                )

    windows = stored(contexts.select("class", "context", "text").mapInArrow(rows, "class long, context long, at long, h1 long, h2 long"), "windows")
    often = windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    span = F.struct(F.col("at").alias("lo"), (F.col("at") + LENGTH).alias("hi"))
    return windows.join(often, ["h1", "h2"]).groupBy("class", "context").agg(F.collect_list(span).alias("spans"))


def covered(docs: DataFrame, key: Column, text_col="text", class_limit: int = CLASS_LIMIT) -> DataFrame:
    """(row_key, spans): the byte ranges of every document that repeated windows cover.

    Only windows of one class can be equal, so a class seen once holds no repeat. If all runs of a
    class have one context, all their windows repeat. What is left is text at the edges of repeats:
    each different context is taken once, sent to its class's bucket and suffix sorted there. Counts
    and minima by class combine map-side, so copies, however many, cost a row a task.
    """
    found = runs(docs, key, text_col)
    classes = stored(
        found.groupBy("class").agg(F.count("*").alias("n"), F.min("context").alias("a"), F.max("context").alias("b"))
        .where("n > 1").select("class", (F.col("a") != F.col("b")).alias("differ")),
        "classes",
    )
    again = stored(thinned(found, "class", classes).join(classes, "class"), "repeated-runs")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("lo"), (F.col("more") + LENGTH).alias("hi")))
    alike = again.where("NOT differ").select("row_key", "start", whole.alias("spans"))
    differ = again.where("differ")
    contexts = stored(
        differ.groupBy("class", "context").agg(F.count("*").alias("n"), F.min(F.struct("row_key", "start", "more")).alias("at")),
        "contexts",
    )
    wanted = contexts.groupBy(F.col("at.row_key").alias("row_key")).agg(
        F.collect_list(F.struct("class", "context", F.col("at.start").alias("start"), F.col("at.more").alias("more"))).alias("cuts")
    )
    texts = docs.select(key.alias("row_key"), F.col(text_col).cast("binary").alias("text"))
    cut = (
        thinned(texts, "row_key", contexts.select(F.col("at.row_key").alias("row_key")))
        .join(wanted, "row_key")
        .select("text", F.explode("cuts").alias("cut"))
        .select("cut.class", "cut.context", F.substring(F.col("text"), (F.col("cut.start") + 1).cast("int"), (F.col("cut.more") + LENGTH).cast("int")).alias("text"))
    )
    sizes = contexts.groupBy("class").agg(F.sum(F.col("at.more") + LENGTH).alias("bytes"))
    large = stored(sizes.where(F.col("bytes") > class_limit).select("class"), "large-classes")
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    cut = stored(cut, "context-texts")
    solved = _sorted_in_buckets(cut.join(large, "class", "left_anti"), total)
    if not large.isEmpty():
        solved = solved.union(_counted_windows(cut.join(large, "class", "left_semi")))
    answers = contexts.select("class", "context", "n").join(solved, ["class", "context"], "left")
    edges = differ.join(answers, ["class", "context"]).select(
        "row_key", "start", F.when(F.col("n") > 1, whole).otherwise(F.col("spans")).alias("spans")
    )
    return (
        alike.union(edges.where("spans IS NOT NULL"))
        .select("row_key", F.explode(F.transform("spans", lambda s: F.struct((s.lo + F.col("start")).alias("lo"), (s.hi + F.col("start")).alias("hi")))).alias("span"))
        .groupBy("row_key").agg(F.array_sort(F.collect_set("span")).alias("spans"))
    )


def without_passages(docs: DataFrame, carried: Column, id_col="doc_id", text_col="text", class_limit: int = CLASS_LIMIT) -> DataFrame:
    """``carried`` (a struct, as column row) with kept (binary), n_bytes, n_removed, n_spans of every row.

    Every byte covered by a string of LENGTH bytes that also starts at another place of any text, its
    own included, is removed; strings are judged on the texts as given and never cross documents. A
    null text counts as empty. Texts of fewer than LENGTH bytes stay whole. Repeated rows are repeats
    of each other. An empty table gives an empty result; other columns are not read.
    """
    key = row_key(id_col, text_col)
    spans = stored(covered(docs, key, text_col, class_limit), "covered")
    rows = docs.select(
        key.alias("row_key"), carried.alias("row"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    )
    joined = thinned(rows, "row_key", spans).join(spans, "row_key", "left").drop("row_key")

    def cut(batches):
        for batch in batches:
            kept, removed, count = [], [], []
            for text, ranges in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                at, parts, n = 0, [], 0
                for span in ranges or []:
                    if n == 0 or span["lo"] > at:
                        parts.append(text[at : span["lo"]])
                        n += 1
                    at = max(at, span["hi"])
                parts.append(text[at:])
                kept.append(b"".join(parts))
                removed.append(len(text) - len(kept[-1]))
                count.append(n)
            sizes = [a + len(b) for a, b in zip(removed, kept, strict=True)]
            yield pa.record_batch(
                [batch.column(0), pa.array(kept, pa.binary()), *(pa.array(c, pa.int64()) for c in (sizes, removed, count))],
                names=["row", "kept", "n_bytes", "n_removed", "n_spans"],
            )

    kind = rows.schema["row"].dataType.simpleString()
    changed = joined.select("row", "text", "spans").mapInArrow(cut, f"row {kind}, kept binary, n_bytes long, n_removed long, n_spans long")
    none = F.lit(0).cast("long")
    return changed.union(untouched(rows, "row_key", spans).select("row", "text", F.octet_length("text").cast("long"), none, none))
