"""SimHash near-duplicates of whole documents, found by multi-index hashing."""

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.llm.common import row_key, thinned, untouched
from candlewright.llm.components import components
from candlewright.session import stored

SEED = 42
BLOCK = 1 << 16


def simhash(text: bytes, words: int) -> int:
    """Majority bits of the shingles' XXH64, repeats included; 0 without any word."""
    found = text.lower().split()  # bytes: lowers A-Z only, splits at [\x20\x09-\x0D]
    if not found:
        return 0
    if len(found) < words:
        shingles = iter([b" ".join(found)])
    else:
        shingles = map(b" ".join, zip(*(found[k:] for k in range(words)), strict=False))
    hashes = map(xxhash.xxh64_intdigest, shingles, itertools.repeat(SEED))
    votes, total = np.zeros(64, np.int64), 0
    while len(block := np.fromiter(itertools.islice(hashes, BLOCK), "<u8")):
        bits = np.unpackbits(block.view(np.uint8), bitorder="little").reshape(-1, 64)
        votes += bits.sum(axis=0, dtype=np.uint32)
        total += len(block)
    return int(np.packbits(2 * votes > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text", words: int = 3) -> DataFrame:
    """(doc_id long, row_key long, fp long) of every row; a null text counts as empty."""

    def prints(batches):
        for batch in batches:
            found = [simhash(t or b"", words) for t in batch.column(2).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(np.array(found, np.uint64).view(np.int64))],
                names=["doc_id", "row_key", "fp"],
            )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        row_key(id_col, text_col).alias("row_key"),
        F.col(text_col).cast("binary").alias("text"),
    ).mapInArrow(prints, "doc_id long, row_key long, fp long")


def ball(width: int, radius: int) -> list[int]:
    """The masks that turn a segment into each segment within ``radius`` bits of it."""
    return [
        sum(1 << bit for bit in bits)
        for size in range(radius + 1)
        for bits in itertools.combinations(range(width), size)
    ]


def near_fingerprints(prints: DataFrame, distance: int = 3, segments: int = 2) -> DataFrame:
    """Pairs (a, b), a < b, of different fingerprints at most ``distance`` bits apart, each once.

    One of the ``segments`` differs in at most distance // segments bits. Every fingerprint files its
    segments in a table and looks up the ball around each of them; a hit is kept after comparing all
    bits. Work per fingerprint is fixed (with the defaults 2 table rows, 66 lookups in a space of
    2^32 keys a segment), so copies, which share a fingerprint, cost nothing here.
    """
    width = 64 // segments
    radius = distance // segments
    low = (1 << width) - 1

    def segment(column, k):
        return F.shiftrightunsigned(column, width * k).bitwiseAND(F.lit(low))

    own = prints.select("fp").distinct()
    filed = own.select("fp", F.posexplode(F.array(*(segment(F.col("fp"), k) for k in range(segments)))).alias("k", "part"))
    key = F.xxhash64("k", "part") if segments != 2 else F.shiftleft(F.col("part"), 1).bitwiseOR(F.col("k").cast("long"))
    entries = filed.select(key.alias("key"), F.col("fp").alias("a"))
    lookups = filed.select(
        F.col("fp").alias("b"), "k",
        F.explode(F.array(*(F.col("part").bitwiseXOR(F.lit(mask)) for mask in ball(width, radius)))).alias("part"),
    ).select(key.alias("key"), "b", "k")
    apart = F.col("a").bitwiseXOR(F.col("b"))
    first = F.lit(segments)
    for k in reversed(range(segments)):
        first = F.when(F.bit_count(segment(apart, k)) <= radius, k).otherwise(first)
    return (
        lookups.join(entries, "key")
        .where((F.col("a") < F.col("b")) & (F.bit_count(apart) <= distance) & (F.col("k") == first))
        .select("a", "b")
    )


def near_documents(
    docs: DataFrame, id_col="doc_id", text_col="text", words: int = 3, distance: int = 3
) -> DataFrame:
    """Per row: doc_id, row_key, fp, component_id (smallest doc_id reachable over near fingerprints).

    ``root`` names the component by a fingerprint, so also one without any doc_id.

    Null and blank texts have fingerprint zero and link like any other. A null doc_id never names a
    component unless it has no other member. Repeated rows get the same answer. Extra columns are
    not read. An empty table gives an empty result.
    """
    prints = stored(fingerprints(docs, id_col, text_col, words), "fingerprints")
    roots = components(near_fingerprints(prints, distance))
    smallest = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = smallest.join(roots, smallest.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.join(named, "root").select("fp", "root", "component_id"), "fp")


def one_of_each(docs: DataFrame, id_col="doc_id", text_col="text", words: int = 3, distance: int = 3) -> DataFrame:
    """One row, with all its columns, of each component: that of smallest doc_id (null last).

    Among rows of that id the one of smallest row key stays, and of rows alike in id and text any one.
    Only rows that may go, or may have a double, are shuffled with their text.
    """
    found = stored(near_documents(docs, id_col, text_col, words, distance), "near-documents")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")
    stays = found.groupBy("root").agg(F.min(order).alias("stays")).select("stays.row_key").withColumn("stays", F.lit(True))
    touched = found.groupBy("row_key").agg(F.count("*").alias("n")).join(stays, "row_key", "left").where("stays IS NULL OR n > 1")
    touched = stored(touched, "touched")
    rows = docs.select(F.struct("*").alias("__row"), row_key(id_col, text_col).alias("__key"))
    marked = thinned(rows, "__key", touched.select(F.col("row_key").alias("__key"))).join(
        touched, F.col("__key") == F.col("row_key"), "left"
    )
    alone = untouched(rows, "__key", touched.select(F.col("row_key").alias("__key"))).select("__row", "__key")
    double = marked.where("stays").dropDuplicates(["__key"])
    return alone.union(marked.where("row_key IS NULL").select("__row", "__key")).union(double.select("__row", "__key")).select("__row.*")
