"""Exact top-k by inner product, pruned with segment statistics from coarse to fine."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 2048
ROW_BLOCK = 16384
STRIP = 64  # queries held against a block of rows at a time
PAIRS = 1 << 15  # survivors compared at a time
LEVELS = (4, 16)  # segments of each resolution


def statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means (scaled by the root of the segment's length) and deviations of each segment.

    The squared distance of x and y is at least the squared distance of their rows here: within a
    segment, length * (difference of means)^2 + (difference of deviation norms)^2. As distance and
    inner product differ by the norms alone, that is the same as: the inner product is at most the
    product of the rows.
    """
    parts = []
    for part in np.array_split(vectors, min(segments, max(1, vectors.shape[1])), axis=1):
        size = max(1, part.shape[1])
        mean = part.sum(axis=1) / size
        parts += [mean * np.sqrt(size), np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1))]
    return np.stack(parts, axis=1)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products of whole numbers, as int64 (clipped to its range)."""
    if not len(a) or np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < 2.0**53:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    limit = 2**63 - 1
    whole = [sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for p, q in zip(a, b, strict=True)]
    return np.array([max(-limit, min(limit, w)) for w in whole], np.int64)


def _rowwise(product, a, rows_a, b, rows_b) -> np.ndarray:
    """product of a's and b's chosen rows, PAIRS at a time."""
    parts = [product(a[rows_a[i : i + PAIRS]], b[rows_b[i : i + PAIRS]]) for i in range(0, len(rows_a), PAIRS)]
    return np.concatenate(parts) if parts else product(a[:0], b[:0])


def _dots(a, b):
    return np.einsum("ij,ij->i", a, b)


def best(queries, query_ids, rows, row_ids, k: int, levels=LEVELS):
    """(query index, row id, score) of each query's k best rows, ties to the smaller row id."""
    norms = np.sqrt((rows**2).sum(axis=1))
    coarse = [statistics(rows, n) for n in levels]
    found = []
    for a in range(0, len(queries), STRIP):
        strip, ids = queries[a : a + STRIP], query_ids[a : a + STRIP]
        own = ids[:, None] == row_ids[None, :]
        slack = 1e-9 * np.sqrt((strip**2).sum(axis=1))[:, None] * norms[None, :] + 1e-6
        stats = [statistics(strip, n) for n in levels]
        bound = stats[0] @ coarse[0].T + slack
        bound[own] = -np.inf
        # The k-th exact score among the rows that look best is reached by k rows at least.
        seeds = min(4 * k, bound.shape[1])
        seed = np.argpartition(-bound, seeds - 1, axis=1)[:, :seeds]
        at = np.repeat(np.arange(len(strip)), seeds)
        scores = _exact(strip[at], rows[seed.ravel()]).reshape(len(strip), seeds).astype(float)
        scores[np.take_along_axis(own, seed, axis=1)] = -np.inf
        reached = np.partition(scores, seeds - k, axis=1)[:, seeds - k] if seeds >= k else np.full(len(strip), -np.inf)
        reached -= 1e-9 * np.abs(np.where(np.isfinite(reached), reached, 0))
        q, r = np.nonzero((bound >= reached[:, None]) & ~own)
        for level in range(1, len(levels)):
            keep = _rowwise(_dots, stats[level], q, coarse[level], r) + slack[q, r] >= reached[q]
            q, r = q[keep], r[keep]
        score = _rowwise(_exact, strip, q, rows, r)
        order = np.lexsort((row_ids[r], -score, q))
        q, r, score = q[order], r[order], score[order]
        first = np.searchsorted(q, q, side="left")
        top = np.arange(len(q)) - first < k
        found.append((q[top] + a, row_ids[r[top]], score[top]))
    return [np.concatenate(x) for x in zip(*found, strict=True)]


def scaled(embedding: Column, factor: int = 256) -> Column:
    """floor(factor * x) of every component as a double; null if a component is null or not finite."""
    usable = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(usable, F.transform(embedding, lambda x: F.floor(x.cast("double") * factor).cast("double")))


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col="vec_id", vector_col="vector",
    query_block: int = QUERY_BLOCK, row_block: int = ROW_BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k largest inner products over all other rows.

    ``vector_col`` holds whole numbers as doubles. Null vectors take no part, and only vectors of one
    length meet. Rows alike in id and vector count once; rows of the query's own id are its own.
    Different vectors of one query id are separate queries under that id. Fewer than k rows give
    fewer ranks. Queries and rows are dealt into blocks by hash; each block of queries meets each
    block of rows in one task and sends k rows a query on, so no side is broadcast and memory is
    that of two blocks. Scores beyond a long are clipped to its range.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).where("id IS NOT NULL AND vector IS NOT NULL").dropDuplicates()
    rows = rows.withColumn("dims", F.size("vector")).withColumn("key", F.xxhash64("id", "vector"))
    asked = rows.where(is_query(F.col("id")))
    n_rows, n_asked = rows.agg(F.count("*"), F.count_if(is_query(F.col("id")))).first()
    row_blocks, query_blocks = -(-n_rows // row_block) or 1, -(-n_asked // query_block) or 1

    def dealt(side, own, blocks, other, others):
        return side.withColumn(own, F.pmod("key", F.lit(blocks))).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    keys = ["dims", "query_block", "row_block"]
    left = dealt(asked, "query_block", query_blocks, "row_block", row_blocks).withColumn("row_block", F.col("row_block").cast("long"))
    right = dealt(rows, "row_block", row_blocks, "query_block", query_blocks).withColumn("query_block", F.col("query_block").cast("long"))

    def meet(asked: pa.Table, rows: pa.Table) -> pa.Table:
        def matrix(side):
            ids = side.column("id").to_numpy()
            flat = side.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            return ids, flat.reshape(len(ids), -1)

        empty = np.zeros(0, np.int64)
        if asked.num_rows and rows.num_rows:
            (query_ids, queries), (row_ids, others) = matrix(asked), matrix(rows)
            q, r, score = best(queries, query_ids, others, row_ids, k)
            query_ids, query_keys = query_ids[q], asked.column("key").to_numpy()[q]
        else:
            query_ids = query_keys = r = score = empty
        return pa.table({"query_id": query_ids, "query_key": query_keys, "vec_id": r, "score": score})

    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_id long, query_key long, vec_id long, score long")
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
