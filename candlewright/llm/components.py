"""Connected components of a link table, by alternating large-star and small-star steps."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.session import dropped, stored


def _mark(links: DataFrame):
    return links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with a link to another one; root is the smallest node reachable.

    Each step replaces links by links to the smallest neighbour, which keeps the components and
    halves the depth, so the number of steps grows with the logarithm of the longest path. Minima
    combine map-side, so a hub costs one row per task; the join back to a hub is a plain join that
    adaptive execution splits. Each step's links are written to the shared folder.
    """
    now = stored(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    mark = _mark(now)
    while mark[0]:
        ends = now.union(now.select("v", "u"))
        low = ends.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), F.least("u", "m").alias("m"))
        large = now.join(low, "v").select("u", F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        last, now = now, stored(
            low.select("u", F.col("m").alias("v"))
            .union(small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")))
            .distinct(),
            "links",
        )
        dropped(last)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )
