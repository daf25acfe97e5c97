"""Row windows over candle series, cut into blocks of bounded size.

A window partitioned by (symbol, timeframe) puts a whole series into one task: five symbols would
keep five tasks busy however large the cluster, and a symbol with a third of the rows would decide
the run time. Here every series is cut into consecutive blocks of about BLOCK_ROWS rows. Each block
also gets the rows before it that its windows look back on, so frames counted in rows come out
exactly as over the whole series, gaps in time included.

The cut is found from a count per bin of SLOTS candle lengths: a table some SLOTS times smaller than
the candles. A series is ordered in one task only at that size (a symbol with ten years of minute
candles has 41,000 bins).

Candles must be unique on (symbol, timeframe, open_time), which bounds a bin at SLOTS rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.functions.timeframes import seconds_of

KEYS = ["symbol", "timeframe"]
SLOTS = 128
BLOCK_ROWS = 2048
MAX_LOOKBACK = BLOCK_ROWS - SLOTS


def bin_of_time() -> Column:
    length = F.coalesce(seconds_of(F.col("timeframe")), F.lit(60)) * SLOTS
    return F.floor(F.unix_seconds("open_time") / length)


def number_bins(bins: DataFrame) -> DataFrame:
    """Give each bin its block, and say whether the next block looks back into it.

    ``bins`` has the keys, ``_bin`` and ``_rows``; adds ``_block``, ``_end`` (rows of the series up
    to and including the bin), ``_block_end`` and ``_total``.
    """
    series = Window.partitionBy(*KEYS)
    upto = series.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    return (
        bins.withColumns({"_end": F.sum("_rows").over(upto), "_total": F.sum("_rows").over(series)})
        .withColumn("_block", F.floor((F.col("_end") - F.col("_rows")) / BLOCK_ROWS))
        .withColumn("_block_end", F.max("_end").over(Window.partitionBy(*KEYS, "_block")))
    )


def feeds_next(lookback: int) -> Column:
    return (F.col("_block_end") - F.col("_end") < lookback) & (
        F.col("_block_end") < F.col("_total")
    )


def attach(candles: DataFrame, route: DataFrame) -> DataFrame:
    """Join the per-bin route to its candles and copy look-back rows into the next block."""
    renamed = route.select(
        *[F.col(k).alias(f"_r_{k}") for k in KEYS],
        F.col("_bin").alias("_r_bin"),
        *[c for c in route.columns if c not in (*KEYS, "_bin")],
    )
    same = F.col("_bin").eqNullSafe(F.col("_r_bin"))
    for key in KEYS:
        same = same & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    own = F.col("_home")
    extra = [c for c in route.columns if c not in (*KEYS, "_bin", "_block", "_feeds")]
    blocks = F.when(F.col("_feeds"), F.array(own, own + 1)).otherwise(F.array(own))
    return (
        candles.withColumn("_bin", bin_of_time())
        .join(renamed.withColumnRenamed("_block", "_home"), same)
        .select(*candles.columns, *extra, "_home", F.explode(blocks).alias("_block"))
        .select(*candles.columns, *extra, "_block", (F.col("_block") != own).alias("_halo"))
    )


def spread(candles: DataFrame, lookback: int) -> DataFrame:
    """Candles with ``_block`` and ``_halo``; use ``series_window`` on it, then ``settle``."""
    if lookback > MAX_LOOKBACK:
        raise ValueError(f"look-back of {lookback} rows exceeds {MAX_LOOKBACK}")
    bins = candles.groupBy(*KEYS, bin_of_time().alias("_bin")).agg(F.count("*").alias("_rows"))
    route = number_bins(bins).select(
        *KEYS, "_bin", "_block", feeds_next(lookback).alias("_feeds")
    )
    return attach(candles, route)


def series_window():
    return Window.partitionBy(*KEYS, "_block").orderBy("open_time")


def last_rows(n: int):
    """The current row and the n - 1 before it."""
    return series_window().rowsBetween(-(n - 1), 0)


def settle(df: DataFrame) -> DataFrame:
    """Drop the look-back copies and the block columns."""
    return df.filter(~F.col("_halo")).drop("_halo", "_block")
