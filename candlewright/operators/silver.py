"""Bronze candles to clean candles, and filling Bronze from history."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewright.functions.timeframes import seconds_of
from candlewright.operators.indicators import with_indicators
from candlewright.operators.series import series_window, settle, spread

ID = ["symbol", "timeframe", "open_time"]
PRICES = ["open", "high", "low", "close"]


def valid(candles: DataFrame) -> DataFrame:
    """Candles with a full key, positive prices, a volume and high not below low."""
    keep = F.col("high") >= F.col("low")
    for name in PRICES:
        keep = keep & (F.col(name) > 0) & ~F.isnan(name)
    for name in ID:
        keep = keep & F.col(name).isNotNull()
    keep = keep & (F.col("volume") >= 0) & ~F.isnan("volume") & seconds_of(F.col("timeframe")).isNotNull()
    return candles.filter(F.coalesce(keep, F.lit(False)))


def normalised(candles: DataFrame) -> DataFrame:
    """Upper-case symbols, open times set back to the start of their slot."""
    length = seconds_of(F.col("timeframe"))
    at = F.unix_seconds("open_time")
    return candles.withColumns({
        "symbol": F.upper(F.trim("symbol")),
        "open_time": F.timestamp_seconds(at - F.pmod(at, length)),
    })


def latest_copy(candles: DataFrame, ingested: str) -> DataFrame:
    """One row per candle, the last ingested.

    ``row_number() = 1`` lets each task drop all but its own newest copy before the shuffle, so a
    candle ingested any number of times sends one row per task. Equal ingest times fall back to the
    row's content, which keeps the choice repeatable.
    """
    content = [F.desc(c) for c in ("volume", *reversed(PRICES))]
    newest = Window.partitionBy(*ID).orderBy(F.desc(ingested), *content)
    return candles.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def gap_flagged(candles: DataFrame) -> DataFrame:
    """Adds ``missing_before``: candles absent between a row and the one before it."""
    before = F.lag("open_time").over(series_window())
    slots = (F.unix_seconds("open_time") - F.unix_seconds(before)) / seconds_of(F.col("timeframe"))
    return settle(spread(candles, 1).withColumn("missing_before", F.coalesce(slots - 1, F.lit(0)).cast("bigint")))


def clean(bronze: DataFrame, ingested: str = "ingest_time", around: DataFrame | None = None) -> DataFrame:
    """Drop invalid rows, normalise, keep one copy per candle, flag gaps.

    ``around`` holds keys of candles stored elsewhere, so gaps at the edges count from them; they are
    not in the result.
    """
    kept = latest_copy(normalised(valid(bronze)), ingested).drop(ingested)
    if around is None:
        return gap_flagged(kept)
    both = kept.withColumn("_new", F.lit(True)).unionByName(
        around.select(*ID, F.lit(False).alias("_new")), allowMissingColumns=True
    )
    return gap_flagged(both).filter("_new").drop("_new")


def silver(bronze: DataFrame, ingested: str = "ingest_time") -> DataFrame:
    return with_indicators(clean(bronze, ingested))


def backfill(bronze: DataFrame, history: DataFrame) -> DataFrame:
    """Bronze with the candles history adds; where both have a candle, Bronze keeps its own."""
    one = Window.partitionBy(*ID).orderBy(*[F.desc(c) for c in ("volume", *PRICES)])
    fresh = (
        history.join(bronze.select(*ID), ID, "left_anti")
        .withColumn("_n", F.row_number().over(one)).filter("_n = 1").drop("_n")
    )
    return bronze.unionByName(fresh)
