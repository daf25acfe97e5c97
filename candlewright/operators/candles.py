"""Ticks to candles, longer timeframes, and volume by price."""

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.fixed import TIMEFRAME_SECONDS
from candlewright.functions.numbers import exact_sums
from candlewright.functions.timeframes import window_length


def _trade_order(ts: Column, trade_id: Column) -> Column:
    # One decimal instead of struct(ts, trade_id): a struct in an aggregation buffer rules out hash
    # aggregation, and every task would sort its raw ticks before combining them.
    return (
        F.unix_micros(ts).cast("decimal(19,0)") * F.lit(Decimal(10**20))
        + F.coalesce(trade_id, F.lit(0)).cast("decimal(19,0)")
    ).cast("decimal(38,0)")


def _merged() -> dict[str, Column]:
    """How the places of one candle are put together."""
    return {
        "open": F.min_by("open", "_first"), "high": F.max("high"), "low": F.min("low"), "close": F.max_by("close", "_last"),
    }


def candles(ticks: DataFrame, timeframe: str, by_sequence: bool = False) -> DataFrame:
    """OHLCV per symbol and tumbling window, with traded value and VWAP.

    Groups are (symbol, window) and every aggregate combines map-side, so a symbol holding most of
    the ticks sends one partial row per task and window into the shuffle. Works on streams as is.

    First and last trade go by time, then trade id. Where ids are known to rise with time, as an
    exchange's sequence numbers do, ``by_sequence`` orders by id alone, several times cheaper.
    """
    span = F.window("ts", window_length(timeframe))
    order = F.col("trade_id") if by_sequence else _trade_order(F.col("ts"), F.col("trade_id"))
    made = exact_sums(
        ticks.withColumn("_order", order),
        ["symbol", span.alias("_span")],
        {"volume": F.col("quantity"), "notional": F.col("price") * F.col("quantity")},
        {
            "open": F.min_by("price", "_order"), "_first": F.min("_order"),
            "high": F.max("price"), "low": F.min("price"),
            "close": F.max_by("price", "_order"), "_last": F.max("_order"),
        },
        _merged(),
    )
    return _shown(made.withColumn("open_time", F.col("_span.start")), F.lit(timeframe))


def _shown(made: DataFrame, timeframe: Column) -> DataFrame:
    return made.select(
        "symbol", timeframe.alias("timeframe"), "open_time", "open", "high", "low", "close", "volume", "notional",
        F.try_divide("notional", "volume").alias("vwap"),
    )


def _merge(base: DataFrame, keys: list) -> DataFrame:
    """Shorter candles to longer ones: exact sums of their volumes and values."""
    return exact_sums(
        base, keys, {"volume": F.col("volume"), "notional": F.col("notional")},
        {
            "open": F.min_by("open", "open_time"), "_first": F.min("open_time"),
            "high": F.max("high"), "low": F.min("low"),
            "close": F.max_by("close", "open_time"), "_last": F.max("open_time"),
        },
        _merged(),
    )


def roll_up(base: DataFrame, timeframe: str) -> DataFrame:
    """Candles of a longer timeframe from shorter ones.

    Equals aggregating the ticks directly, but that a candle's volume and value are the exact sums of
    those of the shorter candles, which are rounded once each.
    """
    span = F.window("open_time", window_length(timeframe))
    return _shown(_merge(base, ["symbol", span.alias("_span")]).withColumn("open_time", F.col("_span.start")), F.lit(timeframe))


def all_timeframes(minute: DataFrame) -> DataFrame:
    """Every supported timeframe from one-minute candles, as one table.

    Each minute candle is fanned out to the windows that contain it and a single aggregation builds
    all timeframes, so the minutes are read once rather than once per timeframe.
    """
    names = [name for name in TIMEFRAME_SECONDS if name != "1m"]
    targets = F.array(*[
        F.struct(F.lit(name).alias("timeframe"), F.lit(TIMEFRAME_SECONDS[name]).alias("seconds"))
        for name in names
    ])
    base = ["symbol", "timeframe", "open_time", "open", "high", "low", "close", "volume",
            "notional", "vwap"]
    fanned = minute.drop("timeframe").withColumn("_target", F.explode(targets)).withColumn("_at", F.unix_seconds("open_time"))
    start = F.col("_at") - F.pmod(F.col("_at"), F.col("_target.seconds"))
    longer = _merge(fanned, ["symbol", F.col("_target.timeframe").alias("timeframe"), start.alias("_start")])
    longer = _shown(longer.withColumn("open_time", F.timestamp_seconds("_start")), F.col("timeframe"))
    return minute.select(base).unionByName(longer.select(base))


def typical_vwap(candle: DataFrame, timeframe: str) -> DataFrame:
    """VWAP over a longer window when only candles exist, from (high + low + close) / 3."""
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    span = F.window("open_time", window_length(timeframe))
    return exact_sums(
        candle, ["symbol", span.alias("_span")],
        {"_value": typical * F.col("volume"), "volume": F.col("volume")},
    ).select(
        "symbol",
        F.lit(timeframe).alias("timeframe"),
        F.col("_span.start").alias("open_time"),
        "volume",
        F.try_divide("_value", "volume").alias("vwap"),
    )


def volume_profile(ticks: DataFrame, step: float) -> DataFrame:
    """Traded volume per price bucket, symbol and day; the point of control is flagged.

    The point of control is looked up among the finished buckets of a symbol's day, which the day's
    price range bounds, so the ticks are read once.
    """
    profile = exact_sums(
        ticks,
        ["symbol", F.to_date("ts").alias("day"), F.floor(F.col("price") / F.lit(step)).alias("bucket")],
        {"volume": F.col("quantity")},
        {"trades": F.count("*")}, {"trades": F.sum("trades")},
    )
    day = Window.partitionBy("symbol", "day")
    return profile.withColumn("_control", _control().over(day)).select(
        "symbol", "day", "bucket",
        (F.col("bucket") * F.lit(step)).alias("price_from"),
        "volume", "trades",
        (F.col("bucket") == F.col("_control")).alias("is_control"),
    )


def _control() -> Column:
    """The bucket of largest volume, the lowest such bucket on ties."""
    return F.max_by("bucket", F.struct("volume", -F.col("bucket")))


def point_of_control(profile: DataFrame) -> DataFrame:
    """Per symbol and day, the point of control and its volume."""
    return profile.groupBy("symbol", "day").agg(
        _control().alias("control_bucket"), F.max("volume").alias("control_volume")
    )
