"""Technical indicators per candle; rolling ones are null until their window is full."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.operators import ema as averages
from candlewright.operators.series import last_rows, series_window, settle, spread

BOLLINGER_ROWS, BOLLINGER_WIDTH = 20, 2.0
RSI_ROWS = ATR_ROWS = 14
VOLUME_ROWS = 20
LONGEST = 99


def _full(n: int, value: Column, aggregate) -> Column:
    frame = last_rows(n)
    return F.when(F.count(value).over(frame) == n, aggregate(value).over(frame))


def _previous(name: str) -> Column:
    return F.lag(name).over(series_window())


def _with_moves(df: DataFrame) -> DataFrame:
    """Previous open and close, gain and loss against them, and the true range."""
    change = F.col("close") - F.col("_pc")
    return df.withColumns({"_po": _previous("open"), "_pc": _previous("close")}).withColumns({
        "_gain": F.when(change > 0, change).when(change.isNotNull(), 0.0),
        "_loss": F.when(change < 0, -change).when(change.isNotNull(), 0.0),
        # The first candle of a series has no previous close: greatest() skips nulls.
        "_range": F.greatest(
            F.col("high") - F.col("low"),
            F.abs(F.col("high") - F.col("_pc")),
            F.abs(F.col("low") - F.col("_pc")),
        ),
    })


def _mean(n: int, name: str) -> Column:
    return _full(n, F.col(name), F.avg)


# Window columns each indicator needs, then the indicator itself on top of them.
def _rolling(names: set[str]) -> dict[str, Column]:
    columns = {
        "averages": {f"ma{n}": _mean(n, "close") for n in (7, 25, LONGEST)},
        "bands": {
            "bb_middle": _mean(BOLLINGER_ROWS, "close"),
            "_sd": _full(BOLLINGER_ROWS, F.col("close"), F.stddev_pop),
        },
        "rsi": {"_up": _mean(RSI_ROWS, "_gain"), "_down": _mean(RSI_ROWS, "_loss")},
        "atr": {"atr_14": _mean(ATR_ROWS, "_range")},
        "volume": {"_usual": _mean(VOLUME_ROWS, "volume")},
    }
    return {k: v for name in columns if name in names for k, v in columns[name].items()}


def _final(names: set[str]) -> dict[str, Column]:
    width = F.col("_sd") * BOLLINGER_WIDTH
    columns = {
        "bands": {"bb_upper": F.col("bb_middle") + width, "bb_lower": F.col("bb_middle") - width},
        "rsi": {"rsi_14": _strength(F.col("_up"), F.col("_down"))},
        "volume": {"volume_ratio": F.try_divide("volume", "_usual")},
        "change": {
            "price_change_pct": (F.try_divide("close", "_pc") - 1) * 100,
        },
        "pattern": {"candle_pattern": _pattern()},
    }
    return {k: v for name in columns if name in names for k, v in columns[name].items()}


def _strength(gain: Column, loss: Column) -> Column:
    return F.when(
        gain.isNotNull() & loss.isNotNull(),
        F.when((loss == 0) & (gain == 0), 50.0)
        .when(loss == 0, 100.0)
        .otherwise(100.0 - 100.0 / (1.0 + F.try_divide(gain, loss))),
    )


def _pattern() -> Column:
    o, h, l, c, po, pc = (F.col(n) for n in ("open", "high", "low", "close", "_po", "_pc"))
    body, extent = F.abs(c - o), h - l
    upper, lower = h - F.greatest(o, c), F.least(o, c) - l
    return (
        F.when((c > o) & (pc < po) & (o <= pc) & (c >= po), "BULLISH_ENGULFING")
        .when((c < o) & (pc > po) & (o >= pc) & (c <= po), "BEARISH_ENGULFING")
        .when(extent == 0, "NEUTRAL")
        .when(body <= extent * 0.1, "DOJI")
        .when((lower >= body * 2) & (upper <= body), "HAMMER")
        .when((upper >= body * 2) & (lower <= body), "SHOOTING_STAR")
        .when(c > o, "BULLISH")
        .when(c < o, "BEARISH")
        .otherwise("NEUTRAL")
    )


HELPERS = ["_po", "_pc", "_gain", "_loss", "_range", "_sd", "_up", "_down", "_usual"]


def _compute(df: DataFrame, names: set[str]) -> DataFrame:
    """Add indicators to spread candles and settle them."""
    df = _with_moves(df).withColumns(_rolling(names))
    return settle(df.withColumns(_final(names))).drop(*HELPERS)


def moving_averages(candles: DataFrame) -> DataFrame:
    return _compute(spread(candles, LONGEST - 1), {"averages"})


def bollinger(candles: DataFrame) -> DataFrame:
    return _compute(spread(candles, BOLLINGER_ROWS - 1), {"bands"})


def rsi(candles: DataFrame, smoothing: str = "simple") -> DataFrame:
    """RSI over 14 changes, by their plain mean or (``wilder``) by an average with weight 1/14."""
    if smoothing == "simple":
        return _compute(spread(candles, RSI_ROWS), {"rsi"})
    df = settle(_with_moves(spread(candles, 1)))
    for name, out in (("_gain", "_up"), ("_loss", "_down")):
        df = averages.ema(df, name, 1.0 / RSI_ROWS, out)
    return df.withColumn("rsi_14", _strength(F.col("_up"), F.col("_down"))).drop(
        "_po", "_pc", "_gain", "_loss", "_range", "_up", "_down"
    )


def atr(candles: DataFrame, smoothing: str = "simple") -> DataFrame:
    if smoothing == "simple":
        return _compute(spread(candles, ATR_ROWS), {"atr"})
    df = settle(_with_moves(spread(candles, 1)))
    return averages.ema(df, "_range", 1.0 / ATR_ROWS, "atr_14").drop(
        "_po", "_pc", "_gain", "_loss", "_range"
    )


def volume_ratio(candles: DataFrame) -> DataFrame:
    return _compute(spread(candles, VOLUME_ROWS - 1), {"volume"})


def price_change(candles: DataFrame) -> DataFrame:
    return _compute(spread(candles, 1), {"change"})


def candle_pattern(candles: DataFrame) -> DataFrame:
    return _compute(spread(candles, 1), {"pattern"})


def macd(candles: DataFrame) -> DataFrame:
    return settle(averages.spread_with_macd(candles)).drop("_i", "_start")


def previous_candle(candles: DataFrame, out: str = "prev") -> DataFrame:
    """The row before each one of its series, as a struct."""
    row = F.struct(*candles.columns)
    return settle(spread(candles, 1).withColumn(out, F.lag(row).over(series_window())))


ALL = {"averages", "bands", "rsi", "atr", "volume", "change", "pattern"}


def with_indicators(candles: DataFrame, previous: bool = False) -> DataFrame:
    """Candles with every indicator a rule can name, computed over one block shuffle.

    ``previous`` adds ``prev``, the same columns one candle earlier, in that pass.
    """
    if "vwap" not in candles.columns:
        typical = (F.col("high") + F.col("low") + F.col("close")) / 3
        candles = candles.withColumn("vwap", typical)
    lookback = LONGEST if previous else LONGEST - 1
    df = _with_moves(averages.spread_with_macd(candles, lookback=lookback))
    df = df.withColumns(_rolling(ALL)).withColumns(_final(ALL)).drop(*HELPERS)
    if previous:
        inner = [c for c in df.columns if c not in ("_block", "_halo", "_i", "_start")]
        lagged = {c: F.lag(c).over(series_window()) for c in inner} | averages.previous_macd()
        row = F.struct(*[lagged[c].alias(c) for c in inner])
        df = df.withColumn("prev", F.when(lagged["open_time"].isNotNull(), row))
    return settle(df).drop("_i", "_start")
