"""Blocked windows and scans against plain ones, whatever the block size and the gaps."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewright.operators import candles as C
from candlewright.operators import ema as E
from candlewright.operators import indicators as I
from candlewright.operators import series as S
from candlewright.sources import feeds


@pytest.fixture
def tiny_blocks(monkeypatch):
    monkeypatch.setattr(S, "BLOCK_ROWS", 160)
    monkeypatch.setattr(S, "SLOTS", 16)
    monkeypatch.setattr(E, "_ROWS", 176)


@pytest.fixture
def uneven(spark):
    """A dense hot series, a sparse one, one with a long gap, one of a single row."""
    rng = random.Random(5)
    minutes = {
        "HOT": range(1500),
        "SPARSE": [i * 700 for i in range(300)],
        "GAP": [*range(400), *range(900000, 900500)],
        "ONE": [17],
    }
    rows = [
        (s, "1m", m * 60, *(round(rng.uniform(1, 9), 2) for _ in range(4)), float(rng.randint(0, 50)))
        for s, ms in minutes.items() for m in ms
    ]
    raw = spark.createDataFrame(
        rows, "symbol string, timeframe string, at bigint, open double, high double, low double, close double, volume double"
    )
    return raw.withColumn("open_time", F.timestamp_seconds("at")).drop("at").cache()


def test_blocks_are_bounded_and_halos_complete(spark, uneven, tiny_blocks):
    blocks = S.spread(uneven, 98).groupBy("symbol", "_block").agg(
        F.count_if(~F.col("_halo")).alias("own"), F.count_if("_halo").alias("halo")
    ).collect()
    for b in blocks:
        assert 0 < b.own <= 176 and (b._block == 0 or 98 <= b.halo <= 98 + 16)
    assert sum(b.own for b in blocks) == uneven.count()


def test_windows_over_blocks_equal_plain_windows(spark, uneven, tiny_blocks):
    plain = Window.partitionBy("symbol").orderBy("open_time")
    want = uneven.select(
        "symbol", "open_time",
        *[F.when(F.count("close").over(plain.rowsBetween(1 - n, 0)) == n,
                 F.avg("close").over(plain.rowsBetween(1 - n, 0))).alias(f"ma{n}") for n in (7, 25, 99)],
        F.lag("close").over(plain).alias("before"),
    )
    got = I.previous_candle(I.moving_averages(uneven)).select(
        "symbol", "open_time", "ma7", "ma25", "ma99", F.col("prev.close").alias("before")
    )
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def sequential(values, alpha):
    out = [values[0]]
    for v in values[1:]:
        out.append(alpha * v + (1 - alpha) * out[-1])
    return out


def test_ema_and_macd_equal_the_recurrence(spark, uneven, tiny_blocks):
    rows = I.with_indicators(uneven, previous=True).orderBy("symbol", "open_time").toPandas()
    for _, g in rows.groupby("symbol"):
        close = list(g["close"])
        line = [a - b for a, b in zip(sequential(close, 2 / 13), sequential(close, 2 / 27))]
        smooth = sequential(line, 0.2)
        assert list(g["macd"]) == pytest.approx(line, abs=1e-11)
        assert list(g["macd_signal"]) == pytest.approx(smooth, abs=1e-11)
        assert list(g["macd_hist"]) == pytest.approx(list(g["macd"] - g["macd_signal"]), abs=1e-12)
        before = [p["macd_hist"] for p in g["prev"][1:]]
        assert g["prev"].iloc[0] is None
        assert before == pytest.approx(list(g["macd_hist"])[:-1], abs=1e-11)


def test_ema_skips_nulls(spark, uneven, tiny_blocks):
    holes = uneven.withColumn("v", F.when(F.pmod(F.hash("open_time"), F.lit(3)) > 0, F.col("close")))
    rows = E.ema(holes, "v", 1 / 14, "e").orderBy("symbol", "open_time").toPandas()
    for _, g in rows.groupby("symbol"):
        filled = g[g["v"].notna()]
        assert g[g["v"].isna()]["e"].isna().all()
        if len(filled):
            assert list(filled["e"]) == pytest.approx(sequential(list(filled["v"]), 1 / 14), abs=1e-11)


def test_wilder_smoothing(spark, uneven):
    rows = I.rsi(uneven, "wilder").filter("symbol = 'HOT'").orderBy("open_time").toPandas()
    change = rows["close"].diff().iloc[1:]
    up = sequential(list(change.clip(lower=0)), 1 / 14)
    down = sequential(list((-change).clip(lower=0)), 1 / 14)
    want = [50.0 if u == d == 0 else 100.0 if d == 0 else 100 - 100 / (1 + u / d) for u, d in zip(up, down)]
    assert rows["rsi_14"].isna().iloc[0]
    assert list(rows["rsi_14"].iloc[1:]) == pytest.approx(want, abs=1e-9)
    assert I.atr(uneven, "wilder").filter("atr_14 is null").count() == 0


def test_weights_that_would_overflow_are_refused():
    with pytest.raises(ValueError):
        E._keep(0.9)


def test_roll_up_equals_direct_aggregation(spark, sf_dir):
    ticks = feeds.ticks(spark, sf_dir)
    minute = C.candles(ticks, "1m")
    both = C.all_timeframes(minute)
    for name in ("3m", "15m", "1h", "1d"):
        direct = C.candles(ticks, name)
        assert both.filter(F.col("timeframe") == name).exceptAll(direct).count() == 0
        assert direct.exceptAll(C.roll_up(minute, name)).count() == 0


def test_sequence_order_gives_the_same_candles_where_ids_rise_with_time(spark, sf_dir):
    ticks = feeds.ticks(spark, sf_dir)
    assert C.candles(ticks, "1h").exceptAll(C.candles(ticks, "1h", by_sequence=True)).count() == 0


def test_a_tie_in_time_falls_to_the_trade_id(spark):
    ticks = spark.createDataFrame(
        [("A", 5.0, 1.0, 7), ("A", 6.0, 1.0, 9), ("A", 4.0, 1.0, 3)], "symbol string, price double, quantity double, trade_id bigint"
    ).withColumn("ts", F.lit("2024-01-01 00:00:01").cast("timestamp"))
    row = C.candles(ticks, "1m").first()
    assert (row.open, row.close, row.high, row.low) == (4.0, 6.0, 6.0, 4.0)


def test_patterns(spark):
    #        open  high  low  close
    shapes = [
        ("NEUTRAL", (5, 5, 5, 5)), ("DOJI", (5, 6, 4, 5.1)), ("HAMMER", (5, 5.6, 2, 5.5)),
        ("SHOOTING_STAR", (5.5, 8, 4.9, 5)), ("BULLISH", (5, 7.5, 4.5, 7)), ("BEARISH", (7, 7.5, 4.5, 5)),
    ]
    rows = [(name, "1h", *map(float, s)) for name, s in shapes]
    df = spark.createDataFrame(rows, "symbol string, timeframe string, open double, high double, low double, close double")
    df = df.withColumn("open_time", F.lit("2024-01-01").cast("timestamp"))
    assert all(r.symbol == r.candle_pattern for r in I.candle_pattern(df).collect())
    pair = [("A", 0, 6.0, 6.1, 4.9, 5.0), ("A", 3600, 4.9, 6.3, 4.8, 6.2), ("B", 0, 5.0, 6.1, 4.9, 6.0), ("B", 3600, 6.2, 6.3, 4.7, 4.8)]
    df = spark.createDataFrame(pair, "symbol string, at bigint, open double, high double, low double, close double").select(
        "symbol", F.lit("1h").alias("timeframe"), F.timestamp_seconds("at").alias("open_time"), "open", "high", "low", "close"
    )
    last = {r.symbol: r.candle_pattern for r in I.candle_pattern(df).filter("hour(open_time) = 1").collect()}
    assert last == {"A": "BULLISH_ENGULFING", "B": "BEARISH_ENGULFING"}
