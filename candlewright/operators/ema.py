"""Exponential moving averages as a blocked prefix scan.

``e_n = a * x_n + (1 - a) * e_(n-1)`` is affine in the previous state, so a run of rows acts on the
state as "shrink by (1 - a)^rows, then add what the run itself contributed". Per bin of candles that
contribution is folded from at most SLOTS values; the bins of a block add up with weights; the few
block totals of a series are chained to give each block its starting state. Inside a block a running
sum of ``x_i * (1 - a)^(-i)`` gives the rest. Nothing is truncated: the result is the recurrence
itself up to rounding.

A second average over the difference of the first two (the MACD signal) is a third state of the same
linear system, so it needs no second pass.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.operators import series

# Weights inside a block reach (1 - a)^-rows; a block has at most this many rows.
_ROWS = series.BLOCK_ROWS + series.SLOTS
_LARGEST_POWER = 280.0


def span_alpha(span: int) -> float:
    return 2.0 / (span + 1)


def _keep(alpha: float) -> float:
    if not 0.0 < alpha < 1.0 or -math.log10(1.0 - alpha) * _ROWS > _LARGEST_POWER:
        raise ValueError("alpha must lie in (0, 0.25]: larger weights overflow inside a block")
    return 1.0 - alpha


def _cross(rows: Column, signal: float, alpha: float) -> Column:
    """What a state of the inner average adds to the outer one after some rows without input."""
    outer, inner = _keep(signal), _keep(alpha)
    return (
        (F.pow(F.lit(inner), rows) - F.pow(F.lit(outer), rows))
        * (signal * inner / (inner - outer))
    )


def _decayed(state: list[Column], rows: Column, alphas: list[float], signal: float | None):
    """States after ``rows`` rows whose own input is counted elsewhere."""
    out = [F.pow(F.lit(_keep(a)), rows) * s for a, s in zip(alphas, state)]
    if signal is not None:
        out.append(
            F.pow(F.lit(_keep(signal)), rows) * state[2]
            + state[0] * _cross(rows, signal, alphas[0])
            - state[1] * _cross(rows, signal, alphas[1])
        )
    return out


def _names(alphas, signal):
    return [f"s{i}" for i in range(len(alphas) + (signal is not None))]


def _bin_states(candles: DataFrame, value: str, alphas, signal) -> DataFrame:
    """Per bin: rows, non-null values, first value, and the states the bin alone leaves behind."""
    names = _names(alphas, signal)
    start = F.struct(*[F.lit(0.0).alias(n) for n in names])

    def step(acc, item):
        x = item["v"]
        out = [F.lit(a) * x + F.lit(_keep(a)) * acc[n] for a, n in zip(alphas, names)]
        if signal is not None:
            out.append(F.lit(signal) * (out[0] - out[1]) + F.lit(_keep(signal)) * acc[names[2]])
        return F.struct(*[c.alias(n) for c, n in zip(out, names)])

    values = F.when(
        F.col(value).isNotNull(), F.struct(F.col("open_time").alias("t"), F.col(value).alias("v"))
    )
    return (
        candles.groupBy(*series.KEYS, series.bin_of_time().alias("_bin"))
        .agg(F.count("*").alias("_rows"), F.array_sort(F.collect_list(values)).alias("_values"))
        .withColumn("_state", F.aggregate("_values", start, step))
        .select(
            *series.KEYS, "_bin", "_rows",
            F.size("_values").alias("_filled"),
            F.get("_values", F.lit(0))["v"].alias("_first"),
            *[F.col(f"_state.{n}").alias(n) for n in names],
        )
    )


def _route(candles: DataFrame, value: str, alphas, signal, lookback: int) -> DataFrame:
    """The per-bin route of ``series`` with the state each block starts from."""
    names = _names(alphas, signal)
    inside = Window.partitionBy(*series.KEYS, "_block")
    upto = inside.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    bins = (
        series.number_bins(_bin_states(candles, value, alphas, signal))
        .withColumn("_block_filled", F.sum("_filled").over(inside))
        .withColumn("_after", F.col("_block_filled") - F.sum("_filled").over(upto))
    )
    left = _decayed([F.col(n) for n in names], F.col("_after"), alphas, signal)
    bins = bins.withColumns(
        {f"_sum_{n}": F.sum(column).over(inside) for n, column in zip(names, left)}
    )
    blocks = F.collect_list(
        F.when(
            F.col("_end") == F.col("_block_end"),
            F.struct(F.col("_block"), F.col("_block_filled").alias("n"),
                     *[F.col(f"_sum_{n}").alias(n) for n in names]),
        )
    )

    # The state before the first value is that value itself, so the average starts at it.
    seed = F.struct(*[
        (F.col("_seed") if i < len(alphas) else F.lit(0.0)).cast("double").alias(n)
        for i, n in enumerate(names)
    ])

    def chain(acc, block):
        now = acc["now"]
        moved = _decayed([now[n] for n in names], block["n"], alphas, signal)
        after = F.struct(*[(m + block[n]).alias(n) for m, n in zip(moved, names)])
        return F.struct(
            after.alias("now"), F.array_append(acc["starts"], now).alias("starts")
        )

    state_type = "struct<" + ",".join(f"{n}:double" for n in names) + ">"
    empty = F.array().cast(f"array<{state_type}>")
    return (
        bins.groupBy(*series.KEYS)
        .agg(
            F.min_by("_first", F.when(F.col("_filled") > 0, F.col("_bin"))).alias("_seed"),
            F.array_sort(blocks).alias("_blocks"),
            F.collect_list(
                F.struct("_bin", "_block", series.feeds_next(lookback).alias("_feeds"))
            ).alias("_bins"),
        )
        .withColumn("_seed", F.coalesce("_seed", F.lit(0.0)))
        .withColumn(
            "_starts",
            F.aggregate(
                "_blocks",
                F.struct(seed.alias("now"), empty.alias("starts")),
                chain,
                lambda acc: acc["starts"],
            ),
        )
        .select(*series.KEYS, "_starts", F.explode("_bins").alias("_b"))
        .select(
            *series.KEYS, "_b._bin", "_b._block", "_b._feeds",
            F.get("_starts", F.col("_b._block").cast("int")).alias("_start"),
        )
    )


def spread_with_states(
    candles: DataFrame, value: str, alphas: list[float], signal: float | None = None,
    lookback: int = 1,
) -> tuple[DataFrame, list[Column]]:
    """``series.spread`` plus the running averages of ``value`` as columns over its windows."""
    names = _names(alphas, signal)
    df = series.attach(candles, _route(candles, value, alphas, signal, lookback))
    upto = series.series_window().rowsBetween(Window.unboundedPreceding, 0)
    x = F.when(~F.col("_halo"), F.col(value))
    df = df.withColumn("_i", F.count(x).over(upto) - 1)
    local = [F.col(f"_l_{n}") for n in names]
    df = df.withColumns({
        f"_l_{n}": F.sum(x * a * F.pow(F.lit(_keep(a)), -F.col("_i"))).over(upto)
        * F.pow(F.lit(_keep(a)), F.col("_i"))
        for n, a in zip(names, alphas)
    })
    if signal is not None:
        keep = _keep(signal)
        spread = F.when(x.isNotNull(), (local[0] - local[1]) * signal)
        scaled = F.sum(spread * F.pow(F.lit(keep), -F.col("_i"))).over(upto)
        df = df.withColumn(f"_l_{names[2]}", scaled * F.pow(F.lit(keep), F.col("_i")))
    carried = _decayed(
        [F.col(f"_start.{n}") for n in names], F.col("_i") + 1, alphas, signal
    )
    return df, [F.when(x.isNotNull(), l + c) for l, c in zip(local, carried)]


def ema(candles: DataFrame, value: str, alpha: float, out: str) -> DataFrame:
    """Exponential average of one column per series, seeded with its first value; nulls skipped."""
    df, states = spread_with_states(candles, value, [alpha])
    return series.settle(df.withColumn(out, states[0])).drop("_i", "_start", "_l_s0")


def spread_with_macd(
    candles: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, lookback: int = 1
) -> DataFrame:
    """``series.spread`` with macd, macd_signal and macd_hist; keeps ``_i`` and ``_start``."""
    df, (quick, long, smooth) = spread_with_states(
        candles, "close", [span_alpha(fast), span_alpha(slow)], span_alpha(signal), lookback
    )
    return (
        df.withColumns({"macd": quick - long, "macd_signal": smooth})
        .withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))
        .drop("_l_s0", "_l_s1", "_l_s2")
    )


def previous_macd() -> dict[str, Column]:
    """The MACD columns one row earlier, on the result of ``spread_with_macd``.

    Look-back rows carry no MACD of their own; for the first row of a block the row before left
    exactly the state the block starts from.
    """
    before = {n: F.lag(n).over(series.series_window()) for n in ("macd", "macd_signal", "macd_hist")}
    line = F.col("_start.s0") - F.col("_start.s1")
    smooth = F.col("_start.s2")
    entry = {"macd": line, "macd_signal": smooth, "macd_hist": line - smooth}
    return {n: F.when(F.col("_i") == 0, entry[n]).otherwise(before[n]) for n in before}
