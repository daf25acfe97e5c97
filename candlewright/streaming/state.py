"""Keyed stream state: cooldown per rule, indicators per candle series.

State sits in RocksDB, one small record per key. Rows of a key inside a micro-batch are put in event
order before use; the size of a micro-batch is bounded by the source's rate option.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from candlewright.fixed import DEFAULT_COOLDOWN
from candlewright.operators import indicators as I
from candlewright.operators.ema import span_alpha

HISTORY = 100


class CooldownState(StatefulProcessor):
    """Passes the triggers that are not within the cooldown of the last one passed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "micros bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values("micros", kind="stable")
        last = self.last.get()[0] if self.last.exists() else None
        keep = []
        for micros, wait in zip(batch["micros"], batch["cooldown_seconds"]):
            fires = last is None or micros - last >= int(wait) * 1_000_000
            if fires:
                last = int(micros)
            keep.append(fires)
        self.last.update((last,))
        yield batch[keep].drop(columns=["micros"])

    def close(self) -> None:
        pass


def stream_cooldown(triggers: DataFrame, at: str = "triggered_at") -> DataFrame:
    """Stream form of the cooldown operator: columns rule_id, alert_id, cooldown_seconds and time."""
    rows = triggers.select("rule_id", "alert_id", "cooldown_seconds", at)
    schema = rows.schema
    rows = rows.withColumn("cooldown_seconds", F.coalesce("cooldown_seconds", F.lit(DEFAULT_COOLDOWN)))
    return rows.withColumn("micros", F.unix_micros(at)).groupBy("rule_id").transformWithStateInPandas(
        CooldownState(), schema, outputMode="Append", timeMode="None"
    )


PRICES = ["open", "high", "low", "close", "volume"]
NUMBERS = [
    *PRICES, "vwap", "macd", "macd_signal", "macd_hist", "ma7", "ma25", "ma99", "bb_middle", "bb_upper", "bb_lower",
    "rsi_14", "atr_14", "volume_ratio", "price_change_pct",
]


def _frames(values: np.ndarray, n: int, summary) -> np.ndarray:
    """``summary`` of each full frame of n rows; NaN where the frame is not full yet."""
    out = np.full(len(values), np.nan)
    if len(values) >= n:
        out[n - 1:] = summary(np.lib.stride_tricks.sliding_window_view(values, n), axis=1)
    return out


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.divide(a, b, out=np.full(len(a), np.nan), where=b != 0)


def _lagged(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[np.nan], values[:-1]])


def _patterns(o, h, l, c, po, pc) -> np.ndarray:  # noqa: E741
    body, extent = np.abs(c - o), h - l
    upper, lower = h - np.maximum(o, c), np.minimum(o, c) - l
    cases = [
        ((c > o) & (pc < po) & (o <= pc) & (c >= po), "BULLISH_ENGULFING"),
        ((c < o) & (pc > po) & (o >= pc) & (c <= po), "BEARISH_ENGULFING"),
        (extent == 0, "NEUTRAL"), (body <= extent * 0.1, "DOJI"),
        ((lower >= body * 2) & (upper <= body), "HAMMER"), ((upper >= body * 2) & (lower <= body), "SHOOTING_STAR"),
        (c > o, "BULLISH"), (c < o, "BEARISH"),
    ]
    return np.select([test for test, _ in cases], [name for _, name in cases], "NEUTRAL")


def _rolled(rows: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """All indicators that look back on a fixed number of rows."""
    o, h, l, c, volume = (rows[name] for name in PRICES)  # noqa: E741
    po, pc = _lagged(o), _lagged(c)
    up, down = (_frames(np.where(np.isnan(pc), np.nan, np.maximum(x, 0.0)), I.RSI_ROWS, np.mean) for x in (c - pc, pc - c))
    strength = 100 - 100 / (1 + _ratio(up, down))
    strength = np.where((down == 0) & (up > 0), 100.0, np.where((down == 0) & (up == 0), 50.0, strength))
    spread = np.fmax(h - l, np.fmax(np.abs(h - pc), np.abs(l - pc)))
    middle, deviation = _frames(c, I.BOLLINGER_ROWS, np.mean), _frames(c, I.BOLLINGER_ROWS, np.std)
    return {
        **{f"ma{n}": _frames(c, n, np.mean) for n in (7, 25, I.LONGEST)},
        "bb_middle": middle, "bb_upper": middle + I.BOLLINGER_WIDTH * deviation, "bb_lower": middle - I.BOLLINGER_WIDTH * deviation,
        "rsi_14": strength, "atr_14": _frames(spread, I.ATR_ROWS, np.mean),
        "volume_ratio": _ratio(volume, _frames(volume, I.VOLUME_ROWS, np.mean)),
        "price_change_pct": (_ratio(c, pc) - 1) * 100,
        "candle_pattern": _patterns(o, h, l, c, po, pc),
    }


class IndicatorState(StatefulProcessor):
    """Every indicator of a series, and its previous row, from its last candles and its running averages.

    The time of the last candle is kept: a candle that is not newer, delivered again or late, is
    dropped, as counting it would shift every later average.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.past = handle.getValueState("past", ", ".join(f"{name} array<double>" for name in PRICES))
        self.averages = handle.getValueState("averages", "fast double, slow double, signal double")
        self.last = handle.getValueState("last", "micros bigint, numbers array<double>, pattern string")

    def _macd(self, closes) -> list[tuple[float, float, float]]:
        state = self.averages.get() if self.averages.exists() else None
        lines = []
        for close in closes:
            if state is None:
                state = (close, close, 0.0)
            else:
                fast, slow = (a * close + (1 - a) * s for a, s in zip((span_alpha(12), span_alpha(26)), state))
                a = span_alpha(9)
                state = (fast, slow, a * (fast - slow) + (1 - a) * state[2])
            lines.append((state[0] - state[1], state[2], state[0] - state[1] - state[2]))
        self.averages.update(tuple(float(v) for v in state))
        return lines

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).sort_values("micros", ignore_index=True)
        batch = batch.drop_duplicates("micros", keep="last")
        last = self.last.get() if self.last.exists() else None
        if last is not None:
            batch = batch[batch["micros"] > last[0]]
        if batch.empty:
            return
        batch = batch.reset_index(drop=True)
        past = self.past.get() if self.past.exists() else [[]] * len(PRICES)
        whole = {
            name: np.concatenate([np.array(old, float), batch[name].to_numpy(float)]) for name, old in zip(PRICES, past)
        }
        out = batch.drop(columns=["micros"])
        for name, values in _rolled(whole).items():
            out[name] = values[len(values) - len(batch):]
        out["macd"], out["macd_signal"], out["macd_hist"] = zip(*self._macd(batch["close"]))
        before = [None if v != v else v for v in last[1]] if last is not None else [None] * len(NUMBERS)
        for name, value in zip([*NUMBERS, "candle_pattern", "micros"], [*before, last and last[2], last and last[0]]):
            column = batch["micros"] if name == "micros" else out[name]
            kind = "Int64" if name == "micros" else object if name == "candle_pattern" else float
            out[f"prev_{name}"] = pd.Series([value, *column[:-1]], dtype=kind)
        self.past.update(tuple([float(v) for v in values[-HISTORY:]] for values in whole.values()))
        numbers = [float(v) for v in out[NUMBERS].iloc[-1]]
        self.last.update((int(batch["micros"].iloc[-1]), numbers, str(out["candle_pattern"].iloc[-1])))
        yield out[[*KEYS, *NUMBERS, "candle_pattern", *[f"prev_{n}" for n in [*NUMBERS, "candle_pattern", "micros"]]]]

    def close(self) -> None:
        pass


KEYS = ["symbol", "timeframe", "open_time"]


def stream_indicators(candles: DataFrame) -> DataFrame:
    """A stream of candles with every indicator and ``prev``, as rules need them.

    Equal to the batch form when the candles of a series arrive in order; without a ``vwap`` the typical
    price stands for it. The rows of a series in one micro-batch are held together, so the source's rate
    option bounds them; the state holds the last ``HISTORY`` candles of a series.
    """
    vwap = F.col("vwap") if "vwap" in candles.columns else (F.col("high") + F.col("low") + F.col("close")) / 3
    rows = candles.select(*KEYS, *PRICES, vwap.alias("vwap"), F.unix_micros("open_time").alias("micros"))
    doubles = ", ".join(f"{name} double" for name in NUMBERS)
    lagged = ", ".join(f"prev_{name} double" for name in NUMBERS)
    made = rows.groupBy("symbol", "timeframe").transformWithStateInPandas(
        IndicatorState(),
        f"symbol string, timeframe string, open_time timestamp, {doubles}, candle_pattern string, {lagged}, "
        "prev_candle_pattern string, prev_micros bigint",
        outputMode="Append", timeMode="None",
    )
    fields = [F.col(f"prev_{name}").alias(name) for name in [*NUMBERS, "candle_pattern"]]
    prev = F.struct("symbol", "timeframe", F.timestamp_micros("prev_micros").alias("open_time"), *fields)
    return made.select(*KEYS, *NUMBERS, "candle_pattern", F.when(F.col("prev_micros").isNotNull(), prev).alias("prev"))
