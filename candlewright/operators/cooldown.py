"""Cooldown: after a rule fires, its triggers within cooldown_seconds are suppressed.

Whether a trigger fires depends on all earlier ones, yet one rule can own a third of all triggers, so
a rule is not gathered into one group. Its triggers are cut by time into chunks, each at least
CHUNK_CANDLES long and many times longer than a cooldown can be (a rule triggers at most once per
candle, so a chunk of minute candles has at most 23,040 triggers). What a chunk does to the state - "the time
from which the rule may fire again" - depends only on which trigger fires first, and only triggers
within one cooldown of the chunk's start can be that one. Chunks are summed up that way in parallel,
the summaries of a rule are chained, and every chunk then marks its own triggers.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewright.fixed import MAX_COOLDOWN
from candlewright.functions.timeframes import seconds_of

CHUNK_CANDLES = 2048
CHUNK_COOLDOWNS = 16
# Types as objects: type text would need a running session when this module is imported.
EXIT = T.StructType([T.StructField("t", T.LongType()), T.StructField("ready", T.LongType())])


@F.pandas_udf(T.ArrayType(EXIT))
def _exits(times: pd.Series, wait: pd.Series, start: pd.Series) -> pd.Series:
    """Per possible first firing of a chunk, when the rule is ready again after the chunk."""
    def one(t, w, s):
        ready = t + w
        following = np.searchsorted(t, ready)
        for i in range(len(t) - 1, -1, -1):
            if following[i] < len(t):
                ready[i] = ready[following[i]]
        first = np.searchsorted(t, s + w) + 1
        return [{"t": int(a), "ready": int(b)} for a, b in zip(t[:first], ready[:first])]

    return pd.Series([one(np.asarray(t), w, s) for t, w, s in zip(times, wait, start)])


@F.pandas_udf(T.ArrayType(T.LongType()))
def _fires(times: pd.Series, wait: pd.Series, ready: pd.Series) -> pd.Series:
    """The times of a chunk that fire, given when the rule is ready at its start."""
    def one(t, w, r):
        out = []
        i = np.searchsorted(t, r)
        while i < len(t):
            out.append(int(t[i]))
            i = np.searchsorted(t, t[i] + w)
        return out

    return pd.Series([one(np.asarray(t), w, r) for t, w, r in zip(times, wait, ready)])


def fired(triggers: DataFrame, at: Column, wait: Column) -> DataFrame:
    """(rule_id, micros) of the triggers that fire. ``at`` is event time, ``wait`` seconds."""
    slot = F.coalesce(seconds_of(F.col("timeframe")), F.lit(60)).cast("bigint")
    length = F.greatest(slot * CHUNK_CANDLES, F.lit(MAX_COOLDOWN * CHUNK_COOLDOWNS).cast("bigint")) * 1_000_000
    chunks = (
        triggers.select(
            "rule_id", F.unix_micros(at).alias("_t"), (wait.cast("bigint") * 1_000_000).alias("_w"),
            length.alias("_length"),
        )
        .withColumn("_chunk", F.floor(F.col("_t") / F.col("_length")))
        .groupBy("rule_id", "_chunk")
        .agg(
            F.array_sort(F.collect_set("_t")).alias("_times"),
            F.max("_w").alias("_w"), F.max("_length").alias("_length"),
        )
    )

    def chain(acc, chunk):
        skipped = F.size(F.filter(chunk["exits"], lambda e: e["t"] < acc["ready"]))
        after = F.coalesce(F.get(chunk["exits"], skipped)["ready"], acc["ready"])
        entry = F.struct(chunk["chunk"].alias("chunk"), acc["ready"].alias("ready"))
        return F.struct(after.alias("ready"), F.array_append(acc["entries"], entry).alias("entries"))

    start = F.struct(
        F.lit(-(2**62)).cast("bigint").alias("ready"),
        F.array().cast("array<struct<chunk: bigint, ready: bigint>>").alias("entries"),
    )
    entries = (
        chunks.withColumn("exits", _exits("_times", "_w", F.col("_chunk") * F.col("_length")))
        .groupBy("rule_id")
        .agg(F.array_sort(F.collect_list(F.struct(F.col("_chunk").alias("chunk"), "exits"))).alias("_list"))
        .select(
            "rule_id",
            F.explode(F.aggregate("_list", start, chain, lambda acc: acc["entries"])).alias("_e"),
        )
        .select("rule_id", F.col("_e.chunk").alias("_chunk"), F.col("_e.ready").alias("_ready"))
    )
    return chunks.join(entries, ["rule_id", "_chunk"]).select(
        "rule_id", F.explode(_fires("_times", "_w", "_ready")).alias("_micros")
    )


def cooldown(triggers: DataFrame, at: str = "triggered_at") -> DataFrame:
    """Triggers (with rule_id, timeframe, cooldown_seconds) that are not suppressed.

    The first trigger of a rule fires; a later one fires when at least the cooldown has passed since
    the last that fired. Suppressed triggers do not extend the period.
    """
    marks = fired(triggers, F.col(at), F.col("cooldown_seconds"))
    return (
        triggers.withColumn("_micros", F.unix_micros(at))
        .join(marks, ["rule_id", "_micros"], "left_semi")
        .select(*triggers.columns)
    )
