"""Timeframe arithmetic."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlewright.fixed import TIMEFRAME_SECONDS


def window_length(timeframe: str) -> str:
    return f"{TIMEFRAME_SECONDS[timeframe]} seconds"


def seconds_of(timeframe: Column) -> Column:
    """Length of a timeframe column in seconds; null for a name outside the domain."""
    lengths = iter(TIMEFRAME_SECONDS.items())
    name, seconds = next(lengths)
    out = F.when(timeframe == name, F.lit(seconds))
    for name, seconds in lengths:
        out = out.when(timeframe == name, F.lit(seconds))
    return out


def close_time(open_time: Column, timeframe: Column) -> Column:
    return F.timestamp_seconds(F.unix_seconds(open_time) + seconds_of(timeframe))


def day_stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")
