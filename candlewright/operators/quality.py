"""Data-quality report, retention and table layout."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.fixed import ZONE_RETENTION_DAYS


def quality(df: DataFrame, ts_col: str, as_of: Column) -> DataFrame:
    """Row count, freshness in seconds and null rate per column, one row per column.

    One pass and one aggregation whatever the number of columns; ``as_of`` is passed in so a report
    can be repeated.
    """
    nulls = [F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in df.columns]
    sums = df.agg(F.count("*").alias("row_count"), F.max(ts_col).alias("_latest"), *nulls)
    rates = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(f"_null_{c}").alias("null_count"))
        for c in df.columns
    ])
    return sums.select(
        "row_count",
        (F.unix_micros(as_of) - F.unix_micros("_latest")).alias("_micros"),
        F.explode(rates).alias("_c"),
    ).select(
        "_c.column_name", "row_count", "_c.null_count",
        F.try_divide("_c.null_count", "row_count").alias("null_rate"),
        (F.col("_micros") / 1e6).alias("freshness_seconds"),
    )


def retained(df: DataFrame, ts_col: str, zone: str, as_of: Column) -> DataFrame:
    """Rows young enough for their zone.

    The bound is on the bare column, so it skips row groups; a table filed by ``day`` is cut by that
    column as well, so old days are not even listed.
    """
    bound = as_of - F.make_interval(days=F.lit(ZONE_RETENTION_DAYS[zone]))
    young = F.col(ts_col) >= bound
    return df.filter(young & (F.col("day") >= bound.cast("date")) if "day" in df.columns else young)


def compacted(df: DataFrame, files: int | None = None) -> DataFrame:
    """Cluster a table for reading by symbol and time: ranges across files, order inside them.

    The range bounds are sampled from the data, and time is part of the key, so a hot symbol is cut
    over several files.
    """
    keys = ["symbol", "open_time"]
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)
