"""Parquet tables filed by day, and dead-letter files."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.schemas import RULES


def write_days(df: DataFrame, path: str, ts_col: str = "open_time", mode: str = "overwrite") -> None:
    """Write the days ``df`` holds; days it does not hold stay as they are, so a rerun is idempotent.

    Rows go to their files by day and a range of symbol and time, not by day alone, so a large day is
    written by many tasks.
    """
    days = df.withColumn("day", F.to_date(ts_col))
    (
        days.repartitionByRange("day", *[c for c in ("symbol", ts_col) if c in df.columns])
        .sortWithinPartitions("day", *[c for c in ("symbol", ts_col) if c in df.columns])
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("day")
        .parquet(path)
    )


def read_days(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """A table written by ``write_days``; the day bounds prune partitions."""
    df = spark.read.parquet(path)
    if first:
        df = df.filter(F.col("day") >= F.lit(first).cast("date"))
    if last:
        df = df.filter(F.col("day") <= F.lit(last).cast("date"))
    return df


def has_days(spark: SparkSession, path: str) -> bool:
    """Whether a table was written there before."""
    try:
        return "day" in spark.read.parquet(path).columns
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise


def append_dead_letters(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("dlq_date").json(path)


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RULES).parquet(path)
