"""Small helpers shared by the corpus operators."""

import gc
import sys
import time
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters of [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
#: Longs that a filter ahead of a shuffle broadcasts at most.
SLOTS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Few rows and bytes to an Arrow batch, so that tasks with long texts stay small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def released(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps now, not when the driver next collects its garbage.

    What the first round frees still holds what the second can free.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def per_worker(name: str, build):
    """What ``build`` returns, made once in each Python worker and kept for its later tasks."""
    kept = sys.modules.setdefault("_candlewright_worker", types.ModuleType("_candlewright_worker"))
    if not hasattr(kept, name):
        setattr(kept, name, build())
    return getattr(kept, name)


def row_key(id_col: str, text_col: str) -> Column:
    """Names a document by id and text. Rows alike in both share it, and so all results."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def thinned(rows: DataFrame, key: str, wanted: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Rows that may join ``wanted`` on a long column: a filter ahead of the join's shuffle.

    What is broadcast is the set of ``key`` modulo ``slots``, so at most ``slots`` longs whatever the
    data. It never drops a row that joins; with very many wanted keys it merely keeps all rows.
    """
    return _by_slot(rows, key, wanted, slots, "left_semi")


def untouched(rows: DataFrame, key: str, wanted: DataFrame, slots: int = SLOTS) -> DataFrame:
    """The rows that ``thinned`` leaves out: certain not to join, so they need no shuffle."""
    return _by_slot(rows, key, wanted, slots, "left_anti")


def _by_slot(rows, key, wanted, slots, how):
    slot = F.pmod(F.col(key), F.lit(slots))
    hit = wanted.select(slot.alias("__slot")).distinct()
    return rows.join(F.broadcast(hit), slot == F.col("__slot"), how)
