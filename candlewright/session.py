"""Session settings the operators rely on, and the shared working folder."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on: UTC days and timestamps, disk-backed stream state."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session, whose executors share this machine, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors reach")
        base = tempfile.mkdtemp(prefix="candlewright-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """The same rows read back from a table in the shared folder.

    For results used more than once: they are computed once, and losing an executor later does not
    bring back the work before this point.
    """
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path, compression=compression)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.stored_in = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Deletes the folders of stored tables that no later step reads."""
    for table in tables:
        session = table.sparkSession
        path = session._jvm.org.apache.hadoop.fs.Path(table.stored_in)
        path.getFileSystem(session._jsc.hadoopConfiguration()).delete(path, True)
