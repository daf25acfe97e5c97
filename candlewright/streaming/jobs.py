"""Stream plumbing: watermarks, sinks keyed by batch, bounded and continuous runs."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candlewright.functions.timeframes import window_length
from candlewright.operators import candles as C
from candlewright.operators.alerts import to_alerts
from candlewright.operators.rules import evaluate

DELAY = "10 minutes"


def with_watermark(stream: DataFrame, ts_col: str = "ts", delay: str = DELAY) -> DataFrame:
    """Event time with a lateness bound. A zone-free timestamp is cast first: Spark takes no other."""
    return stream.withColumn(ts_col, F.col(ts_col).cast("timestamp")).withWatermark(ts_col, delay)


def stream_candles(ticks: DataFrame, timeframe: str, delay: str = DELAY) -> DataFrame:
    """Candles of closed windows; ticks older than the watermark are dropped."""
    return C.candles(with_watermark(ticks, "ts", delay), timeframe)


def with_closing(ticks: DataFrame, folder: str) -> DataFrame:
    """``ticks`` together with what ``close`` puts in ``folder``, as one stream."""
    spark = ticks.sparkSession
    spark.createDataFrame([], ticks.schema).write.mode("append").parquet(folder)
    return ticks.unionByName(spark.readStream.schema(ticks.schema).parquet(folder))


def close(ticks: DataFrame, folder: str, timeframe: str, delay: str = DELAY, ts_col: str = "ts") -> None:
    """Ends a bounded stream: the next run over it moves its watermark past the last window of ``ticks``.

    A row of that time alone is put into the folder. Its own window, which no symbol has, stays open, so
    it reaches no sink; of an empty table nothing is written.
    """
    after = F.expr(f"INTERVAL {window_length(timeframe)}") + F.expr(f"INTERVAL {delay}") + F.expr("INTERVAL 1 SECOND")
    last = ticks.agg(F.max(F.col(ts_col).cast("timestamp")).alias("_last")).where("_last IS NOT NULL")
    columns = [
        ((F.col("_last") + after) if f.name == ts_col else F.lit(None)).cast(f.dataType).alias(f.name) for f in ticks.schema
    ]
    last.select(*columns).write.mode("append").parquet(folder)


def without_repeats(alerts: DataFrame, delay: str = DELAY) -> DataFrame:
    """Alerts whose id was not seen within the watermark: retried sends repeat an id."""
    return with_watermark(alerts, "triggered_at", delay).dropDuplicatesWithinWatermark(["alert_id"])


def start(writer, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run continuously (``every`` such as "1 minute") or over what is there now, then stop."""
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def to_files(stream: DataFrame, path: str, checkpoint: str, every: str | None = None,
             partition_by: list[str] | None = None) -> StreamingQuery:
    """Append to Parquet; the sink's log and the checkpoint make it exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    return start(writer.partitionBy(*partition_by) if partition_by else writer, checkpoint, every)


def to_topic(messages: DataFrame, servers: str, topic: str, checkpoint: str,
             every: str | None = None) -> StreamingQuery:
    """Send key/value rows to a topic. Needs the Kafka connector on the classpath."""
    writer = (
        messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
    )
    return start(writer, checkpoint, every)


def write_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Write one micro-batch under its id: a batch repeated after a failure replaces itself."""
    (
        df.withColumn("batch_id", F.lit(batch_id))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id").parquet(path)
    )


def each_batch(stream: DataFrame, handle: Callable[[DataFrame], DataFrame], path: str,
               checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Apply a batch operator to every micro-batch and store its result under the batch id."""
    def run(df: DataFrame, batch_id: int) -> None:
        write_batch(handle(df), batch_id, path)

    return start(stream.writeStream.foreachBatch(run), checkpoint, every)


def stream_alerts(candles: DataFrame, read_rules: Callable[[], DataFrame], path: str,
                  checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Alerts from a stream of indicator candles carrying ``prev``.

    The rules are read anew for every micro-batch, so changes take effect while the stream runs.
    """
    return each_batch(
        candles, lambda df: to_alerts(evaluate(df, read_rules())), path, checkpoint, every
    )
