"""Topics: readers, typed payloads, and Bronze rows."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright import schemas
from candlewright.fixed import TOPIC_OHLCV, TOPIC_ORDER_BOOK, TOPIC_TICKS

PAYLOADS = {
    TOPIC_TICKS: schemas.TICKS, TOPIC_OHLCV: schemas.CANDLES, TOPIC_ORDER_BOOK: schemas.ORDER_BOOK,
}


def read_topic(spark: SparkSession, servers: str, topic: str, start: str = "earliest") -> DataFrame:
    """A topic as a stream; one task per topic partition. Needs the Kafka connector on the classpath."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
        .load()
    )


def parse(messages: DataFrame, topic: str) -> DataFrame:
    """Typed rows from the JSON in ``value``; what does not parse comes out as nulls."""
    return messages.select(
        F.from_json(F.col("value").cast("string"), PAYLOADS[topic]).alias("_row")
    ).select("_row.*")


def bronze(messages: DataFrame, ingested: Column) -> DataFrame:
    """The payload as received, with where and when it came from and the day it is filed under."""
    return messages.select(
        "topic", "partition", "offset", F.col("value").cast("string").alias("payload"),
        ingested.alias("ingest_time"), F.to_date(ingested).alias("ingest_date"),
    )
