"""The zones end to end: Bronze from a topic, Silver, Gold, alerts, dispatch.

Every job reads a stored table and writes one, so a job can be rerun for its days alone and no job
recomputes the one before it. ``every`` runs the streaming jobs continuously, without it they handle
what has arrived and stop.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewright.fixed import TOPIC_TICKS
from candlewright.operators import alerts as A
from candlewright.operators import candles as C
from candlewright.operators import delivery as D
from candlewright.operators import indicators as I
from candlewright.operators import silver as S
from candlewright.operators.cooldown import cooldown
from candlewright.operators.rules import evaluate
from candlewright.session import stored
from candlewright.sources import tables, topics
from candlewright.streaming import jobs


def bronze_job(messages: DataFrame, path: str, checkpoint: str, ingested, every: str | None = None):
    """Topic records, as received, into files by the day of the event and the day it came in."""
    event = F.get_json_object("payload", "$.ts").try_cast("timestamp")
    rows = topics.bronze(messages, ingested).withColumn("event_date", F.to_date(event))
    return jobs.to_files(rows, path, checkpoint, every, partition_by=["event_date", "ingest_date"])


def latest_trades(bronze: DataFrame) -> DataFrame:
    """Ticks of stored payloads, one for each trade id of a symbol: the one that came in last.

    A trade sent again counts once, with its corrected price and quantity; equal times of arrival fall
    back to the content. Bronze filed without a time of arrival goes by its day. Trades without an id all count. Only copies among the given rows are seen: one
    sent again under another day counts in both, unless both days are read.
    """
    arrived = "ingest_time" if "ingest_time" in bronze.columns else "ingest_date"
    ticks = bronze.select(
        F.from_json("payload", topics.PAYLOADS[TOPIC_TICKS]).alias("_t"), F.col(arrived).alias("_in")
    ).select("_t.*", "_in")
    # ``row_number() = 1`` is limited per task ahead of the shuffle.
    newest = Window.partitionBy("symbol", "trade_id").orderBy(*[F.desc(c) for c in ("_in", "ts", "price", "quantity")])
    known = F.col("trade_id").isNotNull()
    kept = ticks.filter(known).withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")
    return kept.unionByName(ticks.filter(~known)).drop("_in")


def bronze_candles(bronze: DataFrame) -> DataFrame:
    """Minute candles from stored tick payloads, filed under their open time."""
    minute = C.candles(latest_trades(bronze), "1m")
    return minute.withColumn("ingest_time", F.col("open_time"))


def _listed(days: DataFrame) -> list:
    """The days as literals, which prune folders: at most one a day of the calendar."""
    return sorted(r[0] for r in days.dropna().distinct().collect())


def _followers(silver: DataFrame, touched: DataFrame) -> DataFrame:
    """Days whose first candle of some series comes next after a touched day: its gap may change.

    Works on one row per series and day, and on one row per day of the calendar.
    """
    held = silver.select("symbol", "timeframe", "day").distinct()
    before = F.lag("day").over(Window.partitionBy("symbol", "timeframe").orderBy("day"))
    calendar = held.select("day", F.lit(False).alias("hit")).union(touched.select("day", F.lit(True)))
    days = calendar.groupBy("day").agg(F.max("hit").alias("hit")).withColumn(
        "_touched",
        F.max(F.when(F.col("hit"), F.col("day"))).over(Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)),
    )
    return (
        held.withColumn("_before", before).join(days.select("day", "_touched"), "day")
        .filter(F.col("_touched") >= F.coalesce("_before", "_touched"))
        .select("day").distinct()
    )


def silver_job(spark: SparkSession, bronze_path: str, path: str,
               first: str | None = None, last: str | None = None) -> None:
    """Clean candles of every day that records ingested in the range belong to.

    Such a day is built from all of its Bronze records up to ``last``, whenever they came in, so late
    ticks add to a day and never replace it.
    """
    bronze = spark.read.parquet(bronze_path)
    if last:
        bronze = bronze.filter(F.col("ingest_date") <= F.lit(last).cast("date"))
    fresh = bronze.filter(F.col("ingest_date") >= F.lit(first).cast("date")) if first else bronze
    days = _listed(fresh.select("event_date"))
    around = None
    if tables.has_days(spark, path):
        silver = tables.read_days(spark, path)
        touched = spark.createDataFrame([(day,) for day in days], "day date")
        days = sorted({*days, *_listed(_followers(silver, touched))})
        # Stored, as the table they come from is about to be written.
        around = stored(
            silver.filter(~F.col("day").isin(days)).groupBy("symbol", "timeframe", "day")
            .agg(F.max("open_time").alias("open_time")),
            "edges",
        )
    rows = bronze.filter(F.col("event_date").isin(days))
    tables.write_days(S.clean(bronze_candles(rows), around=around), path)


def gold_job(spark: SparkSession, silver_path: str, path: str,
             first: str | None = None, last: str | None = None) -> None:
    minute = tables.read_days(spark, silver_path, first, last).drop("day", "missing_before")
    tables.write_days(C.all_timeframes(minute), path)


def alert_job(spark: SparkSession, gold_path: str, rules: DataFrame, path: str, work: str) -> None:
    """Alerts of a Gold table, cooldown applied.

    Triggered rules are stored before the cooldown looks at them twice.
    """
    gold = tables.read_days(spark, gold_path).drop("day")
    evaluate(I.with_indicators(gold, previous=True), rules).withColumn(
        "open_time", F.col("triggered_row.open_time")
    ).write.mode("overwrite").parquet(work)
    hits = spark.read.parquet(work)
    A.to_alerts(cooldown(hits, "open_time")).write.mode("overwrite").parquet(path)


def dispatch_job(spark: SparkSession, messages: DataFrame, rules: DataFrame, path: str,
                 send: Callable, sleep: Callable, at: Column, batch_id: int = 0) -> dict[str, str]:
    """Parse, route and deliver a batch of alert messages; returns where its outputs went.

    Audit, log and refused channels are kept per batch id: a batch that is repeated replaces its own
    rows, another one adds to them. Dead letters are appended at each run.
    """
    where = {name: f"{path}/{name}" for name in ("audit", "log", "refused_channels", "dead_letters")}
    valid, refused = A.parse_alerts(messages)
    jobs.write_batch(A.audit(valid, rules, at), batch_id, where["audit"])
    deliveries, unsupported = A.fan_out(valid, rules)
    jobs.write_batch(unsupported, batch_id, where["refused_channels"])
    jobs.write_batch(D.deliver(deliveries, send, sleep), batch_id, where["log"])
    log = spark.read.parquet(where["log"]).filter(F.col("batch_id") == batch_id).drop("batch_id")
    bad = refused.select("error", F.coalesce("text", F.lit("")).alias("event"))
    letters = A.dead_letters(bad, at).unionByName(D.undelivered(log, deliveries, at))
    tables.append_dead_letters(letters, where["dead_letters"])
    return where
