"""Delivery with retries through a sender the caller supplies, and what is read off its log."""

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright import fixed, schemas
from candlewright.operators.alerts import dead_letters

# Answers that end the attempts.
DONE, NOT_FOUND = 200, 404


def _attempt(send, row, attempts: int, backoff: float, sleep):
    """(attempts made, status, last code, error) for one delivery."""
    code, error = None, None
    for attempt in range(1, attempts + 1):
        try:
            code, error = int(send(row)), None
        except Exception as problem:  # any failure of the sender counts as a failed attempt
            code, error = None, str(problem)
        if code == DONE:
            return attempt, "dispatched", code, None
        if code == NOT_FOUND:
            return attempt, "not_found", code, "rule not found"
        if attempt < attempts:
            sleep(backoff * 2 ** (attempt - 1))
    return attempts, "failed", code, error or f"Failed after {attempts} attempts"


def deliver(
    deliveries: DataFrame,
    send: Callable[[object], int],
    sleep: Callable[[float], None] = time.sleep,
    attempts: int = fixed.MAX_ATTEMPTS,
    backoff: float = fixed.BACKOFF_SECONDS,
) -> DataFrame:
    """Send each row and log the outcome. ``send`` gets the row and returns a status code.

    Delivery is at least once: a lost task repeats its sends, so receivers should key on alert_id.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            log = [
                (row.alert_id, row.channel, *_attempt(send, row, attempts, backoff, sleep))
                for row in batch.itertuples(index=False)
            ]
            out = pd.DataFrame(
                log, columns=["alert_id", "channel", "attempts", "status", "last_code", "error"]
            )
            yield out.astype({"last_code": "Int32", "attempts": "int32"})

    return deliveries.mapInPandas(run, schemas.DELIVERY_LOG)


def delivery_stats(log: DataFrame) -> DataFrame:
    """Dispatched, failed (unknown rules included) and retried (every failed attempt but a 404)."""
    done = F.col("status") == "dispatched"
    lost = F.col("status") == "not_found"
    return log.agg(
        F.count_if(done).alias("dispatched"),
        F.count_if(~done).alias("failed"),
        F.coalesce(
            F.sum(F.when(done | lost, F.col("attempts") - 1).otherwise(F.col("attempts"))), F.lit(0)
        ).alias("retried"),
    )


def undelivered(log: DataFrame, deliveries: DataFrame, at: Column) -> DataFrame:
    """Dead letters of the deliveries whose attempts are exhausted; unknown rules get none."""
    failed = log.filter(F.col("status") == "failed").select(
        "alert_id", "channel", F.format_string("Failed after %d attempts", "attempts").alias("error")
    )
    events = deliveries.select(
        "alert_id", "channel", F.to_json(F.struct(*deliveries.columns)).alias("event")
    )
    return dead_letters(failed.join(events, ["alert_id", "channel"]), at)
