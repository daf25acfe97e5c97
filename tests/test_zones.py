"""Zone jobs: corrected trades, late days and what they read."""

from datetime import date

from pyspark.sql import functions as F

from candlewright.plans import medallion as M
from candlewright.sources import tables

SCHEMA = "payload string, ingest_time string"


def bronze(spark, rows):
    """Payloads of (symbol, time, price, quantity, id) with their time of arrival."""
    payloads = [
        (f'{{"symbol":"{s}","ts":"{t}","price":{p},"quantity":{q},"trade_id":{"null" if i is None else i}}}', came)
        for s, t, p, q, i, came in rows
    ]
    df = spark.createDataFrame(payloads, SCHEMA).withColumn("ingest_time", F.col("ingest_time").cast("timestamp"))
    return df.withColumns({
        "event_date": F.to_date(F.get_json_object("payload", "$.ts")), "ingest_date": F.to_date("ingest_time"),
    })


def test_a_trade_sent_again_counts_once_as_corrected(spark):
    rows = [
        ("A", "2024-01-01T00:00:01", 10.0, 1.0, 7, "2024-01-01 00:00:02"),
        ("A", "2024-01-01T00:00:01", 10.5, 3.0, 7, "2024-01-01 00:00:09"),
        ("A", "2024-01-01T00:00:01", 10.0, 1.0, 7, "2024-01-01 00:00:02"),
        ("B", "2024-01-01T00:00:01", 4.0, 1.0, 7, "2024-01-01 00:00:02"),
        ("B", "2024-01-01T00:00:01", 4.0, 1.0, None, "2024-01-01 00:00:02"),
        ("B", "2024-01-01T00:00:01", 4.0, 1.0, None, "2024-01-01 00:00:02"),
    ]
    got = {r.symbol: (r.close, r.volume, r.notional) for r in M.bronze_candles(bronze(spark, rows)).collect()}
    assert got == {"A": (10.5, 3.0, 31.5), "B": (4.0, 3.0, 12.0)}


def test_silver_reads_only_folders_of_touched_days(spark, tmp_path):
    source, path = str(tmp_path / "bronze"), str(tmp_path / "silver")
    rows = [("A", f"2024-01-0{d}T00:00:01", float(d), 1.0, d, f"2024-01-0{d} 00:00:02") for d in (1, 2, 3)]
    file = lambda made: bronze(spark, made).write.mode("append").partitionBy("event_date", "ingest_date").parquet(source)
    file(rows)
    M.silver_job(spark, source, path)
    before = tables.read_days(spark, path).filter("symbol = 'A'")
    assert [r.missing_before for r in before.orderBy("open_time").collect()] == [0, 1439, 1439]
    # A correction of the second day and a new candle after it, both of which came in later.
    file([("A", "2024-01-02T00:00:01", 9.0, 2.0, 2, "2024-01-05 00:00:00"), ("A", "2024-01-02T12:00:00", 8.0, 1.0, 8, "2024-01-05 00:00:00")])
    M.silver_job(spark, source, path, first="2024-01-05")
    after = tables.read_days(spark, path).orderBy("open_time").collect()
    assert [(r.close, r.volume, r.missing_before) for r in after] == [(1.0, 1.0, 0), (9.0, 2.0, 1439), (8.0, 1.0, 719), (3.0, 1.0, 719)]
    days = M._listed(spark.read.parquet(source).filter("ingest_date >= '2024-01-05'").select("event_date"))
    assert days == [date(2024, 1, 2)]
    read = spark.read.parquet(source).filter(F.col("event_date").isin(days))
    assert {f.split("event_date=")[1][:10] for f in read.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]} == {"2024-01-02"}
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2024-01-02" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_an_empty_bronze_range_changes_nothing(spark, tmp_path):
    source, path = str(tmp_path / "bronze"), str(tmp_path / "silver")
    bronze(spark, [("A", "2024-01-01T00:00:01", 1.0, 1.0, 1, "2024-01-01 00:00:02")]).write.partitionBy("event_date", "ingest_date").parquet(source)
    M.silver_job(spark, source, path)
    M.silver_job(spark, source, path, first="2024-02-01")
    assert tables.read_days(spark, path).count() == 1
