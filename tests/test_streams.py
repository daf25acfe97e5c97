import pytest
from pyspark.sql import functions as F

from candlewright.operators import cooldown as K
from candlewright.operators import indicators as I
from candlewright.plans import medallion
from candlewright.plans import queries as Q
from candlewright.sources import feeds, tables
from candlewright.streaming import jobs, state

TICK = "symbol string, ts timestamp, price double, quantity double, trade_id bigint"


def put(spark, path, name, rows):
    """Add one file of ticks (symbol, seconds, price, id) to a stream's folder."""
    spark.createDataFrame(rows, "symbol string, t bigint, price double, trade_id bigint").select(
        "symbol", F.timestamp_seconds("t").alias("ts"), "price", F.lit(1.0).alias("quantity"), "trade_id"
    ).coalesce(1).write.mode("append").parquet(f"{path}/{name}")


def ticks_from(spark, path):
    return spark.readStream.schema(TICK).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(path)


def test_late_ticks_within_the_watermark_count_and_later_ones_do_not(spark, tmp_path):
    source, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    run = lambda: jobs.to_files(jobs.stream_candles(ticks_from(spark, source), "1m", "10 minutes"), out, ckpt).awaitTermination()
    put(spark, source, "1", [("A", 6000, 5.0, 1), ("A", 6600, 6.0, 2)])   # watermark 6000 afterwards
    run()
    put(spark, source, "2", [("A", 6030, 9.0, 3), ("A", 5000, 1.0, 4)])   # in time, and too late
    run()
    put(spark, source, "3", [("A", 9000, 7.0, 5)])
    run()
    got = {row.open_time.timestamp(): (row.high, row.volume) for row in spark.read.parquet(out).collect()}
    assert got == {6000.0: (9.0, 2.0), 6600.0: (6.0, 1.0)}


def test_restart_adds_nothing_twice(spark, tmp_path):
    source, out, ckpt = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    for i in range(3):
        put(spark, source, str(i), [("A", 60 * i, 1.0 + i, i)])
    handled = []

    def handle(df):
        handled.append(1)
        if len(handled) == 2:
            raise RuntimeError("executor lost")
        return df

    with pytest.raises(Exception):
        jobs.each_batch(ticks_from(spark, source), handle, out, ckpt).awaitTermination()
    jobs.each_batch(ticks_from(spark, source), handle, out, ckpt).awaitTermination()
    jobs.each_batch(ticks_from(spark, source), handle, out, ckpt).awaitTermination()
    assert sorted(r.trade_id for r in spark.read.parquet(out).collect()) == [0, 1, 2]
    jobs.write_batch(spark.read.parquet(out).filter("batch_id = 1").drop("batch_id"), 1, out)
    assert spark.read.parquet(out).count() == 3


def split_by_time(spark, df, path, ts_col, parts):
    """Store a table as files in time order, so a stream sees it in that many micro-batches."""
    spans = df.agg(F.min(F.unix_seconds(ts_col)), F.max(F.unix_seconds(ts_col))).first()
    step = (spans[1] - spans[0]) // parts + 1
    for i in range(parts):
        low = spans[0] + i * step
        at = F.unix_seconds(ts_col)
        df.filter((at >= low) & (at < low + step)).coalesce(1).write.mode("append").parquet(f"{path}/{i}")
    return spark.readStream.schema(df.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(path)


def test_indicator_state_carries_across_batches(spark, sf_dir, tmp_path):
    """All fields and ``prev`` equal the batch form over six micro-batches, two of them replayed and late candles."""
    candles = Q.hourly(spark, sf_dir).select(*Q.CANDLE, "vwap").cache()
    folder = str(tmp_path / "in")
    stream = split_by_time(spark, candles, folder, "open_time", 4)
    spans = candles.agg(F.min("open_time"), F.max("open_time")).first()
    late = candles.filter(F.col("open_time") < spans[0] + (spans[1] - spans[0]) / 3).withColumn("close", F.col("close") * 2)
    out = str(tmp_path / "out")
    run = lambda: jobs.to_files(state.stream_indicators(stream), out, str(tmp_path / "ckpt")).awaitTermination()
    run()
    late.coalesce(1).write.parquet(f"{folder}/late")
    candles.coalesce(1).write.parquet(f"{folder}/replayed")
    run()
    want = I.with_indicators(candles, previous=True).orderBy("symbol", "open_time").toPandas()
    got = spark.read.parquet(out).orderBy("symbol", "open_time").toPandas()
    assert len(got) == len(want)
    for name in state.NUMBERS:
        assert list(got[name]) == pytest.approx(list(want[name]), abs=1e-8, nan_ok=True), name
    assert list(got["candle_pattern"]) == list(want["candle_pattern"])
    known = [(g, w) for g, w in zip(got["prev"], want["prev"], strict=True) if g is not None or w is not None]
    assert len(known) == len(want) - want["symbol"].nunique()
    for g, w in known:
        assert (g["open_time"], g["candle_pattern"]) == (w["open_time"], w["candle_pattern"])
        for name in state.NUMBERS:
            assert (g[name] is None) == (w[name] is None) and (g[name] is None or abs(g[name] - w[name]) < 1e-8), name


def test_closing_a_bounded_stream_hands_out_its_last_windows(spark, tmp_path):
    rows = [(k, "X", 1.0 + k, 1.0, 3000 * k) for k in range(6)]
    ticks = spark.createDataFrame(rows, "trade_id bigint, symbol string, price double, quantity double, t bigint").select(
        "trade_id", "symbol", "price", "quantity", F.timestamp_seconds("t").alias("ts")
    )
    ticks.write.parquet(str(tmp_path / "in"))
    out, end, ckpt = (str(tmp_path / name) for name in ("out", "end", "ckpt"))
    source = spark.readStream.schema(ticks.schema).parquet(str(tmp_path / "in"))
    made = jobs.stream_candles(jobs.with_closing(source, end), "1h")
    jobs.to_files(made, out, ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == 4
    jobs.close(ticks.limit(0), end, "1h")
    jobs.to_files(made, out, ckpt).awaitTermination()
    assert spark.read.parquet(out).count() == 4
    jobs.close(ticks, end, "1h")
    jobs.to_files(made, out, ckpt).awaitTermination()
    found = spark.read.parquet(out)
    assert found.count() == 5 and {r.symbol for r in found.collect()} == {"X"}


def test_cooldown_state_carries_across_batches(spark, tmp_path):
    rows = [("r", f"a{i}", 300, 60 * i) for i in range(200)] + [("q", f"b{i}", 3600, 1000 * i) for i in range(12)]
    hits = spark.createDataFrame(rows, "rule_id string, alert_id string, cooldown_seconds int, t bigint").select(
        "rule_id", "alert_id", "cooldown_seconds", F.timestamp_seconds("t").alias("triggered_at")
    )
    stream = split_by_time(spark, hits, str(tmp_path / "in"), "triggered_at", 4)
    out = str(tmp_path / "out")
    jobs.to_files(state.stream_cooldown(stream), out, str(tmp_path / "ckpt")).awaitTermination()
    want = K.cooldown(hits.withColumn("timeframe", F.lit("1m"))).select("alert_id").collect()
    assert sorted(spark.read.parquet(out).select("alert_id").collect()) == sorted(want)


def test_rules_are_read_anew_for_every_batch(spark, sf_dir, tmp_path):
    candles = Q.hourly_indicators(spark, sf_dir)
    stored = str(tmp_path / "candles")
    candles.write.parquet(stored)
    stream = split_by_time(spark, spark.read.parquet(stored), str(tmp_path / "in"), "open_time", 2)
    rules = feeds.rules(spark, sf_dir)
    reads = []

    def read_rules():
        reads.append(1)
        return rules if len(reads) == 1 else rules.withColumn("is_active", F.lit(False))

    out = str(tmp_path / "out")
    jobs.stream_alerts(stream, read_rules, out, str(tmp_path / "ckpt")).awaitTermination()
    assert len(reads) == 2
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 1


def test_zone_jobs_rerun_without_change(spark, sf_dir, tmp_path):
    base = str(tmp_path)
    at = F.get_json_object(F.col("value").cast("string"), "$.ts").cast("timestamp")
    messages = feeds.tick_messages_of(feeds.stream(spark, sf_dir, "events"))
    for _ in range(2):
        medallion.bronze_job(messages, f"{base}/bronze", f"{base}/ckpt", at).awaitTermination()
    assert spark.read.parquet(f"{base}/bronze").count() == feeds.table(spark, sf_dir, "events").count()
    for _ in range(2):
        medallion.silver_job(spark, f"{base}/bronze", f"{base}/silver")
        medallion.gold_job(spark, f"{base}/silver", f"{base}/gold")
    silver, gold = tables.read_days(spark, f"{base}/silver"), tables.read_days(spark, f"{base}/gold")
    counts = silver.count(), gold.count()
    medallion.silver_job(spark, f"{base}/bronze", f"{base}/silver", "2024-01-05", "2024-01-06")
    assert (tables.read_days(spark, f"{base}/silver").count(), gold.count()) == counts
    rules = feeds.rules(spark, sf_dir).withColumn("symbol", F.upper("symbol"))
    medallion.alert_job(spark, f"{base}/gold", rules, f"{base}/alerts", f"{base}/work")
    alerts = spark.read.parquet(f"{base}/alerts")
    assert alerts.count() > 0 and alerts.count() == alerts.select("alert_id").distinct().count()


def test_late_ticks_add_to_a_day_and_move_the_gap_after_it(spark, tmp_path):
    bronze, silver = str(tmp_path / "bronze"), str(tmp_path / "silver")

    def ingest(day, trades):
        rows = [(f'{{"symbol":"a","ts":"2024-01-{at}","price":5.0,"quantity":1.0,"trade_id":{i}}}', f"2024-01-{day}", f"2024-01-{at[:2]}")
                for i, at in trades]
        spark.createDataFrame(rows, "payload string, i string, e string").select(
            "payload", F.to_date("i").alias("ingest_date"), F.to_date("e").alias("event_date")
        ).write.mode("append").partitionBy("event_date", "ingest_date").parquet(bronze)
        medallion.silver_job(spark, bronze, silver, f"2024-01-{day}", f"2024-01-{day}")
        found = tables.read_days(spark, silver).orderBy("open_time").collect()
        return [(r.open_time.strftime("%d %H:%M"), r.volume, r.missing_before) for r in found]

    assert ingest("01", [(1, "01 10:00:00"), (2, "01 10:02:00")]) == [("01 10:00", 1.0, 0), ("01 10:02", 1.0, 1)]
    assert ingest("04", [(3, "04 10:02:00")])[-1] == ("04 10:02", 1.0, 3 * 1440 - 1)
    # Day 1 gets a late trade and a repeated one: both candles stay, and day 4 counts from the new last one.
    assert ingest("05", [(4, "01 10:03:00"), (2, "01 10:02:00")]) == [
        ("01 10:00", 1.0, 0), ("01 10:02", 1.0, 1), ("01 10:03", 1.0, 0), ("04 10:02", 1.0, 3 * 1440 - 2)
    ]
