import json

from pyspark.sql import functions as F

from candlewright.operators import alerts as A
from candlewright.operators import delivery as D
from candlewright.plans import medallion
from candlewright.sources import feeds


def test_attempts_statuses_and_counters(spark):
    def answers(row):
        kind = row.alert_id.split("-")[0]
        if kind == "raise":
            raise TimeoutError("timed out")
        return {"ok": 200, "gone": 404, "busy": 503}[kind]

    rows = spark.createDataFrame([(f"{k}-1", "email") for k in ("ok", "gone", "busy", "raise")], "alert_id string, channel string")
    log = D.deliver(rows, answers, lambda s: None)
    got = {r.alert_id: (r.attempts, r.status, r.last_code, r.error) for r in log.collect()}
    assert got == {
        "ok-1": (1, "dispatched", 200, None), "gone-1": (1, "not_found", 404, "rule not found"),
        "busy-1": (3, "failed", 503, "Failed after 3 attempts"), "raise-1": (3, "failed", None, "timed out"),
    }
    assert D.delivery_stats(log).first().asDict() == {"dispatched": 1, "failed": 3, "retried": 6}
    letters = D.undelivered(log, rows, F.lit("2024-01-02 03:04:05").cast("timestamp")).collect()
    assert sorted(json.loads(r.event)["alert_id"] for r in letters) == ["busy-1", "raise-1"]
    assert {r.dlq_date for r in letters} == {"20240102"}
    assert {r.error for r in letters} == {"Failed after 3 attempts"}


def test_backoff_doubles_and_ends_before_the_last_attempt():
    waits = []
    D._attempt(lambda row: 500, None, 3, 2.0, waits.append)
    assert waits == [2.0, 4.0]


def test_a_present_null_key_is_accepted_and_an_absent_one_is_not(spark):
    texts = ['{"alert_id":null,"rule_id":"r","user_id":"u","symbol":"s"}', '{"alert_id":"a","rule_id":"r","symbol":"s"}',
             '["alert_id","rule_id","user_id","symbol"]', "7", "", '{"alert_id":"a"', "null"]
    rows = [(bytearray(t.encode()),) for t in texts] + [(bytearray(b'{"alert_id":"\xff"}'),)]
    valid, refused = A.parse_alerts(spark.createDataFrame(rows, "value binary"))
    assert [r.rule_id for r in valid.collect()] == ["r"]
    assert sorted(r.error for r in refused.collect()) == sorted(
        ["missing: user_id"] + ["not a JSON object"] * 5 + ["not valid UTF-8"]
    )


def test_message_reads_na_for_zero_price_and_ratio_only(spark):
    row = spark.createDataFrame(
        [("a", "rule-12345", "X", "1h", "BUY", 0.0, 0.0, 0.0, 0.0, None)],
        "alert_id string, rule_id string, symbol string, timeframe string, action string, close_price double, rsi_14 double, macd double, volume_ratio double, candle_pattern string",
    ).withColumn("triggered_at", F.lit("2024-01-02 03:04:05").cast("timestamp"))
    lines = A.render_message(row).first().text.split("\n")
    assert lines[2].endswith("N/A") and lines[5].endswith("N/A")
    assert "`0.00`" in lines[3] and "`0.0000`" in lines[4] and "`None`" in lines[6]
    assert lines[8].endswith("`rule-123...`") and "`2024-01-02T03:04:05`" in lines[7]


def test_webhook_numbers_are_plain_however_small_or_large(spark):
    numbers = [(0.0008500000000058208, 12345678.5), (-0.00085, 1e7), (1e-5, 1e16), (0.0, -0.0), (None, 1.25)]
    rows = [(k, "rule-1", 'u"1', "X", "1h", "BUY", a, None, b, 0.5, None) for k, (a, b) in enumerate(numbers)]
    alerts = spark.createDataFrame(
        rows, "k int, rule_id string, user_id string, symbol string, timeframe string, action string, close_price double, rsi_14 double, macd double, volume_ratio double, candle_pattern string",
    ).withColumn("triggered_at", F.lit("2024-01-02 03:04:05").cast("timestamp"))
    for r in A.webhook_payload(alerts).collect():
        body = {
            "event_type": "alert_triggered", "rule_id": "rule-1", "user_id": 'u"1', "symbol": "X", "timeframe": "1h", "action": "BUY",
            "triggered_at": "2024-01-02T03:04:05", "data": dict(close_price=r.close_price, rsi_14=None, macd=r.macd, volume_ratio=0.5, candle_pattern=None),
        }
        assert r.payload == json.dumps(body, separators=(",", ":"))


def test_dispatch_job_end_to_end(spark, sf_dir, tmp_path):
    rules = feeds.stored_rules(spark, sf_dir)
    alerts = feeds.alerts(spark, sf_dir)
    messages = A.as_messages(alerts).select("value").unionByName(feeds.alert_messages(spark, sf_dir).filter("offset % 7 = 1").select("value"))
    from candlewright.plans.queries import no_sleep, scripted_sender

    where = medallion.dispatch_job(
        spark, messages, rules, str(tmp_path / "out"), scripted_sender, no_sleep, F.lit("2024-02-01").cast("timestamp")
    )
    known = alerts.join(rules.select("rule_id"), "rule_id").count()
    assert spark.read.parquet(where["audit"]).count() == known
    log = spark.read.parquet(where["log"])
    failed = log.filter("status = 'failed'").count()
    refused = A.parse_alerts(messages)[1].count()
    letters = spark.read.json(where["dead_letters"])
    assert failed > 0 and refused > 0 and letters.count() == failed + refused
    channels = spark.read.parquet(where["refused_channels"]).count()
    again = messages.filter("value is not null").limit(20)
    for _ in range(2):  # another batch adds its rows, its repetition none
        medallion.dispatch_job(
            spark, again, rules, str(tmp_path / "out"), scripted_sender, no_sleep, F.lit("2024-02-02").cast("timestamp"), 1
        )
    audit = spark.read.parquet(where["audit"])
    assert audit.filter("batch_id = 0").count() == known
    valid = A.parse_alerts(again)[0].join(rules.select("rule_id"), "rule_id").count()
    assert audit.filter("batch_id = 1").count() == valid
    assert spark.read.parquet(where["log"]).filter("batch_id = 0").count() == log.filter("batch_id = 0").count()
    assert spark.read.parquet(where["refused_channels"]).filter("batch_id = 0").count() == channels
