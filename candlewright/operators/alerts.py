"""Alert events: building, parsing, routing, rendering, audit and history."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright import fixed, schemas
from candlewright.functions.numbers import fixed_text, number_text
from candlewright.functions.timeframes import close_time, day_stamp


def alert_id(rule_id: Column, symbol: Column, timeframe: Column, open_time: Column) -> Column:
    """Same rule and candle, same id: a replay can be told from a new alert."""
    parts = [rule_id, symbol, timeframe, F.unix_micros(open_time).cast("string")]
    return F.sha2(F.concat_ws("|", *parts), 256)


def to_alerts(triggered: DataFrame) -> DataFrame:
    """Triggered rules as alert events; an alert is dated by the close of its candle."""
    row = F.col("triggered_row")
    return triggered.select(
        alert_id(F.col("rule_id"), F.col("symbol"), F.col("timeframe"), row["open_time"]).alias("alert_id"),
        "rule_id", "user_id", "symbol", "timeframe", "action",
        close_time(row["open_time"], F.col("timeframe")).alias("triggered_at"),
        row["close"].alias("close_price"),
        row["rsi_14"].alias("rsi_14"),
        row["macd"].alias("macd"),
        row["volume_ratio"].alias("volume_ratio"),
        row["candle_pattern"].alias("candle_pattern"),
        F.array_join("conditions_met", "; ").alias("message"),
    )


def as_messages(alerts: DataFrame) -> DataFrame:
    """Alert events as topic records: key and JSON value, times to the microsecond."""
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return alerts.select(
        F.col("rule_id").cast("binary").alias("key"),
        F.to_json(F.struct(*alerts.columns), options).cast("binary").alias("value"),
    )


# --- parsing -------------------------------------------------------------------------------------

def with_parse_result(messages: DataFrame) -> DataFrame:
    """Adds ``event`` (parsed alert), ``error`` (null when accepted) and the message text.

    A required key must be present; its value may be null. Anything but a JSON object is refused.
    """
    text = F.try_validate_utf8(F.col("value"))
    parsed = messages.withColumn("text", text).withColumn("_keys", F.json_object_keys("text"))
    absent = F.filter(
        F.array(*[F.lit(k) for k in fixed.REQUIRED_ALERT_KEYS]),
        lambda k: ~F.array_contains("_keys", k),
    )
    return parsed.withColumns({
        "event": F.from_json("text", schemas.ALERT_EVENTS, {"mode": "PERMISSIVE"}),
        "error": F.when(F.col("text").isNull(), "not valid UTF-8")
        .when(F.col("_keys").isNull(), "not a JSON object")
        .when(F.size(absent) > 0, F.concat(F.lit("missing: "), F.array_join(absent, ", "))),
    }).drop("_keys")


def parse_alerts(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Alert events from messages, and the refused messages with the reason."""
    both = with_parse_result(messages)
    valid = both.filter(F.col("error").isNull()).select("event.*")
    return valid, both.filter(F.col("error").isNotNull()).drop("event")


def dead_letters(failed: DataFrame, at: Column) -> DataFrame:
    """Failed events (``error``, ``event`` text) as dead-letter records of their UTC day."""
    return failed.select(
        at.alias("timestamp"), "error", "event", day_stamp(at).alias("dlq_date")
    )


# --- routing -------------------------------------------------------------------------------------

def audit(alerts: DataFrame, rules: DataFrame, dispatched_at: Column) -> DataFrame:
    """Alerts whose rule exists, with dispatch time and the rule's channels."""
    channels = rules.select("rule_id", F.col("notification_channels").alias("channels"))
    return alerts.join(channels, "rule_id").select(
        *alerts.columns, dispatched_at.alias("dispatched_at"), "channels"
    )


def orphans(alerts: DataFrame, rules: DataFrame) -> DataFrame:
    """Alerts of rules that do not exist: skipped, neither retried nor dead-lettered."""
    return alerts.join(rules.select("rule_id"), "rule_id", "left_anti")


def channels_of(alerts: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per alert and channel of its rule, ``supported`` telling if it can be delivered."""
    wanted = rules.select(
        "rule_id", F.explode("notification_channels").alias("channel"), "email_address", "webhook_url"
    )
    return alerts.join(wanted, "rule_id").select(
        *alerts.columns, "channel", "email_address", "webhook_url",
        F.lower("channel").isin(*fixed.CHANNELS).alias("supported"),
    )


def fan_out(alerts: DataFrame, rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Deliveries on supported channels, and the rest."""
    both = channels_of(alerts, rules)
    return both.filter("supported").drop("supported"), both.filter(~F.col("supported")).drop("supported")


# --- rendering -----------------------------------------------------------------------------------

def iso_time(ts: Column) -> Column:
    """2024-01-02T03:04:05, with microseconds only where there are any."""
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(F.lit("")),
    )


def render_message(alerts: DataFrame) -> DataFrame:
    """Adds ``text``: the plain message. Price and ratio of zero read N/A, as absent ones do."""
    c = F.col

    def line(label, shown, present):
        return F.concat(F.lit(label), F.when(present, shown).otherwise(F.lit("N/A")))

    quoted = lambda column, unit="": F.concat(F.lit("`"), column, F.lit(unit + "`"))
    nonzero = lambda name: c(name).isNotNull() & (c(name) != 0)
    # The layout of the message.
    text = F.concat_ws(
        "\n",
        F.concat(F.when(c("action") == "BUY", "🟢").when(c("action") == "SELL", "🔴").otherwise("🔵"),
                 F.lit(" *"), c("action"), F.lit(" Signal Triggered*")),
        F.concat(F.lit("📊 Symbol:    "), quoted(c("symbol")), F.lit(" ("), c("timeframe"), F.lit(")")),
        line("💰 Price:     ", quoted(fixed_text(c("close_price"), 4), " USDT"), nonzero("close_price")),
        line("📈 RSI(14):   ", quoted(fixed_text(c("rsi_14"), 2)), c("rsi_14").isNotNull()),
        line("〰️  MACD:      ", quoted(fixed_text(c("macd"), 4)), c("macd").isNotNull()),
        line("📦 Vol Ratio: ", quoted(fixed_text(c("volume_ratio"), 2), "x"), nonzero("volume_ratio")),
        F.concat(F.lit("🕯️  Pattern:   "), quoted(F.coalesce("candle_pattern", F.lit("None")))),
        F.concat(F.lit("⏰ At:         "), quoted(iso_time(c("triggered_at")))),
        F.concat(F.lit("🔔 Rule ID:   "), quoted(F.substring("rule_id", 1, 8), "...")),
    )
    return alerts.withColumn("text", text)


def render_email(deliveries: DataFrame) -> DataFrame:
    """Adds ``recipient`` and ``subject``; without an address there is no recipient."""
    return deliveries.withColumns({
        "recipient": F.when(F.col("email_address") != "", F.col("email_address")),
        "subject": F.concat(F.lit("[Crypto Alert] "), F.col("action"), F.lit(" Signal – "), F.col("symbol")),
    })


def _json_number(value: Column) -> Column:
    """A double in JSON as other writers show it, 0.00085 and not 8.5E-4; what is no number is quoted."""
    finite = F.abs(value) < float("inf")
    quoted = F.when(F.isnan(value), F.lit('"NaN"')).when(value > 0, F.lit('"Infinity"')).otherwise(F.lit('"-Infinity"'))
    return F.when(value.isNull(), F.lit("null")).when(finite, number_text(value)).otherwise(quoted)


def webhook_payload(alerts: DataFrame) -> DataFrame:
    """Adds ``payload``: the nested JSON body, nulls kept."""
    options = {"ignoreNullFields": "false"}
    head = F.to_json(F.struct(
        F.lit("alert_triggered").alias("event_type"),
        "rule_id", "user_id", "symbol", "timeframe", "action",
        iso_time(F.col("triggered_at")).alias("triggered_at"),
    ), options)
    numbers = [
        F.concat(F.lit(f'"{name}":'), _json_number(F.col(name).cast("double")))
        for name in ("close_price", "rsi_14", "macd", "volume_ratio")
    ]
    # Numbers are written here: to_json shows those below 0.001 and from 10 million on as powers of ten.
    payload = F.concat(
        F.left(head, F.char_length(head) - 1), F.lit(',"data":{'), F.concat_ws(",", *numbers), F.lit(","),
        F.substring(F.to_json(F.struct("candle_pattern"), options), 2, 2 ** 31 - 1), F.lit("}"),
    )
    return alerts.withColumn("payload", payload)


# --- statistics ----------------------------------------------------------------------------------

def trigger_stats(rules: DataFrame, audited: DataFrame) -> DataFrame:
    """How often each rule fired and when last; rules that never did have 0 and null."""
    fired = audited.groupBy("rule_id").agg(
        F.count("*").alias("_n"), F.max("dispatched_at").alias("_last")
    )
    return rules.drop("trigger_count", "last_triggered_at").join(fired, "rule_id", "left").withColumns({
        "trigger_count": F.coalesce("_n", F.lit(0)), "last_triggered_at": F.col("_last"),
    }).drop("_n", "_last")


def history(events: DataFrame, rule_id: str, user_id: str, limit: int = fixed.DEFAULT_HISTORY) -> DataFrame:
    """The latest events of one rule, for its owner."""
    _check_history(limit)
    own = events.filter((F.col("rule_id") == rule_id) & (F.col("user_id") == user_id))
    return own.orderBy(F.desc("triggered_at"), "alert_id").limit(limit)


def histories(events: DataFrame, limit: int = fixed.DEFAULT_HISTORY) -> DataFrame:
    """The latest events of every rule; each task keeps at most ``limit`` per rule before shuffling."""
    _check_history(limit)
    newest = Window.partitionBy("rule_id", "user_id").orderBy(F.desc("triggered_at"), "alert_id")
    return events.withColumn("position", F.row_number().over(newest)).filter(F.col("position") <= limit)


def _check_history(limit: int) -> None:
    if not 1 <= limit <= fixed.MAX_HISTORY:
        raise ValueError(f"limit must be within 1..{fixed.MAX_HISTORY}")


def request_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("method", "path", "status").agg(F.count("*").alias("requests"))


def recent_duration(log: DataFrame, sample: int = fixed.DURATION_SAMPLE) -> DataFrame:
    """Mean duration of the latest requests: a top-k by time, then one average."""
    latest = log.orderBy(F.desc("ts"), F.desc("duration")).limit(sample)
    return latest.agg(F.avg("duration").alias("mean_duration"), F.count("*").alias("sampled"))
