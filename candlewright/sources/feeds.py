"""Market feeds derived from the star-schema tables the queries are run on.

Each feed is a projection of a whole table, so its size follows that table: events are trades,
customers own alert rules, orders are changes to rules and alert messages.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.session import prepare

SYMBOLS = ["click", "error", "purchase", "signup", "view"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ticks_of(table(spark, sf_dir, "events"))


def ticks_of(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("quantity"),
        F.col("event_id").alias("trade_id"),
    )


def tick_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tick_messages_of(table(spark, sf_dir, "events"))


def tick_messages_of(events: DataFrame) -> DataFrame:
    """Trades as a topic delivers them: JSON bytes with topic, partition and offset."""
    tick = ticks_of(events).withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    return tick.select(
        F.lit("raw-crypto-ticks").alias("topic"),
        F.pmod(F.col("trade_id"), F.lit(5)).cast("int").alias("partition"),
        F.floor(F.col("trade_id") / 5).alias("offset"),
        F.to_json(F.struct("symbol", "ts", "price", "quantity", "trade_id")).cast("binary").alias("value"),
    )


def _condition(field: str, operator: str, number: Column | None = None, text: Column | None = None):
    none = F.lit(None)
    return F.struct(
        F.lit(field).alias("field"),
        F.lit(operator).alias("operator"),
        (none if number is None else number).cast("double").alias("value_num"),
        (none if text is None else text).cast("string").alias("value_str"),
    )


def rule_id(custkey: Column) -> Column:
    return F.concat(F.lit("rule-"), F.lpad(custkey.cast("string"), 10, "0"))


def rules_of(customers: DataFrame) -> DataFrame:
    """One rule per customer: six kinds of conditions with thresholds spread by customer key."""
    k = F.col("c_custkey")
    kind = F.pmod(F.floor(k / 5), F.lit(6))
    conditions = (
        F.when(kind == 0, F.array(
            _condition("rsi_14", "<", 25 + k % 10),
            _condition("volume_ratio", ">", 1 + (k % 7) / 5)))
        .when(kind == 1, F.array(_condition("close", "crosses_above", 60 + k % 90)))
        .when(kind == 2, F.array(
            _condition("candle_pattern", "==", text=F.lit("hammer")),
            _condition("volume_ratio", ">", 1 + (k % 7) / 5)))
        .when(kind == 3, F.array(
            _condition("macd_hist", "crosses_below", F.lit(0)),
            _condition("rsi_14", ">", 45 + k % 10)))
        .when(kind == 4, F.array(
            _condition("candle_pattern", "==", text=F.lit("DOJI")),
            _condition("price_change_pct", ">", 400 + k % 500)))
        .otherwise(F.array(
            _condition("close", "crosses_below", 10 + k % 20),
            _condition("candle_pattern", "!=", text=F.lit("BEARISH")),
            _condition("ma25", "<=", 45 + k % 20)))
    )
    user = F.concat(F.lit("user-"), F.col("c_nationkey"))
    channels = (
        F.when(k % 4 == 0, F.array(F.lit("email")))
        .when(k % 4 == 1, F.array(F.lit("webhook")))
        .when(k % 4 == 2, F.array(F.lit("email"), F.lit("Webhook")))
        .otherwise(F.array(F.lit("telegram"), F.lit("email")))
    )
    created = F.timestamp_seconds(F.lit(1672531200) + k * 60)
    return customers.select(
        rule_id(k).alias("rule_id"),
        user.alias("user_id"),
        F.get(F.array(*[F.lit(s) for s in SYMBOLS]), (k % 5).cast("int")).alias("symbol"),
        F.when(k % 4 == 3, "4h").otherwise("1h").alias("timeframe"),
        conditions.alias("conditions"),
        F.when(kind == 4, "or").when(kind == 2, F.lit(None)).otherwise("AND").alias("logic"),
        F.get(F.array(F.lit("BUY"), F.lit("SELL"), F.lit("WATCH")), (k % 3).cast("int")).alias("action"),
        channels.alias("notification_channels"),
        F.when(k % 4 != 1, F.concat(user, F.lit("@example.com"))).alias("email_address"),
        F.when(F.array_contains(channels, "webhook") | F.array_contains(channels, "Webhook"),
               F.concat(F.lit("https://hooks.example.com/"), k.cast("string"))).alias("webhook_url"),
        F.get(F.array(*[F.lit(s) for s in (300, 7200, 21600, 86400)]), (F.floor(k / 2) % 4).cast("int")).alias("cooldown_seconds"),
        F.when(k % 11 == 0, False).when(k % 13 != 0, True).alias("is_active"),
        created.alias("created_at"),
        created.alias("updated_at"),
        F.lit(None).cast("timestamp").alias("last_triggered_at"),
        F.lit(0).alias("trigger_count"),
    )


def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules_of(table(spark, sf_dir, "customer"))


def stored_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules table before changes: customers in debt have no rule yet."""
    return rules_of(table(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 0))


def raw_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules as users submit them, with every kind of mistake somewhere."""
    parsed = rules_of(table(spark, sf_dir, "customer"))
    number = F.regexp_extract("rule_id", r"(\d+)$", 1).cast("bigint")
    extra = F.expr("transform(sequence(1, 11), i -> struct('close' AS field, '>' AS operator, "
                   "cast(i AS double) AS value_num, cast(null AS string) AS value_str))")
    return (
        parsed.withColumn("_k", number)
        .withColumn("symbol", F.when(F.col("_k") % 2 == 0, F.col("symbol")).otherwise(F.initcap("symbol")))
        .withColumn("timeframe", F.when(F.col("_k") % 19 == 0, "2h").otherwise(F.col("timeframe")))
        .withColumn("logic", F.when(F.col("_k") % 17 == 0, "XOR").otherwise(F.upper("logic")))
        .withColumn("action", F.when(F.col("_k") % 53 == 0, "HOLD").otherwise(F.col("action")))
        .withColumn("cooldown_seconds", F.when(F.col("_k") % 23 == 0, 59).when(F.col("_k") % 25 == 0, 86401)
                    .when(F.col("_k") % 3 == 0, F.lit(None)).otherwise(F.col("cooldown_seconds")))
        .withColumn("notification_channels", F.when(F.col("_k") % 7 == 0, F.lit(None))
                    .otherwise(F.transform("notification_channels", F.lower)))
        .withColumn("email_address", F.when(F.col("_k") % 43 == 0, "nobody").otherwise(F.col("email_address")))
        .withColumn("webhook_url", F.when(F.col("_k") % 47 == 0, "").otherwise(F.col("webhook_url")))
        .withColumn(
            "conditions",
            F.when(F.col("_k") % 29 == 0, F.filter("conditions", lambda c: F.lit(False)))
            .when(F.col("_k") % 31 == 0, extra)
            .when(F.col("_k") % 37 == 0, F.array(_condition("candle_pattern", "==", text=F.lit("COMET"))))
            .when(F.col("_k") % 41 == 0, F.array(_condition("rsi_14", "<", text=F.lit("low"))))
            .when(F.col("_k") % 59 == 0, F.array(_condition("rsi_15", "~", F.lit(1))))
            .otherwise(F.col("conditions")),
        )
        .drop("_k")
    )


def rule_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order changes the rule of its customer; some come from a user who does not own it."""
    n = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders")
    owners = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey"
    )
    op = (
        F.when(n % 97 == 6, "delete").when(n % 7 < 4, "patch").when(n % 7 < 6, "toggle").otherwise("create")
    )
    patch = op == "patch"
    created = op == "create"
    one = F.array(_condition("close", ">", n % 100))
    payload = F.struct(
        F.when(created, F.lit("view")).alias("symbol"),
        F.when(created, F.lit("1h")).alias("timeframe"),
        F.when(created | (patch & (n % 13 == 0)), one).alias("conditions"),
        F.when(patch & (n % 5 == 0), "OR").alias("logic"),
        F.when(created, "BUY").when(patch & (n % 3 == 0), "SELL").alias("action"),
        F.when(patch & (n % 17 == 0), F.array(F.lit("webhook"))).alias("notification_channels"),
        F.when(created | (patch & (n % 11 == 0)), F.concat(F.lit("order"), n.cast("string"), F.lit("@example.com"))).alias("email_address"),
        F.when(patch & (n % 17 == 0), F.concat(F.lit("https://hooks.example.com/o/"), n.cast("string"))).alias("webhook_url"),
        F.when(patch & (n % 4 == 0), (60 + n % 1000).cast("int")).alias("cooldown_seconds"),
        F.when(patch & (n % 6 == 0), n % 12 == 0).alias("is_active"),
    )
    return orders.join(owners, "o_custkey").select(
        rule_id(F.col("o_custkey")).alias("rule_id"),
        F.when(n % 10 == 0, "user-unknown").otherwise(F.concat(F.lit("user-"), F.col("c_nationkey"))).alias("user_id"),
        op.alias("op"),
        _order_time().alias("ts"),
        payload.alias("payload"),
    )


def _order_time() -> Column:
    return F.timestamp_micros(
        F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey")
    )


def alerts_of(orders: DataFrame) -> DataFrame:
    """Alert events as the bus carries them, one per order, addressed to its customer's rule."""
    n = F.col("o_orderkey")
    price = F.col("o_totalprice")
    return orders.select(
        F.concat(F.lit("alert-"), n.cast("string")).alias("alert_id"),
        rule_id(F.col("o_custkey")).alias("rule_id"),
        F.concat(F.lit("user-"), (F.col("o_custkey") % 25).cast("string")).alias("user_id"),
        F.get(F.array(*[F.lit(s) for s in SYMBOLS]), (F.col("o_custkey") % 5).cast("int")).alias("symbol"),
        F.lit("1h").alias("timeframe"),
        F.get(F.array(F.lit("BUY"), F.lit("SELL"), F.lit("WATCH")), (n % 3).cast("int")).alias("action"),
        _order_time().alias("triggered_at"),
        F.when(n % 9 == 0, 0.0).when(n % 10 != 0, price / 8).alias("close_price"),
        F.when(n % 6 != 0, (n % 10000) / 64).alias("rsi_14"),
        F.when(n % 8 != 0, (250000 - price) / 1000).alias("macd"),
        F.when(n % 12 == 0, 0.0).when(n % 5 != 0, (n % 1000) / 200).alias("volume_ratio"),
        F.when(n % 4 != 0, "HAMMER").alias("candle_pattern"),
        F.lit(None).cast("string").alias("message"),
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts_of(table(spark, sf_dir, "orders"))


def alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert events as JSON bytes, with every way a message can be broken."""
    n = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders")
    key = lambda name, value: F.concat(F.lit(f'"{name}": "'), value.cast("string"), F.lit('"'))
    body = F.concat_ws(
        ", ",
        key("alert_id", n),
        F.when(n % 7 != 1, key("rule_id", F.col("o_custkey"))),
        F.when(n % 11 == 2, F.lit('"user_id": null')).when(n % 5 != 2, key("user_id", F.col("o_custkey") % 25)),
        key("symbol", F.col("o_orderpriority")),
        F.concat(F.lit('"close_price": '), F.col("o_totalprice").cast("string")),
    )
    text = (
        F.when(n % 13 == 3, F.lit('["alert_id", "rule_id", "user_id", "symbol"]'))
        .when(n % 17 == 4, n.cast("string"))
        .when(n % 19 == 5, F.concat(F.lit("{"), body))
        .when(n % 23 == 6, F.lit(""))
        .otherwise(F.concat(F.lit("{"), body, F.lit("}")))
    )
    return orders.select(
        n.alias("offset"),
        F.when(n % 29 == 7, F.concat(text.cast("binary"), F.lit(b"\xff"))).otherwise(text.cast("binary")).alias("value"),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("method"),
        F.concat(F.lit("/u/"), (F.col("user_id") % 10).cast("string")).alias("path"),
        (200 + 204 * (F.col("value") > 100).cast("int")).alias("status"),
        F.col("value").alias("duration"),
    )


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a file stream."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
