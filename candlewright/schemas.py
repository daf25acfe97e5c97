"""Table schemas, as DDL text Spark parses."""

TICKS = "symbol string, ts timestamp, price double, quantity double, trade_id bigint"

CANDLES = (
    "symbol string, timeframe string, open_time timestamp, "
    "open double, high double, low double, close double, volume double"
)

ORDER_BOOK = (
    "symbol string, ts timestamp, bid_price double, bid_qty double, "
    "ask_price double, ask_qty double"
)

CONDITIONS = "array<struct<field: string, operator: string, value_num: double, value_str: string>>"

RULES = (
    "rule_id string, user_id string, symbol string, timeframe string, "
    f"conditions {CONDITIONS}, logic string, action string, "
    "notification_channels array<string>, email_address string, webhook_url string, "
    "cooldown_seconds int, is_active boolean, created_at timestamp, updated_at timestamp, "
    "last_triggered_at timestamp, trigger_count int"
)

RULE_PATCH = (
    f"conditions {CONDITIONS}, logic string, action string, "
    "notification_channels array<string>, email_address string, webhook_url string, "
    "cooldown_seconds int, is_active boolean"
)

RULE_CHANGES = (
    "rule_id string, user_id string, op string, ts timestamp, "
    f"payload struct<symbol: string, timeframe: string, conditions: {CONDITIONS}, "
    "logic: string, action: string, notification_channels: array<string>, "
    "email_address: string, webhook_url: string, cooldown_seconds: int, is_active: boolean>"
)

ALERT_EVENTS = (
    "alert_id string, rule_id string, user_id string, symbol string, timeframe string, "
    "action string, triggered_at timestamp, close_price double, rsi_14 double, macd double, "
    "volume_ratio double, candle_pattern string, message string"
)

DEAD_LETTERS = "timestamp timestamp, error string, event string, dlq_date string"

DELIVERY_LOG = (
    "alert_id string, channel string, attempts int, status string, last_code int, error string"
)

REQUEST_LOG = "ts timestamp, method string, path string, status int, duration double"
