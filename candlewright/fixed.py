"""Fixed values of the rule language and of the delivery contract."""

# Timeframes, with their length in seconds.
TIMEFRAME_SECONDS = {
    "1m": 60,
    "3m": 180,
    "5m": 300,
    "15m": 900,
    "30m": 1800,
    "1h": 3600,
    "4h": 14400,
    "1d": 86400,
}

# Domains a rule is validated against.
ACTIONS = ["BUY", "SELL", "WATCH"]
LOGICS = ["AND", "OR"]
OPERATORS = [">", "<", ">=", "<=", "==", "!=", "crosses_above", "crosses_below"]
CHANNELS = ["email", "webhook"]
NUMERIC_FIELDS = [
    "close", "open", "high", "low", "volume",
    "rsi_14", "macd", "macd_signal", "macd_hist",
    "ma7", "ma25", "ma99", "bb_upper", "bb_lower", "atr_14",
    "volume_ratio", "price_change_pct", "vwap",
]
TEXT_FIELDS = ["candle_pattern"]
PATTERNS = [
    "DOJI", "HAMMER", "SHOOTING_STAR", "BULLISH_ENGULFING",
    "BEARISH_ENGULFING", "BULLISH", "BEARISH", "NEUTRAL",
]

# Rule limits and defaults.
MIN_CONDITIONS, MAX_CONDITIONS = 1, 10
MIN_COOLDOWN, MAX_COOLDOWN, DEFAULT_COOLDOWN = 60, 86400, 300
DEFAULT_LOGIC = "AND"
DEFAULT_CHANNELS = ["email"]

# Keys an alert message must carry, retry policy, paging.
REQUIRED_ALERT_KEYS = ["alert_id", "rule_id", "user_id", "symbol"]
MAX_ATTEMPTS, BACKOFF_SECONDS = 3, 2.0
DEFAULT_PAGE_SIZE, MAX_PAGE_SIZE = 20, 100
DEFAULT_HISTORY, MAX_HISTORY = 50, 200
DURATION_SAMPLE = 1000

# Days each zone is kept.
ZONE_RETENTION_DAYS = {"bronze": 7, "silver": 14, "gold": 30}

# Topic names.
TOPIC_TICKS, TOPIC_OHLCV, TOPIC_ORDER_BOOK = "raw-crypto-ticks", "raw-ohlcv", "raw-orderbook"
TOPIC_SIGNALS, TOPIC_ALERTS = "processed-signals", "alert-events"
