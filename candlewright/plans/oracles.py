"""SQL counterparts of the registered queries, for a single-node check of their results."""

ORACLES: dict[str, str] = {}


def _ctes(*names: str) -> str:
    """WITH clause holding the named fragments and what they build on, in order."""
    needed: list[str] = []

    def add(name):
        for other in NEEDS.get(name, ()):
            add(other)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({FRAGMENTS[n]})" for n in needed) + "\n"


SYMBOLS = "['click', 'error', 'purchase', 'signup', 'view']"
RULE_ID = "'rule-' || lpad({0}::varchar, 10, '0')"


def _bucket(seconds: int, ts: str) -> str:
    return f"make_timestamp((epoch_us({ts}) // {seconds * 1000000}) * {seconds * 1000000})"


def _exact(value: str) -> str:
    """Sum of doubles without rounding, as integers in units of 2^-64, rounded once at the end."""
    half = 2 ** 52
    units = f"sum((({value}) * {2 ** 64}.0::double)::hugeint)"
    return f"(({units} // {half})::double * {half}.0::double + ({units} % {half})::double) / {2 ** 64}.0::double"


def _candles(seconds: int, name: str) -> str:
    return f"""
SELECT symbol, '{name}' AS timeframe, {_bucket(seconds, 'ts')} AS open_time,
  arg_min(price, (ts, trade_id)) AS open, max(price) AS high, min(price) AS low,
  arg_max(price, (ts, trade_id)) AS close,
  sum(quantity::decimal(18,0))::double AS volume,
  {_exact('price * quantity')} AS notional
FROM ticks GROUP BY ALL"""


def _longer(seconds: int, name: str) -> str:
    """Candles of a longer timeframe from those of minutes."""
    return f"""
SELECT symbol, '{name}' AS timeframe, {_bucket(seconds, 'm.open_time')} AS open_time,
  arg_min(open, m.open_time) AS open, max(high) AS high, min(low) AS low, arg_max(close, m.open_time) AS close,
  sum(volume::decimal(18,0))::double AS volume, {_exact('notional')} AS notional
FROM minutes m GROUP BY symbol, 3"""


def _frame(n: int) -> str:
    return f"OVER (PARTITION BY symbol, timeframe ORDER BY open_time ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


SERIES = "OVER (PARTITION BY symbol, timeframe ORDER BY open_time)"


def _mean(column: str, n: int) -> str:
    """Mean of a full frame, added up in row order."""
    frame = _frame(n)
    return (
        f"CASE WHEN count({column}) {frame} = {n} THEN "
        f"list_reduce(list({column}) {frame}, lambda a, b: a + b) / {n} END"
    )


KIND = "((c_custkey // 5) % 6)"

def _n(expression: str) -> str:
    return f"({expression})::double::varchar"


# Each rule kind: its conditions as (words, value, field, test), for customer key k and a candle row.
CONDITIONS = {
    0: [("rsi_14 < ", _n("25 + k % 10"), "rsi_14", "rsi_14 < 25 + k % 10"),
        ("volume_ratio > ", _n("1 + (k % 7) / 5"), "volume_ratio", "volume_ratio > 1 + (k % 7) / 5")],
    1: [("close crosses_above ", _n("60 + k % 90"), "close", "pc <= 60 + k % 90 AND close > 60 + k % 90")],
    2: [("candle_pattern == ", "'hammer'", "candle_pattern", "candle_pattern = 'HAMMER'"),
        ("volume_ratio > ", _n("1 + (k % 7) / 5"), "volume_ratio", "volume_ratio > 1 + (k % 7) / 5")],
    3: [("macd_hist crosses_below ", _n("0"), "macd_hist", "ph >= 0 AND macd_hist < 0"),
        ("rsi_14 > ", _n("45 + k % 10"), "rsi_14", "rsi_14 > 45 + k % 10")],
    4: [("candle_pattern == ", "'DOJI'", "candle_pattern", "candle_pattern = 'DOJI'"),
        ("price_change_pct > ", _n("400 + k % 500"), "price_change_pct", "price_change_pct > 400 + k % 500")],
    5: [("close crosses_below ", _n("10 + k % 20"), "close", "pc >= 10 + k % 20 AND close < 10 + k % 20"),
        ("candle_pattern != ", "'BEARISH'", "candle_pattern", "candle_pattern <> 'BEARISH'"),
        ("ma25 <= ", _n("45 + k % 20"), "ma25", "ma25 <= 45 + k % 20")],
}


def _hit() -> str:
    parts = []
    for kind, conditions in CONDITIONS.items():
        joiner = " OR " if kind == 4 else " AND "
        test = joiner.join(f"coalesce({t}, false)" for _, _, _, t in conditions)
        parts.append(f"WHEN kind = {kind} THEN {test}")
    return "CASE " + " ".join(parts) + " END"


def _met() -> str:
    parts = []
    for kind, conditions in CONDITIONS.items():
        words = []
        for text, value, field, test in conditions:
            mark = f"CASE WHEN coalesce({test}, false) THEN '✓' ELSE '✗' END"
            said = f"'{text}' || {value} || ' → ' || {mark}"
            if "crosses" in text:
                said = f"CASE WHEN pc IS NULL THEN 'No previous data for {field}' ELSE {said} END"
            words.append(f"CASE WHEN {field} IS NULL THEN '{field} is None' ELSE {said} END")
        parts.append(f"WHEN kind = {kind} THEN concat_ws('; ', {', '.join(words)})")
    return "CASE " + " ".join(parts) + " END"


RULE_SELECT = f"""
SELECT c_custkey AS k, {KIND} AS kind, {RULE_ID.format('c_custkey')} AS rule_id,
  'user-' || c_nationkey AS user_id, {SYMBOLS}[c_custkey % 5 + 1] AS symbol,
  CASE WHEN c_custkey % 4 = 3 THEN '4h' ELSE '1h' END AS timeframe,
  CASE WHEN {KIND} = 4 THEN 'or' WHEN {KIND} = 2 THEN NULL ELSE 'AND' END AS logic,
  ['BUY', 'SELL', 'WATCH'][c_custkey % 3 + 1] AS action,
  CASE c_custkey % 4 WHEN 0 THEN ['email'] WHEN 1 THEN ['webhook'] WHEN 2 THEN ['email', 'Webhook']
    ELSE ['telegram', 'email'] END AS notification_channels,
  CASE WHEN c_custkey % 4 <> 1 THEN 'user-' || c_nationkey || '@example.com' END AS email_address,
  CASE WHEN c_custkey % 4 IN (1, 2) THEN 'https://hooks.example.com/' || c_custkey END AS webhook_url,
  [300, 7200, 21600, 86400][(c_custkey // 2) % 4 + 1] AS cooldown_seconds,
  CASE WHEN c_custkey % 11 = 0 THEN false WHEN c_custkey % 13 <> 0 THEN true END AS is_active,
  make_timestamp((1672531200 + c_custkey * 60) * 1000000) AS created_at,
  CASE {KIND} WHEN 1 THEN 1 WHEN 5 THEN 3 ELSE 2 END AS n_conditions,
  CASE {KIND} WHEN 0 THEN 'rsi_14 < ' || {_n('25 + c_custkey % 10')}
    WHEN 1 THEN 'close crosses_above ' || {_n('60 + c_custkey % 90')}
    WHEN 2 THEN 'candle_pattern == hammer' WHEN 3 THEN 'macd_hist crosses_below 0.0'
    WHEN 4 THEN 'candle_pattern == DOJI' ELSE 'close crosses_below ' || {_n('10 + c_custkey % 20')}
  END AS first_condition
FROM customer"""

ALERT_TIME = "make_timestamp(epoch_us(o_orderdate) + o_orderkey)"

FRAGMENTS = {
    "ticks": """
SELECT event_type AS symbol, ts, value AS price, (props->>'$.k')::double AS quantity,
  event_id AS trade_id FROM events""",
    "candles": _candles(3600, "1h"),
    "minutes": _candles(60, "1m"),
    "numbered": f"SELECT *, row_number() {SERIES} AS rn FROM candles",
    "ema": """
SELECT symbol, timeframe, open_time, rn, close AS e12, close AS e26, 0.0::double AS sig
FROM numbered WHERE rn = 1
UNION ALL
SELECT n.symbol, n.timeframe, n.open_time, n.rn,
  (2.0::double / 13) * n.close + (1 - 2.0::double / 13) * e.e12,
  (2.0::double / 27) * n.close + (1 - 2.0::double / 27) * e.e26,
  (2.0::double / 10) * (((2.0::double / 13) * n.close + (1 - 2.0::double / 13) * e.e12)
    - ((2.0::double / 27) * n.close + (1 - 2.0::double / 27) * e.e26)) + (1 - 2.0::double / 10) * e.sig
FROM ema e JOIN numbered n ON n.symbol = e.symbol AND n.timeframe = e.timeframe AND n.rn = e.rn + 1""",
    "macd_lines": """
SELECT symbol, timeframe, open_time, e12 - e26 AS macd, sig AS macd_signal,
  e12 - e26 - sig AS macd_hist FROM ema""",
    "moves": f"""
SELECT *, lag(close) {SERIES} AS pc, lag(open) {SERIES} AS po, lag(open_time) {SERIES} AS pt,
  lag(volume) {SERIES} AS pv,
  greatest(close - lag(close) {SERIES}, 0) AS g0, greatest(lag(close) {SERIES} - close, 0) AS l0
FROM candles""",
    "ranged": """
SELECT *, CASE WHEN pc IS NOT NULL THEN g0 END AS gain, CASE WHEN pc IS NOT NULL THEN l0 END AS loss,
  greatest(high - low, abs(high - pc), abs(low - pc)) AS tr FROM moves""",
    "rolled": f"""
SELECT *, {_mean('close', 7)} AS ma7, {_mean('close', 25)} AS ma25, {_mean('close', 99)} AS ma99,
  {_mean('close', 20)} AS bb_middle,
  CASE WHEN count(close) {_frame(20)} = 20 THEN stddev_pop(close) {_frame(20)} END AS sd,
  {_mean('gain', 14)} AS up, {_mean('loss', 14)} AS down, {_mean('tr', 14)} AS atr_14,
  {_mean('volume', 20)} AS usual
FROM ranged""",
    "indicators": f"""
SELECT r.*, bb_middle + 2 * sd AS bb_upper, bb_middle - 2 * sd AS bb_lower,
  CASE WHEN up IS NULL THEN NULL WHEN up = 0 AND down = 0 THEN 50.0 WHEN down = 0 THEN 100.0
    ELSE 100.0::double - 100.0::double / (1.0::double + up / down) END AS rsi_14,
  CASE WHEN usual <> 0 THEN volume / usual END AS volume_ratio,
  CASE WHEN pc <> 0 THEN (close / pc - 1) * 100 END AS price_change_pct,
  CASE WHEN close > open AND pc < po AND open <= pc AND close >= po THEN 'BULLISH_ENGULFING'
    WHEN close < open AND pc > po AND open >= pc AND close <= po THEN 'BEARISH_ENGULFING'
    WHEN high - low = 0 THEN 'NEUTRAL'
    WHEN abs(close - open) <= (high - low) * 0.1::double THEN 'DOJI'
    WHEN least(open, close) - low >= abs(close - open) * 2 AND high - greatest(open, close) <= abs(close - open) THEN 'HAMMER'
    WHEN high - greatest(open, close) >= abs(close - open) * 2 AND least(open, close) - low <= abs(close - open) THEN 'SHOOTING_STAR'
    WHEN close > open THEN 'BULLISH' WHEN close < open THEN 'BEARISH' ELSE 'NEUTRAL' END AS candle_pattern
FROM rolled r""",
    "full_candles": f"""
SELECT i.*, m.macd, m.macd_signal, m.macd_hist,
  lag(m.macd_hist) OVER (PARTITION BY i.symbol, i.timeframe ORDER BY i.open_time) AS ph
FROM indicators i JOIN macd_lines m USING (symbol, timeframe, open_time)""",
    "rules": RULE_SELECT,
    "stored": RULE_SELECT + " WHERE c_acctbal >= 0",
    "triggered": f"""
SELECT r.k, r.kind, r.rule_id, r.user_id, r.action, r.cooldown_seconds, r.n_conditions, c.*
FROM full_candles c JOIN rules r ON r.symbol = c.symbol AND r.timeframe = c.timeframe
WHERE coalesce(r.is_active, true) AND {_hit()}""",
    "alerts": f"""
SELECT 'alert-' || o_orderkey AS alert_id, {RULE_ID.format('o_custkey')} AS rule_id,
  'user-' || (o_custkey % 25) AS user_id, {SYMBOLS}[o_custkey % 5 + 1] AS symbol, '1h' AS timeframe,
  ['BUY', 'SELL', 'WATCH'][o_orderkey % 3 + 1] AS action, {ALERT_TIME} AS triggered_at,
  CASE WHEN o_orderkey % 9 = 0 THEN 0.0::double WHEN o_orderkey % 10 <> 0 THEN o_totalprice / 8 END AS close_price,
  CASE WHEN o_orderkey % 6 <> 0 THEN (o_orderkey % 10000)::double / 64 END AS rsi_14,
  CASE WHEN o_orderkey % 8 <> 0 THEN (250000 - o_totalprice) / 1000 END AS macd,
  CASE WHEN o_orderkey % 12 = 0 THEN 0.0::double WHEN o_orderkey % 5 <> 0 THEN (o_orderkey % 1000)::double / 200 END AS volume_ratio,
  CASE WHEN o_orderkey % 4 <> 0 THEN 'HAMMER' END AS candle_pattern, NULL::varchar AS message
FROM orders""",
    "audited": """
SELECT a.*, a.triggered_at + INTERVAL 5 SECONDS AS dispatched_at, s.notification_channels
FROM alerts a JOIN stored s USING (rule_id)""",
    "routed": """
SELECT a.*, s.email_address, s.webhook_url, unnest(s.notification_channels) AS channel
FROM alerts a JOIN stored s USING (rule_id)""",
    "messages": """
SELECT o_orderkey AS n,
  '"alert_id": "' || o_orderkey || '"' || CASE WHEN o_orderkey % 7 <> 1 THEN ', "rule_id": "' || o_custkey || '"' ELSE '' END
  || CASE WHEN o_orderkey % 11 = 2 THEN ', "user_id": null' WHEN o_orderkey % 5 <> 2 THEN ', "user_id": "' || (o_custkey % 25) || '"' ELSE '' END
  || ', "symbol": "' || o_orderpriority || '", "close_price": ' || o_totalprice::varchar AS body,
  CASE WHEN o_orderkey % 13 = 3 THEN 'list' WHEN o_orderkey % 17 = 4 THEN 'number' WHEN o_orderkey % 19 = 5 THEN 'cut'
    WHEN o_orderkey % 23 = 6 THEN 'empty' ELSE 'object' END AS form,
  o_orderkey % 29 = 7 AS broken, o_orderkey % 7 <> 1 AS has_rule,
  o_orderkey % 11 = 2 OR o_orderkey % 5 <> 2 AS has_user,
  o_custkey::varchar AS rule_id, CASE WHEN o_orderkey % 11 <> 2 THEN (o_custkey % 25)::varchar END AS user_id,
  o_totalprice AS close_price
FROM orders""",
    "parsed": """
SELECT *, CASE WHEN broken THEN 'not valid UTF-8' WHEN form <> 'object' THEN 'not a JSON object'
  WHEN NOT has_rule AND NOT has_user THEN 'missing: rule_id, user_id'
  WHEN NOT has_rule THEN 'missing: rule_id' WHEN NOT has_user THEN 'missing: user_id' END AS error,
  CASE form WHEN 'list' THEN '["alert_id", "rule_id", "user_id", "symbol"]' WHEN 'number' THEN n::varchar
    WHEN 'cut' THEN '{' || body WHEN 'empty' THEN '' ELSE '{' || body || '}' END AS message
FROM messages""",
    "raw": f"""
SELECT r.*,
  CASE WHEN k % 2 = 0 THEN symbol ELSE upper(symbol[1]) || symbol[2:] END AS raw_symbol,
  CASE WHEN k % 19 = 0 THEN '2h' ELSE timeframe END AS raw_timeframe,
  coalesce(CASE WHEN k % 17 = 0 THEN 'XOR' ELSE upper(logic) END, 'AND') AS raw_logic,
  CASE WHEN k % 53 = 0 THEN 'HOLD' ELSE action END AS raw_action,
  coalesce(CASE WHEN k % 23 = 0 THEN 59 WHEN k % 25 = 0 THEN 86401 WHEN k % 3 = 0 THEN NULL ELSE cooldown_seconds END, 300) AS raw_cooldown,
  CASE WHEN k % 7 = 0 THEN ['email'] ELSE list_transform(notification_channels, lambda c: lower(c)) END AS raw_channels,
  CASE WHEN k % 43 = 0 THEN 'nobody' ELSE email_address END AS raw_email,
  CASE WHEN k % 47 = 0 THEN '' ELSE webhook_url END AS raw_webhook,
  CASE WHEN k % 29 = 0 THEN 'none' WHEN k % 31 = 0 THEN 'eleven' WHEN k % 37 = 0 THEN 'comet' WHEN k % 41 = 0 THEN 'low'
    WHEN k % 59 = 0 THEN 'rsi_15' ELSE 'own' END AS defect
FROM rules r""",
    "validated": """
SELECT *, concat_ws('; ',
  CASE WHEN raw_timeframe = '2h' THEN 'unknown timeframe' END,
  CASE WHEN defect IN ('none', 'eleven') THEN '1 to 10 conditions required' END,
  CASE WHEN raw_logic NOT IN ('AND', 'OR') THEN 'unknown logic' END,
  CASE WHEN raw_action = 'HOLD' THEN 'unknown action' END,
  CASE WHEN list_contains(raw_channels, 'telegram') THEN 'unknown channel' END,
  CASE WHEN list_contains(raw_channels, 'email') AND coalesce(raw_email NOT LIKE '%@%', true) THEN 'email_address is required' END,
  CASE WHEN list_contains(raw_channels, 'webhook') AND coalesce(raw_webhook, '') = '' THEN 'webhook_url is required' END,
  CASE WHEN raw_cooldown NOT BETWEEN 60 AND 86400 THEN 'cooldown out of range' END,
  CASE defect WHEN 'comet' THEN 'unknown candle pattern' WHEN 'low' THEN 'condition value is not a number'
    WHEN 'rsi_15' THEN 'unknown condition field' END) AS errors
FROM raw""",
    "changes": f"""
SELECT o_orderkey AS n, {RULE_ID.format('o_custkey')} AS rule_id,
  CASE WHEN o_orderkey % 10 = 0 THEN 'user-unknown' ELSE 'user-' || c_nationkey END AS user_id,
  CASE WHEN o_orderkey % 97 = 6 THEN 'delete' WHEN o_orderkey % 7 < 4 THEN 'patch' WHEN o_orderkey % 7 < 6 THEN 'toggle' ELSE 'create' END AS op,
  {ALERT_TIME} AS ts
FROM orders JOIN customer ON c_custkey = o_custkey""",
    "payloads": """
SELECT *,
  CASE WHEN op = 'create' OR (op = 'patch' AND n % 13 = 0) THEN 'close > ' || (n % 100)::double::varchar END AS p_condition,
  CASE WHEN op = 'patch' AND n % 5 = 0 THEN 'OR' END AS p_logic,
  CASE WHEN op = 'create' THEN 'BUY' WHEN op = 'patch' AND n % 3 = 0 THEN 'SELL' END AS p_action,
  CASE WHEN op = 'patch' AND n % 17 = 0 THEN 'webhook' END AS p_channels,
  CASE WHEN op = 'create' OR (op = 'patch' AND n % 11 = 0) THEN 'order' || n || '@example.com' END AS p_email,
  CASE WHEN op = 'patch' AND n % 17 = 0 THEN 'https://hooks.example.com/o/' || n END AS p_webhook,
  CASE WHEN op = 'patch' AND n % 4 = 0 THEN (60 + n % 1000)::integer END AS p_cooldown,
  CASE WHEN op = 'patch' AND n % 6 = 0 THEN n % 12 = 0 END AS p_active
FROM changes""",
    "stored_shown": """
SELECT rule_id, user_id, symbol, timeframe, n_conditions::integer AS conditions, first_condition, logic, action,
  array_to_string(notification_channels, ',') AS channels, email_address, webhook_url, cooldown_seconds,
  is_active, created_at, created_at AS updated_at, 0 AS trigger_count FROM stored""",
    "effective": """
SELECT *, coalesce(p_condition, p_logic, p_action, p_channels, p_email, p_webhook, p_cooldown::varchar, p_active::varchar) IS NOT NULL AS sets_any
FROM payloads""",
}

NEEDS = {
    "candles": ["ticks"], "minutes": ["ticks"], "numbered": ["candles"], "ema": ["numbered"],
    "macd_lines": ["ema"], "moves": ["candles"], "ranged": ["moves"], "rolled": ["ranged"],
    "indicators": ["rolled"], "full_candles": ["indicators", "macd_lines"],
    "triggered": ["full_candles", "rules"], "audited": ["alerts", "stored"],
    "routed": ["alerts", "stored"], "parsed": ["messages"], "raw": ["rules"], "validated": ["raw"],
    "payloads": ["changes"], "stored_shown": ["stored"], "effective": ["payloads"],
}

CANDLE = "symbol, timeframe, open_time, open, high, low, close, volume"
KEY = "symbol, timeframe, open_time"


def oracle(name: str, fragments: list[str], sql: str) -> None:
    ORACLES[name] = (_ctes(*fragments) if fragments else "") + sql


# --- candles and indicators ----------------------------------------------------------------------

oracle("ohlcv_1h", ["candles"], f"SELECT {CANDLE} FROM candles")
oracle("ohlcv_rollup", ["ticks"], " UNION ALL ".join(
    f"SELECT {CANDLE} FROM ({_candles(s, n)})" for n, s in
    [("1m", 60), ("3m", 180), ("5m", 300), ("15m", 900), ("30m", 1800), ("1h", 3600), ("4h", 14400), ("1d", 86400)]
))
oracle("vwap", ["candles"], f"SELECT {KEY}, CASE WHEN volume <> 0 THEN notional / volume END AS vwap FROM candles")
oracle("volume_profile", ["ticks"], """, profile AS (
SELECT symbol, ts::date::varchar AS day, floor(price / 10.0::double)::bigint AS bucket,
  sum(quantity::decimal(18,0))::double AS volume, count(*) AS trades FROM ticks GROUP BY ALL)
SELECT *, bucket * 10.0::double AS price_from,
  bucket = arg_max(bucket, (volume, -bucket)) OVER (PARTITION BY symbol, day) AS is_control FROM profile""".lstrip())
oracle("prev_candle", ["moves"], f"SELECT {KEY}, pt AS prev_time, pc AS prev_close, pv AS prev_volume FROM moves")
oracle("moving_averages", ["rolled"], f"SELECT {KEY}, ma7, ma25, ma99 FROM rolled")
oracle("bollinger", ["indicators"], f"SELECT {KEY}, round(bb_lower, 6) AS bb_lower, round(bb_middle, 6) AS bb_middle, round(bb_upper, 6) AS bb_upper FROM indicators")
oracle("rsi_14", ["indicators"], f"SELECT {KEY}, round(rsi_14, 6) AS rsi_14 FROM indicators")
oracle("macd", ["macd_lines"], f"SELECT {KEY}, round(macd, 6) AS macd, round(macd_signal, 6) AS macd_signal, round(macd_hist, 6) AS macd_hist FROM macd_lines")
oracle("atr_14", ["indicators"], f"SELECT {KEY}, round(atr_14, 6) AS atr_14 FROM indicators")
oracle("volume_ratio", ["indicators"], f"SELECT {KEY}, volume_ratio FROM indicators")
oracle("price_change_pct", ["indicators"], f"SELECT {KEY}, price_change_pct FROM indicators")
oracle("candle_pattern", ["indicators"], f"SELECT {KEY}, candle_pattern FROM indicators")

# --- sources and tables --------------------------------------------------------------------------

oracle("parse_ticks", ["ticks"], "SELECT * FROM ticks")
oracle("bronze_ingest", [], """
SELECT 'raw-crypto-ticks' AS topic, (event_id % 5)::integer AS partition, event_id // 5 AS "offset",
  '{"symbol":"' || event_type || '","ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","price":' || value::varchar
  || ',"quantity":' || (props->>'$.k')::double::varchar || ',"trade_id":' || event_id || '}' AS payload,
  ts AS ingest_time, ts::date AS ingest_date FROM events""")
ROUNDED = ["rsi_14", "macd", "macd_signal", "macd_hist", "ma7", "ma25", "ma99", "bb_upper", "bb_lower", "atr_14"]
oracle("silver_table", ["indicators", "macd_lines"], f"""
SELECT {KEY}, i.open, i.high, i.low, i.close, i.volume, {", ".join(f"round({c}, 6) AS {c}" for c in ROUNDED)},
  volume_ratio, price_change_pct, candle_pattern, open_time::date::varchar AS day
FROM indicators i JOIN macd_lines m USING ({KEY})""")
oracle("gold_table", ["minutes"], "SELECT *, open_time::date::varchar AS day, CASE WHEN volume <> 0 THEN notional / volume END AS vwap FROM ("
       + " UNION ALL ".join(f"SELECT * FROM ({_longer(s, n)})" for n, s in
       [("1m", 60), ("3m", 180), ("5m", 300), ("15m", 900), ("30m", 1800), ("1h", 3600), ("4h", 14400), ("1d", 86400)])
       + ")")
oracle("backfill_merge", ["candles"], f"""
SELECT {KEY}, open, high, low, CASE WHEN day(open_time) % 3 <> 0 THEN close ELSE close + 1 END AS close, volume FROM candles""")
oracle("silver_clean", ["ticks"], f""", clean AS (
SELECT upper(symbol) AS symbol, timeframe, open_time, open, high, low, close, volume
FROM ({_candles(3600, "1h")}) WHERE open > 0 AND high > 0 AND low > 0 AND close > 0)
SELECT {CANDLE}, coalesce((epoch(open_time) - epoch(lag(open_time) {SERIES}))::bigint // 3600 - 1, 0) AS missing_before
FROM clean""".lstrip())
oracle("retention", ["candles"], f"SELECT {CANDLE} FROM candles WHERE open_time >= TIMESTAMP '2024-01-18 00:00:00'")
oracle("data_quality", [], " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({e}) AS null_count, "
    f"(count(*) - count({e}))::double / count(*) AS null_rate, "
    "(epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(ts))) / 1e6::double AS freshness_seconds FROM events"
    for c, e in [("event_id", "event_id"), ("ts", "ts"), ("user_id", "user_id"), ("event_type", "event_type"),
                 ("value", "CASE WHEN value > 1 THEN value END"), ("props", "props")]
))
oracle("rules_source", ["rules", "stored"], """
SELECT r.rule_id, r.user_id, r.symbol, r.timeframe, r.n_conditions AS conditions,
  1 + count(s.rule_id) AS copies
FROM rules r LEFT JOIN stored s USING (rule_id) GROUP BY ALL""")

# --- conditions and rules ------------------------------------------------------------------------

PY = "CASE WHEN isnan({0}) THEN 'nan' ELSE {0}::varchar END"
oracle("cond_numeric", [], f"""
WITH rows AS (SELECT o_orderkey AS id, ['>', '<', '>=', '<='][o_orderkey % 4 + 1] AS op,
  CASE WHEN o_orderkey % 9 = 0 THEN 'nan'::double ELSE o_totalprice END AS x,
  CASE WHEN o_orderkey % 13 = 0 THEN 'nan'::double WHEN o_orderkey % 5 = 0 THEN o_totalprice
    WHEN o_orderkey % 7 <> 0 THEN 250000.0::double ELSE 100000.5::double END AS v,
  o_orderkey % 13 <> 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 7 = 0 AS as_text FROM orders),
tested AS (SELECT *, NOT isnan(x) AND NOT isnan(v) AND CASE op WHEN '>' THEN x > v WHEN '<' THEN x < v WHEN '>=' THEN x >= v ELSE x <= v END AS passed FROM rows)
SELECT id, passed, 'close ' || op || ' ' || CASE WHEN as_text THEN ' 1_00000.5 ' ELSE {PY.format('v')} END || ' → '
  || CASE WHEN passed THEN '✓' ELSE '✗' END || ' (current=' || {PY.format('x')} || ')' AS description FROM tested""")
oracle("cond_text", [], """
WITH rows AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN '==' ELSE '!=' END AS op,
  CASE o_orderkey % 3 WHEN 0 THEN lower(o_orderpriority) WHEN 1 THEN o_orderpriority ELSE (o_orderkey % 4)::double::varchar END AS x,
  CASE WHEN o_orderkey % 5 < 3 THEN '5-low' ELSE '2.0' END AS v FROM orders),
tested AS (SELECT *, (upper(x) = upper(v)) = (op = '==') AS passed FROM rows)
SELECT id, passed, 'candle_pattern ' || op || ' ' || v || ' → ' || CASE WHEN passed THEN '✓' ELSE '✗' END
  || ' (current=' || x || ')' AS description FROM tested""")
oracle("cond_fail_closed", [], """
WITH rows AS (SELECT o_orderkey AS id, ['!=', '~', '>', 'crosses_above', '==', '<='][o_orderkey % 6 + 1] AS op,
  CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS num,
  CASE WHEN o_orderkey % 8 = 4 THEN o_orderstatus END AS txt,
  CASE o_orderkey % 5 WHEN 0 THEN 'abc' WHEN 1 THEN '1.0d' WHEN 2 THEN '1000.0' END AS v,
  CASE WHEN o_orderkey % 5 = 2 THEN 1000.0::double END AS lim,
  CASE WHEN o_orderkey % 3 = 0 THEN 500.0::double END AS prev FROM orders),
tested AS (SELECT *, coalesce(CASE op
    WHEN '>' THEN num > lim WHEN '<=' THEN num <= lim
    WHEN '==' THEN upper(coalesce(txt, num::varchar)) = upper(v)
    WHEN '!=' THEN upper(coalesce(txt, num::varchar)) <> upper(v)
    WHEN 'crosses_above' THEN prev <= lim AND num > lim END, false) AS passed FROM rows)
SELECT id, passed, CASE WHEN num IS NULL AND txt IS NULL THEN 'close is None' WHEN op = '~' THEN 'Unknown operator: ~'
  WHEN op = 'crosses_above' AND prev IS NULL THEN 'No previous data for close'
  WHEN op NOT IN ('==', '!=') AND (lim IS NULL OR num IS NULL) THEN 'Evaluation error'
  ELSE 'close ' || op || ' ' || coalesce(v, 'None') || ' → ' || CASE WHEN passed THEN '✓' ELSE '✗' END
    || ' (current=' || coalesce(txt, num::varchar) || ')' END AS description FROM tested""")
oracle("rule_combine", [], """
WITH rows AS (SELECT o_orderkey AS id, o_orderkey % 11 AS d, o_orderkey % 3 + 1 AS size,
  ['AND', 'or', 'XOR', 'Or', NULL][o_orderkey % 5 + 1] AS logic,
  [o_totalprice > o_orderkey % 400000, o_totalprice < 200000, o_orderstatus = 'F'] AS results FROM orders)
SELECT id, CASE WHEN d IN (0, 1) THEN false WHEN upper(coalesce(logic, 'AND')) = 'AND' THEN NOT list_contains(results[1:size], false)
  WHEN upper(logic) = 'OR' THEN list_contains(results[1:size], true) ELSE false END AS passed FROM rows""")
oracle("rule_validation", ["validated"], "SELECT rule_id, errors = '' AS valid, errors FROM validated")
oracle("rule_normalize", ["raw"], """
SELECT rule_id, upper(raw_symbol) AS symbol, raw_logic AS logic, raw_cooldown AS cooldown_seconds,
  coalesce(is_active, true) AS is_active, array_to_string(raw_channels, ',') AS channels FROM raw""")
oracle("rule_match", ["candles", "rules"], """
SELECT r.rule_id, r.symbol, count(*) AS candles, min(open_time) AS first_time, max(open_time) AS last_time
FROM candles c JOIN rules r ON r.symbol = c.symbol AND r.timeframe = c.timeframe
WHERE coalesce(r.is_active, true) GROUP BY ALL""")
oracle("triggered_rules", ["triggered"], "SELECT rule_id, user_id, symbol, timeframe, action, open_time, close FROM triggered")
oracle("conditions_met", ["triggered"], f"SELECT rule_id, open_time, n_conditions AS conditions, {_met()} AS conditions_met FROM triggered")
for _name, _test in [("crosses_above", "pc <= v AND close > v"), ("crosses_below", "pc >= v AND close < v")]:
    oracle(_name, ["moves"], f"""
SELECT c_custkey AS condition_id, count(*) FILTER ({_test}) AS crossings, min(open_time) FILTER ({_test}) AS first_time,
  count(*) FILTER (pc IS NULL) AS without_previous
FROM (SELECT c_custkey, {SYMBOLS}[c_custkey % 5 + 1] AS symbol, (20 + c_custkey % 100)::double AS v FROM customer) JOIN moves USING (symbol)
GROUP BY ALL""")

# --- alerts --------------------------------------------------------------------------------------

oracle("alert_events", ["triggered"], """
SELECT sha256(rule_id || '|' || symbol || '|' || timeframe || '|' || epoch_us(open_time)) AS alert_id, rule_id, user_id, symbol,
  timeframe, action, open_time + INTERVAL 1 HOUR AS triggered_at, close AS close_price, round(rsi_14, 6) AS rsi_14,
  round(macd, 6) AS macd, round(volume_ratio, 6) AS volume_ratio, candle_pattern FROM triggered""")
oracle("parse_alert_messages", ["parsed"], """
SELECT n AS "offset", CASE WHEN error IS NULL THEN n::varchar END AS alert_id, CASE WHEN error IS NULL THEN rule_id END AS rule_id,
  CASE WHEN error IS NULL THEN user_id END AS user_id, CASE WHEN error IS NULL THEN close_price END AS close_price, error FROM parsed""")
oracle("dead_letters", ["parsed"], """
SELECT TIMESTAMP '2024-02-01' AS timestamp, error, CASE WHEN broken THEN '' ELSE message END AS event, '20240201' AS dlq_date
FROM parsed WHERE error IS NOT NULL""")
oracle("alert_sink", ["alerts"], "SELECT alert_id, rule_id, triggered_at, close_price, rsi_14, candle_pattern, message FROM alerts")
oracle("alert_audit", ["audited"], """
SELECT alert_id, rule_id, triggered_at, TIMESTAMP '2024-02-02' AS dispatched_at, array_to_string(notification_channels, ',') AS channels FROM audited""")
oracle("orphan_alerts", ["alerts", "stored"], "SELECT alert_id, rule_id FROM alerts WHERE rule_id NOT IN (SELECT rule_id FROM stored)")
oracle("channel_fanout", ["routed"], "SELECT alert_id, channel, lower(channel) IN ('email', 'webhook') AS supported FROM routed")
oracle("render_email", ["routed"], """
SELECT alert_id, email_address AS recipient, '[Crypto Alert] ' || action || ' Signal – ' || symbol AS subject FROM routed WHERE channel = 'email'""")
oracle("render_message", ["alerts"], r"""
SELECT alert_id, concat_ws(chr(10),
  CASE action WHEN 'BUY' THEN '🟢' WHEN 'SELL' THEN '🔴' ELSE '🔵' END || ' *' || action || ' Signal Triggered*',
  '📊 Symbol:    `' || symbol || '` (' || timeframe || ')',
  '💰 Price:     ' || CASE WHEN coalesce(close_price, 0) <> 0 THEN '`' || printf('%.4f', close_price) || ' USDT`' ELSE 'N/A' END,
  '📈 RSI(14):   ' || CASE WHEN rsi_14 IS NOT NULL THEN '`' || printf('%.2f', rsi_14) || '`' ELSE 'N/A' END,
  '〰️  MACD:      ' || CASE WHEN macd IS NOT NULL THEN '`' || printf('%.4f', macd) || '`' ELSE 'N/A' END,
  '📦 Vol Ratio: ' || CASE WHEN coalesce(volume_ratio, 0) <> 0 THEN '`' || printf('%.2f', volume_ratio) || 'x`' ELSE 'N/A' END,
  '🕯️  Pattern:   `' || coalesce(candle_pattern, 'None') || '`',
  '⏰ At:         `' || strftime(triggered_at, '%Y-%m-%dT%H:%M:%S') ||
    CASE WHEN epoch_us(triggered_at) % 1000000 <> 0 THEN strftime(triggered_at, '.%f') ELSE '' END || '`',
  '🔔 Rule ID:   `' || rule_id[1:8] || '...`') AS text FROM alerts""")
oracle("webhook_payload", ["alerts"], """
SELECT alert_id, '{"event_type":"alert_triggered","rule_id":"' || rule_id || '","user_id":"' || user_id || '","symbol":"' || symbol
  || '","timeframe":"1h","action":"' || action || '","triggered_at":"' || strftime(triggered_at, '%Y-%m-%dT%H:%M:%S')
  || CASE WHEN epoch_us(triggered_at) % 1000000 <> 0 THEN strftime(triggered_at, '.%f') ELSE '' END
  || '","data":{"close_price":' || coalesce(close_price::varchar, 'null') || ',"rsi_14":' || coalesce(rsi_14::varchar, 'null')
  || ',"macd":' || coalesce(macd::varchar, 'null') || ',"volume_ratio":' || coalesce(volume_ratio::varchar, 'null')
  || ',"candle_pattern":' || coalesce('"' || candle_pattern || '"', 'null') || '}}' AS payload FROM alerts""")
oracle("rule_trigger_stats", ["audited"], """
SELECT s.rule_id, count(a.rule_id) AS trigger_count, max(a.dispatched_at) AS last_triggered_at
FROM stored s LEFT JOIN audited a USING (rule_id) GROUP BY ALL""")
oracle("rule_history", ["audited"], """
SELECT rule_id, user_id, row_number() OVER (PARTITION BY rule_id, user_id ORDER BY triggered_at DESC, alert_id) AS position, alert_id, triggered_at
FROM audited QUALIFY position <= 10""")
oracle("request_metrics", [], """
WITH log AS (SELECT ts, event_type AS method, '/u/' || (user_id % 10) AS path, (200 + 204 * (value > 100)::integer)::integer AS status, value AS duration FROM events),
latest AS (SELECT * FROM log ORDER BY ts DESC, duration DESC LIMIT 1000)
SELECT method, path, status, count(*) AS requests, NULL::double AS mean_duration FROM log GROUP BY ALL
UNION ALL SELECT 'recent', NULL, NULL, count(*), round(sum(duration::decimal(18,2))::double / count(*), 6) FROM latest""")
DELIVERED = """
SELECT alert_id, channel,
  CASE WHEN n % 7 = 0 THEN 1 WHEN n % 11 = 0 OR n % 13 = 0 THEN 3 ELSE 1 END AS attempts,
  CASE WHEN n % 7 = 0 THEN 'not_found' WHEN n % 11 = 0 OR n % 13 = 0 THEN 'failed' ELSE 'dispatched' END AS status,
  CASE WHEN n % 7 = 0 THEN 404 WHEN n % 11 = 0 THEN 503 WHEN n % 13 = 0 THEN NULL ELSE 200 END AS last_code,
  CASE WHEN n % 7 = 0 THEN 'rule not found' WHEN n % 11 = 0 THEN 'Failed after 3 attempts' WHEN n % 13 = 0 THEN 'connection refused' END AS error
FROM (SELECT *, alert_id[7:]::bigint AS n FROM routed WHERE lower(channel) IN ('email', 'webhook'))"""
oracle("delivery_log", ["routed"], DELIVERED)
oracle("delivery_stats", ["routed"], f"""
SELECT count(*) FILTER (status = 'dispatched') AS dispatched, count(*) FILTER (status <> 'dispatched') AS failed,
  sum(CASE WHEN status = 'failed' THEN attempts ELSE attempts - 1 END)::bigint AS retried FROM ({DELIVERED})""")
oracle("cooldown", ["triggered"], """, hits AS (
SELECT rule_id, open_time AS t, open_time + to_seconds(cooldown_seconds) AS ready FROM triggered),
linked AS MATERIALIZED (SELECT h.rule_id, h.t, n.t AS following FROM hits h ASOF LEFT JOIN hits n ON h.rule_id = n.rule_id AND h.ready <= n.t),
firing AS (
SELECT rule_id, min(t) AS t FROM hits GROUP BY rule_id
UNION ALL SELECT l.rule_id, l.following FROM firing f JOIN linked l ON l.rule_id = f.rule_id AND l.t = f.t WHERE l.following IS NOT NULL)
SELECT rule_id, t AS triggered_at FROM firing""".lstrip())

# --- rule lists and lifecycle --------------------------------------------------------------------

oracle("rules_total", ["rules"], "SELECT count(*) AS total FROM rules WHERE user_id = 'user-3' AND timeframe = '1h'")
oracle("list_rules", ["rules"], """
SELECT rule_id, 'VIEW' AS symbol, timeframe, created_at FROM rules
WHERE user_id = 'user-3' AND symbol = 'view' AND coalesce(is_active, true)""")
oracle("list_rules_page", ["rules"], "SELECT rule_id, created_at FROM rules WHERE user_id = 'user-3' ORDER BY created_at DESC, rule_id LIMIT 20 OFFSET 20")
SHOWN = ("rule_id, user_id, symbol, timeframe, conditions, first_condition, logic, action, channels, email_address, "
         "webhook_url, cooldown_seconds, is_active, created_at, updated_at, trigger_count")
oracle("rules_create", ["stored_shown", "validated"], f"""
SELECT {SHOWN} FROM stored_shown UNION ALL
SELECT rule_id, user_id, upper(raw_symbol), raw_timeframe, n_conditions, first_condition, raw_logic, raw_action,
  array_to_string(raw_channels, ','), raw_email, raw_webhook, raw_cooldown, coalesce(is_active, true),
  TIMESTAMP '2024-02-01', TIMESTAMP '2024-02-01', 0
FROM validated WHERE errors = '' AND rule_id NOT IN (SELECT rule_id FROM stored)""")
_MERGED = ["condition", "logic", "action", "channels", "email", "webhook", "cooldown", "active"]
_PATCHES = ", ".join(f"arg_max(p_{c}, ts) FILTER (op = 'patch' AND p_{c} IS NOT NULL) AS m_{c}" for c in _MERGED)
_OVERLAY = """r.rule_id, r.user_id, r.symbol, r.timeframe, CASE WHEN m_condition IS NOT NULL THEN 1 ELSE r.conditions END AS conditions,
  coalesce(m_condition, r.first_condition) AS first_condition, coalesce(m_logic, r.logic) AS logic, coalesce(m_action, r.action) AS action,
  coalesce(m_channels, r.channels) AS channels, coalesce(m_email, r.email_address) AS email_address,
  coalesce(m_webhook, r.webhook_url) AS webhook_url, coalesce(m_cooldown, r.cooldown_seconds) AS cooldown_seconds"""
oracle("rules_patch", ["stored_shown", "effective"], f""", merged AS (
SELECT rule_id, user_id, max(ts) AS at, {_PATCHES} FROM effective WHERE op = 'patch' AND sets_any GROUP BY ALL)
SELECT {_OVERLAY}, coalesce(m_active, r.is_active) AS is_active, r.created_at, coalesce(m.at, r.updated_at) AS updated_at, r.trigger_count
FROM stored_shown r LEFT JOIN merged m USING (rule_id, user_id)""".lstrip())
oracle("rules_delete", ["stored_shown", "changes"], f"""
SELECT {SHOWN} FROM stored_shown r WHERE NOT EXISTS (SELECT 1 FROM changes c WHERE c.op = 'delete' AND c.rule_id = r.rule_id AND c.user_id = r.user_id)""")
oracle("rules_toggle", ["stored_shown", "changes"], f""", counted AS (
SELECT rule_id, user_id, count(*) AS times, max(ts) AS last_toggle FROM changes WHERE op = 'toggle' GROUP BY ALL)
SELECT r.* EXCLUDE (is_active, updated_at),
  CASE WHEN times IS NOT NULL THEN coalesce(is_active, true) <> (times % 2 = 1) ELSE is_active END AS is_active,
  coalesce(last_toggle, updated_at) AS updated_at FROM stored_shown r LEFT JOIN counted USING (rule_id, user_id)""".lstrip())
# The change log one by one: a recursive walk over each rule's changes in time order.
_SET = ", ".join(
    f"CASE WHEN c.op = 'patch' AND ok AND c.p_{n} IS NOT NULL THEN c.p_{n} WHEN born THEN {d} ELSE s.{n} END AS {n}"
    for n, d in [("condition", "c.p_condition"), ("logic", "'AND'"), ("action", "c.p_action"), ("channels", "'email'"),
                 ("email", "c.p_email"), ("webhook", "NULL"), ("cooldown", "300")]
)
oracle("rules_apply_log", ["stored_shown", "effective"], f""", owners AS (
SELECT rule_id, coalesce(any_value(r.user_id), arg_min(c.user_id, c.ts) FILTER (c.op = 'create')) AS owner,
  any_value(r.user_id) IS NOT NULL AS had FROM effective c LEFT JOIN stored_shown r USING (rule_id) GROUP BY rule_id),
log AS (SELECT c.*, o.owner, row_number() OVER (PARTITION BY rule_id ORDER BY ts) AS i
  FROM effective c JOIN owners o USING (rule_id) WHERE c.user_id = o.owner AND (c.op <> 'patch' OR c.sets_any)),
walk AS (
SELECT o.rule_id, 0::bigint AS i, o.owner, o.had AS alive, r.symbol, r.timeframe, r.conditions::bigint AS conditions, r.first_condition AS condition,
  r.logic, r.action, r.channels, r.email_address AS email, r.webhook_url AS webhook, r.cooldown_seconds AS cooldown,
  r.is_active AS active, r.created_at, r.updated_at FROM owners o LEFT JOIN stored_shown r USING (rule_id)
UNION ALL
SELECT s.rule_id, c.i, s.owner,
  CASE WHEN c.op = 'delete' THEN false WHEN born THEN true ELSE s.alive END,
  CASE WHEN born THEN 'VIEW' ELSE s.symbol END, CASE WHEN born THEN '1h' ELSE s.timeframe END,
  CASE WHEN born OR (ok AND c.op = 'patch' AND c.p_condition IS NOT NULL) THEN 1 ELSE s.conditions END,
  {_SET},
  CASE WHEN born THEN true WHEN ok AND c.op = 'patch' AND c.p_active IS NOT NULL THEN c.p_active
    WHEN ok AND c.op = 'toggle' THEN NOT coalesce(s.active, true) ELSE s.active END,
  CASE WHEN born THEN c.ts ELSE s.created_at END,
  CASE WHEN born OR (ok AND c.op IN ('patch', 'toggle')) THEN c.ts ELSE s.updated_at END
FROM (SELECT s.*, s.alive AS ok FROM walk s) s
JOIN (SELECT *, op = 'create' AS creates FROM log) c ON c.rule_id = s.rule_id AND c.i = s.i + 1,
LATERAL (SELECT c.creates AND NOT s.alive AS born) b),
ended AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY rule_id ORDER BY i DESC) = 1)
SELECT rule_id, owner AS user_id, symbol, timeframe, conditions, condition AS first_condition, logic, action, channels,
  email AS email_address, webhook AS webhook_url, cooldown AS cooldown_seconds, active AS is_active, created_at, updated_at, 0 AS trigger_count
FROM ended WHERE alive
UNION ALL SELECT {SHOWN} FROM stored_shown WHERE rule_id NOT IN (SELECT rule_id FROM owners)""".lstrip())

# --- streams -------------------------------------------------------------------------------------

oracle("stream_ohlcv", ["candles"], f"SELECT {CANDLE} FROM candles")
oracle("stream_dedup", ["alerts"], "SELECT alert_id, rule_id, triggered_at FROM alerts")
oracle("stream_rules", ["triggered"], """
SELECT sha256(rule_id || '|' || symbol || '|' || timeframe || '|' || epoch_us(open_time)) AS alert_id, rule_id,
  open_time + INTERVAL 1 HOUR AS triggered_at, close AS close_price FROM triggered""")
ORACLES["stream_cooldown"] = ORACLES["cooldown"]
SHOWN_ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in [*ROUNDED, "volume_ratio", "price_change_pct"])
oracle("stream_indicators", ["indicators", "macd_lines"], f""", shown AS (
SELECT {KEY}, i.open, i.high, i.low, i.close, i.volume, {SHOWN_ROUNDED}, candle_pattern
FROM indicators i JOIN macd_lines m USING ({KEY}))
SELECT *, lag(open_time) {SERIES} AS prev_time, lag(close) {SERIES} AS prev_close, lag(rsi_14) {SERIES} AS prev_rsi,
  lag(macd_hist) {SERIES} AS prev_hist, lag(candle_pattern) {SERIES} AS prev_pattern FROM shown""".lstrip())
oracle("medallion_run", ["minutes"], """, clean AS (
SELECT * FROM minutes WHERE open > 0 AND high > 0 AND low > 0 AND close > 0)
""".lstrip() + " UNION ALL ".join(f"""
SELECT upper(symbol) AS symbol, '{name}' AS timeframe, {_bucket(seconds, 'open_time')} AS open_time,
  arg_min(open, clean.open_time) AS open, max(high) AS high, min(low) AS low, arg_max(close, clean.open_time) AS close,
  sum(volume::decimal(18,0))::double AS volume FROM clean GROUP BY symbol, 3""" for name, seconds in
    [("1m", 60), ("3m", 180), ("5m", 300), ("15m", 900), ("30m", 1800), ("1h", 3600), ("4h", 14400), ("1d", 86400)]))
oracle("medallion_late", ["minutes"], """, clean AS (
SELECT upper(symbol) AS symbol, '1m' AS timeframe, open_time, open, high, low, close, volume FROM minutes
WHERE open > 0 AND high > 0 AND low > 0 AND close > 0)
SELECT *, coalesce((epoch(open_time)::bigint - epoch(lag(open_time) OVER (PARTITION BY symbol ORDER BY open_time))::bigint) // 60 - 1, 0)::bigint
  AS missing_before FROM clean""".lstrip())
