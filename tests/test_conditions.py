"""Every branch of condition and rule evaluation on hand-made rows."""

import random

from pyspark.sql import functions as F

from candlewright.operators import rules as R

CANDLE = (
    "symbol string, timeframe string, open_time timestamp, close double, rsi_14 double, "
    "volume_ratio double, candle_pattern string"
)
RULE = (
    "rule_id string, symbol string, timeframe string, conditions "
    "array<struct<field: string, operator: string, value_num: double, value_str: string>>, "
    "logic string, is_active boolean"
)


FIELDS = ["close", "rsi_14", "volume_ratio", "candle_pattern"]


def run_all(spark, cases):
    """Per case (conditions, now, before, logic): the words of its rule if it triggers, else None.

    Every case gets a symbol, candles and a rule of its own, so one evaluation serves all.
    """
    rows, rules = [], []
    for i, (conditions, now, before, logic) in enumerate(cases):
        if before is not None:
            rows.append((f"S{i}", "1h", 1, *[before.get(f) for f in FIELDS]))
        rows.append((f"S{i}", "1h", 2, *[now.get(f) for f in FIELDS]))
        rules.append((str(i), f"S{i}", "1h", conditions, logic, True))
    raw = spark.createDataFrame(rows, CANDLE.replace("timestamp", "bigint"))
    candles = raw.withColumn("open_time", F.timestamp_seconds(F.col("open_time") * 3600))
    hits = R.evaluate(candles, spark.createDataFrame(rules, RULE)).filter(
        F.unix_seconds("triggered_row.open_time") == 7200
    )
    words = {int(r.rule_id): r.conditions_met for r in hits.collect()}
    return [words.get(i) for i in range(len(cases))]


def num(field, operator, value):
    return (field, operator, float(value), None)


def text(field, operator, value):
    return (field, operator, None, value)


ALWAYS = num("close", ">", 0)


CONDITIONS = [
    (num("rsi_14", "<", 30), {"rsi_14": 29.0}, None, True),
    (num("rsi_14", "<", 30), {"rsi_14": 30.0}, None, False),
    (num("rsi_14", "<=", 30), {"rsi_14": 30.0}, None, True),
    (num("rsi_14", ">=", 30), {"rsi_14": 30.0}, None, True),
    (num("rsi_14", "!=", 30), {}, None, False),
    (num("rsi_14", ">", 30), {"rsi_14": float("nan")}, None, False),
    (num("rsi_14", "<=", 30), {"rsi_14": float("nan")}, None, False),
    (num("rsi_14", "==", 30), {"rsi_14": 30.0}, None, True),
    (num("rsi_14", "!=", 30), {"rsi_14": 30.0}, None, False),
    (text("rsi_14", "==", "30"), {"rsi_14": 30.0}, None, False),
    (text("rsi_14", "==", "30.0"), {"rsi_14": 30.0}, None, True),
    (text("rsi_14", ">", " 1_0 "), {"rsi_14": 30.0}, None, True),
    (text("rsi_14", ">", "1.0d"), {"rsi_14": 30.0}, None, False),
    (text("candle_pattern", "==", "HAMMER"), {"candle_pattern": "hammer"}, None, True),
    (text("candle_pattern", "!=", "HAMMER"), {"candle_pattern": "hammer"}, None, False),
    (text("candle_pattern", "!=", "DOJI"), {"candle_pattern": "hammer"}, None, True),
    (num("candle_pattern", ">", 1), {"candle_pattern": "HAMMER"}, None, False),
    (num("candle_pattern", ">", 1), {"candle_pattern": "2"}, None, True),
    (num("rsi_14", "~", 1), {"rsi_14": 2.0}, None, False),
    (num("unknown", ">", 1), {"rsi_14": 2.0}, None, False),
    (("rsi_14", ">", None, None), {"rsi_14": 2.0}, None, False),
    (("rsi_14", "!=", None, None), {"rsi_14": 2.0}, None, False),
    (num("rsi_14", "crosses_above", 30), {"rsi_14": 31.0}, {"rsi_14": 30.0}, True),
    (num("rsi_14", "crosses_above", 30), {"rsi_14": 32.0}, {"rsi_14": 31.0}, False),
    (num("rsi_14", "crosses_above", 30), {"rsi_14": 31.0}, None, False),
    (num("rsi_14", "crosses_above", 30), {"rsi_14": 31.0}, {}, False),
    (num("rsi_14", "crosses_below", 30), {"rsi_14": 29.0}, {"rsi_14": 30.0}, True),
    (num("rsi_14", "crosses_below", 30), {"rsi_14": 29.0}, {"rsi_14": 29.5}, False),
    (num("rsi_14", "crosses_below", 30), {"rsi_14": 29.0}, {"rsi_14": float("nan")}, False),
]


def test_conditions(spark):
    # Alone under AND (through the quick test) and under OR next to a false one (without it).
    never = num("close", "<", 0)
    now = [{"close": 1.0, **n} for _, n, _, _ in CONDITIONS]
    alone = run_all(spark, [([c], n, b, "AND") for (c, _, b, _), n in zip(CONDITIONS, now)])
    beside = run_all(spark, [([never, c], n, b, "or") for (c, _, b, _), n in zip(CONDITIONS, now)])
    for (condition, _, _, passed), one, two in zip(CONDITIONS, alone, beside):
        assert (one is not None) is passed, condition
        assert (two is not None) is passed, condition


WORDS = [
    (num("rsi_14", "<", 30), {"rsi_14": 29.5}, None, "rsi_14 < 30.0 → ✓ (current=29.5)"),
    (num("rsi_14", "<", 30), {"rsi_14": 31.0}, None, "rsi_14 < 30.0 → ✗ (current=31.0)"),
    (num("rsi_14", "!=", 30), {}, None, "rsi_14 is None"),
    (num("rsi_14", "~", 30), {"rsi_14": 1.0}, None, "Unknown operator: ~"),
    (num("rsi_14", "crosses_above", 30), {"rsi_14": 1.0}, None, "No previous data for rsi_14"),
    (num("candle_pattern", ">", 1), {"candle_pattern": "HAMMER"}, None, "Evaluation error"),
    (text("rsi_14", ">", "abc"), {"rsi_14": 1.0}, None, "Evaluation error"),
    (text("candle_pattern", "==", "hammer"), {"candle_pattern": "HAMMER"}, None,
     "candle_pattern == hammer → ✓ (current=HAMMER)"),
]


def test_descriptions(spark):
    # Failed conditions are described too: each case sits next to one that holds, under OR.
    cases = [([c, ALWAYS], {"close": 1.0, **now}, before, "OR") for c, now, before, _ in WORDS]
    got = run_all(spark, cases)
    assert [words[0] for words in got] == [w for *_, w in WORDS]
    assert all(len(words) == 2 for words in got)


COMBINATIONS = [
    ([], "AND", False), (None, "AND", False), ([ALWAYS], "XOR", False), ([ALWAYS], "or", True),
    ([ALWAYS], None, True), ([ALWAYS, num("close", "<", 0)], "AND", False),
    ([ALWAYS, num("close", "<", 0)], "OR", True), ([num("close", "<", 0)], "OR", False),
]


def test_combinations(spark):
    got = run_all(spark, [(c, {"close": 1.0}, None, logic) for c, logic, _ in COMBINATIONS])
    assert [words is not None for words in got] == [passed for *_, passed in COMBINATIONS]


def test_matching(spark):
    candles = spark.createDataFrame(
        [("X", "1h", 1.0), (None, "1h", 1.0)], "symbol string, timeframe string, close double"
    ).withColumn("open_time", F.lit("2024-01-01").cast("timestamp"))
    rules = [
        ("active", "X", "1h", True), ("unset", "X", "1h", None), ("inactive", "X", "1h", False),
        ("case", "x", "1h", True), ("timeframe", "X", "4h", True), ("none", None, "1h", True),
    ]
    table = spark.createDataFrame([(i, s, t, [ALWAYS], "AND", a) for i, s, t, a in rules], RULE)
    hits = R.evaluate(candles, table).collect()
    assert sorted((r.rule_id, r.symbol) for r in hits) == sorted(
        [("active", "X"), ("unset", "X"), ("none", None)], key=lambda x: x[0]
    )


def test_large_rule_tables_join_on_equal_keys_with_the_same_result(spark, sf_dir):
    from candlewright.plans import queries as Q

    candles = Q.hourly_indicators(spark, sf_dir)
    rules = Q.feeds.rules(spark, sf_dir)
    columns = ["rule_id", "symbol", "conditions_met"]
    small = sorted(map(str, R.evaluate(candles, rules).select(*columns).collect()))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = R.evaluate(candles, rules).select(*columns)
        assert sorted(map(str, large.collect())) == small
        plan = large._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert not any(name in plan for name in ("Broadcast", "CartesianProduct", "NestedLoop"))


def test_index_finds_what_all_pairs_find(spark):
    rng = random.Random(17)
    numbers = [None, float("nan"), float("inf"), -0.0, 0.0, 1.0, 1.5, 2.0, 30.0]
    candles = spark.createDataFrame(
        [(rng.choice(["X", "Y", None]), rng.choice(["1h", "4h"]), rng.choice(numbers), rng.choice(numbers), rng.choice([None, "DOJI", "doji", "30", "1.5"]), k)
         for k in range(150)],
        "symbol string, timeframe string, close double, rsi_14 double, candle_pattern string, k int",
    ).withColumn("open_time", F.timestamp_seconds(F.col("k") * 3600))

    def condition():
        field = rng.choice(["close", "rsi_14", "candle_pattern", "absent", None])
        operator = rng.choice([">", "<", ">=", "<=", "==", "!=", "crosses_above", "crosses_below", "~", None])
        text = rng.choice([None, None, "Doji", "30", "1.50", "2", "nan"])
        return field, operator, rng.choice(numbers) if text is None or rng.random() < 0.3 else None, text

    rules = [
        (f"r{k % 590}", rng.choice(["X", "Y", None]), rng.choice(["1h", "4h"]), [condition() for _ in range(rng.randint(0, 3))], rng.choice(["AND", "OR", "or", None, "XOR"]), True)
        for k in range(600)
    ]
    table = spark.createDataFrame(rules + rules[:5], RULE)
    got = sorted((r.rule_id, str(r.conditions_met), r.triggered_row.k) for r in R.evaluate(candles, table).collect())
    prepared = R.with_previous(candles)
    numeric, text = R._fields(prepared)
    left = R._prepared(prepared, numeric, text, F.col("k"))
    right = R.compiled(table, numeric + text).withColumnsRenamed({"symbol": "s", "timeframe": "t"})
    same = F.col("symbol").eqNullSafe(F.col("s")) & F.col("timeframe").eqNullSafe(F.col("t"))
    words = F.transform("_conditions", R._described).alias("words")
    pairs = left.join(right, same).where(R.rule_passed()).select("rule_id", words, "k").collect()
    assert got == sorted((r.rule_id, str(r.words), r.k) for r in pairs) and len(got) > 800


def test_rules_alike_are_met_once_and_all_have_their_rows(spark, monkeypatch):
    # Sets of two rules and more are dealt to several tasks; a limit of -0.0 keeps its words.
    monkeypatch.setattr(R, "CROWD", 2)
    candles = spark.createDataFrame(
        [("X", "1h", k, float(k)) for k in range(6)], "symbol string, timeframe string, k int, close double"
    ).withColumn("open_time", F.timestamp_seconds(F.col("k") * 3600))
    zeros = [[num("close", ">", 0.0)], [num("close", ">", -0.0)]]
    rules = [(f"r{k}", "X", "1h", zeros[k % 2], [None, "and", "AND"][k % 3], True) for k in range(30)]
    table = spark.createDataFrame(rules, RULE)
    hits, members = R.evaluate_sets(candles, table)
    assert hits.count() == 4 * 5 and members.select("_set", "_part").distinct().count() > 6
    got = R.evaluate(candles, table).collect()
    assert sorted((r.rule_id, r.triggered_row.k) for r in got) == sorted((f"r{k}", c) for k in range(30) for c in range(1, 6))
    assert all(r.conditions_met[0].startswith(f"close > {r.conditions[0].value_num} ") for r in got)
    assert {str(r.conditions[0].value_num) for r in got} == {"0.0", "-0.0"}


def test_condition_hits_count_what_all_pairs_find(spark):
    rng = random.Random(23)
    numbers = [None, float("nan"), float("inf"), float("-inf"), -0.0, 0.0, 1.0, 1.5, 2.0, 30.0, *[k / 4 for k in range(40)]]
    candles = spark.createDataFrame(
        [(rng.choice(["X", "Y", None]), "1h", rng.choice(numbers), rng.choice([None, "DOJI", "doji", "30", "1.5"]), k) for k in range(150)],
        "symbol string, timeframe string, close double, candle_pattern string, k int",
    ).withColumn("open_time", F.timestamp_seconds(F.col("k") * 3600))
    operators = [">", "<", ">=", "<=", "==", "!=", "crosses_above", "crosses_below", "~", None]
    rows = [
        (rng.choice(["X", "Y", "Z", None]), "1h", k, rng.choice(["close", "close", "candle_pattern", "absent", None]), rng.choice(operators),
         rng.choice(numbers), rng.choice([None, None, "Doji", "30", "1.50"]))
        for k in range(500)
    ]
    rows += [("X", "1h", 500 + k, "close", "crosses_above", 2.25, None) for k in range(40)]
    conditions = spark.createDataFrame(
        rows, "symbol string, timeframe string, condition_id int, field string, operator string, value_num double, value_str string"
    )
    got = R.condition_hits(candles, conditions)
    prepared = R.with_previous(candles)
    numeric, text = R._fields(prepared)
    left = R._prepared(prepared, numeric, text)
    rules = conditions.select("symbol", "timeframe", "condition_id", F.array(F.struct("field", "operator", "value_num", "value_str")).alias("conditions"), F.lit("AND").alias("logic"))
    right = R.compiled(rules, numeric + text).withColumnsRenamed({"symbol": "s", "timeframe": "t"})
    same = F.col("symbol").eqNullSafe(F.col("s")) & F.col("timeframe").eqNullSafe(F.col("t"))
    passed = R.rule_passed()
    lacks = F.col("_first.at") < 0
    pairs = left.join(right, same).groupBy("condition_id").agg(
        F.count_if(passed).alias("hits"), F.min(F.when(passed, F.col("open_time"))).alias("first_time"),
        F.count_if(lacks | F.get("_before", F.col("_first.at")).isNull()).alias("without_previous"),
    )
    columns = ["condition_id", "hits", "first_time", "without_previous"]
    want = sorted(map(tuple, pairs.select(columns).collect()))
    assert sorted(map(tuple, got.select(columns).collect())) == want
    assert sum(row[1] > 0 for row in want) > 150


def test_equal_crossings_form_no_row_for_each_hit(spark, monkeypatch):
    seen = []
    candidates = R.candidates
    monkeypatch.setattr(R, "candidates", lambda prepared, looked_up, condition: seen.append(looked_up.count()) or candidates(prepared, looked_up, condition))
    candles = spark.createDataFrame([("X", "1h", k, float(k % 7)) for k in range(40)], "symbol string, timeframe string, k int, close double")
    candles = candles.withColumn("open_time", F.timestamp_seconds(F.col("k") * 3600))
    rows = [("X", "1h", k, "close", "crosses_above", float(k % 5), None) for k in range(200)]
    conditions = spark.createDataFrame(
        rows, "symbol string, timeframe string, condition_id int, field string, operator string, value_num double, value_str string"
    )
    assert R.condition_hits(candles, conditions).where("hits > 0").count() == 200
    assert seen == [0]
