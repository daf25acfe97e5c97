"""Alert rules: validation, normalisation, matching and evaluation."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewright import fixed
from candlewright.functions.numbers import number_text, to_number
from candlewright.operators.indicators import previous_candle
from candlewright.session import stored

MATCH_KEYS = ("symbol", "timeframe")
#: How a condition is looked up, those that fewest candles meet first. PLAIN ones are looked up by no value.
ABOVE, BELOW, EQUAL, WORD, LOW, HIGH, PLAIN, NEVER = range(8)
#: Rules alike that one task takes for a hit; of a larger set each hit is dealt to several tasks.
CROWD = 4096
RANGED = (">", ">=", "<", "<=", "crosses_above", "crosses_below")


# --- one condition -------------------------------------------------------------------------------

def threshold(condition: Column) -> Column:
    """The condition's value as a number, null where it has none."""
    return F.coalesce(condition["value_num"], to_number(condition["value_str"]))


def condition_passed(
    operator: Column, limit: Column, value_num: Column, value_str: Column,
    number: Column, text: Column, previous: Column,
) -> Column:
    """Whether one condition holds: always true or false, never null.

    ``number`` and ``text`` are the current field (numeric fields have no text), ``previous`` its
    value one candle earlier. NaN compares as false, as it would not under Spark's ordering.
    """
    known = ~F.isnan(number) & ~F.isnan(limit)
    crossing = known & ~F.isnan(previous)
    equal = F.when(
        text.isNull() & value_num.isNotNull(), number == value_num
    ).otherwise(
        F.upper(F.coalesce(text, number_text(number)))
        == F.upper(F.coalesce(value_str, number_text(value_num)))
    )
    result = (
        F.when(operator == ">", known & (number > limit))
        .when(operator == "<", known & (number < limit))
        .when(operator == ">=", known & (number >= limit))
        .when(operator == "<=", known & (number <= limit))
        .when(operator == "==", equal)
        .when(operator == "!=", ~equal)
        .when(operator == "crosses_above", crossing & (previous <= limit) & (number > limit))
        .when(operator == "crosses_below", crossing & (previous >= limit) & (number < limit))
    )
    return F.coalesce(result, F.lit(False))


def condition_text(
    field: Column, operator: Column, limit: Column, value_num: Column, value_str: Column,
    number: Column, text: Column, previous: Column, previous_text: Column, passed: Column,
) -> Column:
    """How one condition went, in words."""
    crosses = operator.startswith("crosses_")
    numeric = (limit.isNotNull() & number.isNotNull()) | operator.isin("==", "!=")
    usable = numeric & (~crosses | previous.isNotNull())
    shown_value = F.coalesce(value_str, number_text(value_num), F.lit("None"))
    return (
        F.when(number.isNull() & text.isNull(), F.concat(F.coalesce(field, F.lit("")), F.lit(" is None")))
        .when(~F.coalesce(operator, F.lit("")).isin(*fixed.OPERATORS),
              F.concat(F.lit("Unknown operator: "), F.coalesce(operator, F.lit(""))))
        .when(crosses & previous.isNull() & previous_text.isNull(),
              F.concat(F.lit("No previous data for "), field))
        .when(~usable, F.lit("Evaluation error"))
        .otherwise(F.concat(
            field, F.lit(" "), operator, F.lit(" "), shown_value,
            F.lit(" → "), F.when(passed, F.lit("✓")).otherwise(F.lit("✗")),
            F.lit(" (current="), F.coalesce(text, number_text(number)), F.lit(")"),
        ))
    )


# --- whole rules ---------------------------------------------------------------------------------

def _fields(candles: DataFrame) -> tuple[list[str], list[str]]:
    """The fields a condition may name: every number and text the candle carries."""
    numeric = [f.name for f in candles.schema if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in candles.schema if isinstance(f.dataType, T.StringType)]
    return numeric, text


def compiled(rules: DataFrame, fields: list[str]) -> DataFrame:
    """Rules with each condition's field position and numeric threshold worked out once."""
    names = F.array(*[F.lit(f) for f in fields])
    return rules.withColumn(
        "_conditions",
        F.transform(
            "conditions",
            lambda c: F.struct(
                c["field"].alias("field"), c["operator"].alias("operator"),
                c["value_num"].alias("value_num"), c["value_str"].alias("value_str"),
                threshold(c).alias("limit"),
                (F.coalesce(F.array_position(names, c["field"]), F.lit(0)) - 1).cast("int").alias("at"),
            ),
        ),
    ).withColumns({
        "_logic": F.upper(F.coalesce("logic", F.lit(fixed.DEFAULT_LOGIC))),
        "_first": F.get("_conditions", F.lit(0)),
    })


def _arrays(candles: DataFrame, numeric: list[str], text: list[str]) -> dict[str, Column]:
    """Current and previous fields as arrays, in the order conditions point into them."""
    def numbers(get):
        return F.array(*[get(f).cast("double") for f in numeric], *[to_number(get(f)) for f in text])

    def texts(get):
        return F.array(*[F.lit(None).cast("string") for _ in numeric], *[get(f) for f in text])

    now, before = F.col, lambda f: F.col("prev").getField(f)
    return {
        "_now": numbers(now), "_now_text": texts(now),
        "_before": numbers(before), "_before_text": texts(before),
    }


def _passed(c: Column) -> Column:
    at = c["at"]
    return condition_passed(
        c["operator"], c["limit"], c["value_num"], c["value_str"],
        F.get("_now", at), F.get("_now_text", at), F.get("_before", at),
    )


def _described(c: Column) -> Column:
    at = c["at"]
    return condition_text(
        c["field"], c["operator"], c["limit"], c["value_num"], c["value_str"],
        F.get("_now", at), F.get("_now_text", at), F.get("_before", at),
        F.get("_before_text", at), _passed(c),
    )


def rule_passed() -> Column:
    """AND needs all conditions, OR one; no conditions or any other logic never pass."""
    return F.coalesce(
        (F.size("_conditions") > 0)
        & F.when(F.col("_logic") == "AND", F.forall("_conditions", _passed))
        .when(F.col("_logic") == "OR", F.exists("_conditions", _passed)),
        F.lit(False),
    )


# --- rules alike ---------------------------------------------------------------------------------

def with_sets(rules: DataFrame, *also: str) -> DataFrame:
    """Adds ``_set``, the same for rules alike in series, conditions, logic and the columns ``also``, and what it is made of.

    Numbers are taken as text, in which -0.0 and 0.0 differ, as they do in the words of a condition.
    """
    shape = F.transform("conditions", lambda c: F.struct(
        c["field"].alias("field"), c["operator"].alias("operator"),
        c["value_num"].cast("string").alias("value_num"), c["value_str"].alias("value_str"),
    ))
    parts = F.struct(*MATCH_KEYS, F.upper("logic").alias("logic"), shape.alias("shape"), *also)
    return rules.withColumn("_parts", parts).withColumn(
        "_set", F.unhex(F.sha2(F.to_json("_parts", {"ignoreNullFields": "false"}), 256))
    )


def sets(rules: DataFrame, *also: str) -> DataFrame:
    """One rule for each ``_set`` of rules, and _members, how many are in it."""
    parts = [*MATCH_KEYS, "logic", "shape", *also]
    counted = rules.select("_set", "_parts.*").groupBy("_set", *parts).agg(F.count("*").alias("_members"))
    conditions = F.transform("shape", lambda c: F.struct(
        c["field"].alias("field"), c["operator"].alias("operator"),
        c["value_num"].cast("double").alias("value_num"), c["value_str"].alias("value_str"),
    ))
    return counted.withColumn("conditions", conditions).drop("shape")


# --- the condition index ---------------------------------------------------------------------------

def _lookup(c: Column, ordinal: Column, numeric_fields: int) -> Column:
    """How a condition is found from a candle: kind, place among its rule's, field, and the value to meet.

    It is never missed by a candle that passes; NEVER marks what no candle passes.
    """
    operator, limit, at = c["operator"], c["limit"], c["at"]
    number = limit.isNotNull() & ~F.isnan(limit)
    is_text = at >= numeric_fields
    word = F.upper(F.coalesce(c["value_str"], number_text(c["value_num"])))
    equal = (
        F.when(is_text, F.when(word.isNull(), NEVER).otherwise(WORD))
        .when(c["value_num"].isNotNull(), F.when(F.isnan(c["value_num"]), NEVER).otherwise(EQUAL))
        .otherwise(PLAIN)
    )
    ranges = {">": LOW, ">=": LOW, "<": HIGH, "<=": HIGH, "crosses_above": ABOVE, "crosses_below": BELOW}
    kind = F.when((at < 0) | operator.isNull(), NEVER).when(operator == "==", equal).when(operator == "!=", PLAIN)
    for name, found in ranges.items():
        kind = kind.when(operator == name, F.when(number, found).otherwise(NEVER))
    kind = F.coalesce(kind, F.lit(NEVER))
    ranged = kind.isin(ABOVE, BELOW, LOW, HIGH)
    return F.struct(
        kind.alias("kind"), ordinal.alias("ordinal"), at.alias("at"),
        # Adding zero leaves one zero: limits of -0.0 and 0.0 are equal.
        (F.when(kind == EQUAL, c["value_num"]).when(ranged, limit).otherwise(0.0) + 0.0).alias("limit"),
        F.when(kind == WORD, word).otherwise("").alias("word"),
    )


def entries(rules: DataFrame, numeric_fields: int) -> DataFrame:
    """Compiled rules with ``_entry``, once for each condition they are looked up by.

    A rule that needs all its conditions is looked up by the one that fewest candles should meet, one that
    needs any by each. Rules that no candle can pass have no entry.
    """
    found = F.transform("_conditions", lambda c, k: _lookup(c, k, numeric_fields))
    alive = F.filter("_found", lambda e: e["kind"] < NEVER)
    whole = (F.size("_found") > 0) & (F.size(alive) == F.size("_found"))
    chosen = F.when((F.col("_logic") == "AND") & whole, F.array(F.array_min("_found"))).when(F.col("_logic") == "OR", alive)
    return rules.withColumn("_found", found).withColumn("_entry", F.explode(chosen)).drop("_found")


def _bound(limits: Column, value: Column, after: bool) -> Column:
    """How many of the sorted limits lie below ``value``, or with ``after`` not above it, by binary search."""
    def halve(span, _):
        middle = F.floor((span["low"] + span["high"]) / 2).cast("int")
        limit = F.get(limits, middle)
        right = (limit <= value) if after else (limit < value)
        open_ = span["low"] < span["high"]
        return F.struct(
            F.when(open_ & right, middle + 1).otherwise(span["low"]).alias("low"),
            F.when(open_ & ~right, middle).otherwise(span["high"]).alias("high"),
        )

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(limits) + 1)).cast("int"))
    start = F.struct(F.lit(0).alias("low"), F.size(limits).alias("high"))
    return F.aggregate(steps, start, halve, lambda span: span["low"])


def _met(kind: Column, limits: Column, now: Column, before: Column) -> Column:
    """The slice of the sorted limits that a candle meets; of crossings, those between its two values."""
    none = F.slice(limits, 1, 0)
    known = now.isNotNull() & ~F.isnan(now)
    crossed = known & before.isNotNull() & ~F.isnan(before)
    first = (
        F.when(kind == LOW, 0).when(kind == ABOVE, _bound(limits, before, False)).otherwise(_bound(limits, now, False))
    )
    last = (
        F.when(kind.isin(LOW, EQUAL, ABOVE), _bound(limits, now, True))
        .when(kind == BELOW, _bound(limits, before, True)).otherwise(F.size(limits))
    )
    ranged = F.slice(limits, first + 1, F.greatest(last - first, F.lit(0)))
    return (
        F.when(kind.isin(WORD, PLAIN), limits)
        .when(kind.isin(ABOVE, BELOW), F.when(crossed, ranged).otherwise(none))
        .otherwise(F.when(known, ranged).otherwise(none))
    )


def _same_series(left: DataFrame, right: DataFrame) -> tuple[DataFrame, Column]:
    """``right`` with its keys renamed, and the test that both are of one series; nulls are a value."""
    right = right.withColumnsRenamed({k: f"_{k}" for k in MATCH_KEYS})
    same = None
    for key in MATCH_KEYS:
        equal = F.col(key).eqNullSafe(F.col(f"_{key}"))
        same = equal if same is None else same & equal
    return right, same


def candidates(prepared: DataFrame, looked_up: DataFrame, condition: Column) -> DataFrame:
    """Candles with the rules whose entry they meet and that fulfil ``condition``.

    The index holds, for each series, field and kind, the different limits in order. A candle finds the
    limits it meets by binary search and goes to these alone, so a rule far from a candle's values is
    never met. Both joins are on equal keys: adaptive execution broadcasts a side it has measured to be
    small, and splits the candles of a hot series.
    """
    key = [*MATCH_KEYS, F.col("_entry.at").alias("_at"), F.col("_entry.kind").alias("_kind")]
    index, same = _same_series(
        prepared, looked_up.groupBy(*key).agg(F.sort_array(F.collect_set("_entry.limit")).alias("_limits"))
    )
    now, before = F.get("_now", F.col("_at")), F.get("_before", F.col("_at"))
    met = prepared.join(index, same).withColumn("_limit", F.explode(_met(F.col("_kind"), F.col("_limits"), now, before)))
    word = F.when(F.col("_kind") == WORD, F.upper(F.get("_now_text", F.col("_at")))).otherwise("")
    met = met.withColumn("_word", word).drop("_limits", *[f"_{k}" for k in MATCH_KEYS])
    side, same = _same_series(met, looked_up)
    same = same & (F.col("_kind") == F.col("_entry.kind")) & (F.col("_at") == F.col("_entry.at"))
    same = same & (F.col("_limit") == F.col("_entry.limit")) & (F.col("_word") == F.col("_entry.word"))
    return met.join(side, same & condition).drop("_kind", "_at", "_limit", "_word", "_entry", *[f"_{k}" for k in MATCH_KEYS])


def _new_hit() -> Column:
    """A rule that passes, found by the first of its conditions that does."""
    earlier = F.slice("_conditions", 1, F.col("_entry.ordinal"))
    own = F.get("_conditions", F.col("_entry.ordinal"))
    every = (F.size("_conditions") > 0) & F.forall("_conditions", _passed)
    return F.when(F.col("_logic") == "AND", every).when(F.col("_logic") == "OR", _passed(own) & ~F.exists(earlier, _passed)).otherwise(False)


def active(rules: DataFrame) -> DataFrame:
    return rules.filter(F.coalesce("is_active", F.lit(True)))


def with_previous(candles: DataFrame) -> DataFrame:
    return candles if "prev" in candles.columns else previous_candle(candles)


def matched_candles(candles: DataFrame, rules: DataFrame) -> DataFrame:
    """For each active rule the candles of its symbol and timeframe: candles, first_time, last_time.

    All rules of a series have the same candles, so these are counted once a series. Rules without a
    candle are left out.
    """
    spans = candles.groupBy(*MATCH_KEYS).agg(
        F.count("*").alias("candles"), F.min("open_time").alias("first_time"), F.max("open_time").alias("last_time")
    )
    spans, same = _same_series(rules, spans)
    return active(rules).join(spans, same).drop(*[f"_{k}" for k in MATCH_KEYS])


def _prepared(candles: DataFrame, numeric: list[str], text: list[str], *columns: Column) -> DataFrame:
    arrays = _arrays(candles, numeric, text)
    return candles.select(*MATCH_KEYS, "open_time", *columns, *[c.alias(name) for name, c in arrays.items()])


def evaluate_sets(candles: DataFrame, rules: DataFrame, *also: str) -> tuple[DataFrame, DataFrame]:
    """What triggers, once for all rules alike, and the active rules with the ``_set`` they are in.

    Rules of one series with the same conditions and logic trigger on the same candles with the same
    words, so these are worked out once a set, whatever the number of its rules. ``expanded`` gives each
    rule its rows. Rules that differ in a column of ``also`` are kept in different sets, which have it.
    """
    candles = with_previous(candles)
    numeric, text = _fields(candles)
    # Work per candle grows with the sets it meets, not with its bytes, by which tasks would be coalesced.
    tasks = int(candles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    candles = candles.repartition(tasks, *MATCH_KEYS, "open_time")
    row = F.struct(*[c for c in candles.columns if c != "prev"]).alias("triggered_row")
    members = with_sets(active(rules), *also)
    # Read several times, and a stored table has a known size, by which Spark decides whether to broadcast it.
    looked_up = stored(entries(compiled(sets(members, *also), numeric + text), len(numeric)), "rule-entries")
    hits = candidates(_prepared(candles, numeric, text, row), looked_up, _new_hit()).select(
        "_set", "_members", *also, *MATCH_KEYS, F.transform("_conditions", _described).alias("conditions_met"), "triggered_row",
    )
    tasks_of = F.ceil(F.col("_members") / CROWD).cast("int")
    crowds = looked_up.where(F.col("_members") > CROWD).select("_set", tasks_of.alias("_tasks")).distinct()
    part = F.pmod(F.xxhash64("rule_id"), F.coalesce("_tasks", F.lit(1))).cast("int")
    members = members.join(crowds, "_set", "left").withColumn("_part", part).drop("_tasks", "_parts")
    return hits, members


def expanded(hits: DataFrame, members: DataFrame, *columns: str) -> DataFrame:
    """Rows by ``_set`` (with _members) as rows of its rules, with ``columns`` of the rule.

    A set of over ``CROWD`` rules is dealt by rule to several tasks and each of its rows to all of them.
    """
    parts = F.sequence(F.lit(0), F.ceil(F.col("_members") / CROWD).cast("int") - 1)
    dealt = hits.withColumn("_part", F.explode(parts))
    return dealt.join(members.select("_set", "_part", *columns), ["_set", "_part"]).drop("_set", "_part", "_members")


def evaluate(candles: DataFrame, rules: DataFrame) -> DataFrame:
    """Triggered rules: the rule, how every condition went, and the candle that triggered it."""
    own = [c for c in rules.columns if c not in MATCH_KEYS]
    return expanded(*evaluate_sets(candles, rules), *own).select(*own, *MATCH_KEYS, "conditions_met", "triggered_row")


def _interval(operator: Column, limits: Column, now: Column, before: Column) -> tuple[Column, Column]:
    """From and to which of the sorted limits the condition holds for a candle; null where for none."""
    below, upto = _bound(limits, now, False), _bound(limits, now, True)
    first = (
        F.when(operator.isin(">", ">="), 0).when(operator == "<=", below)
        .when(operator == "crosses_above", _bound(limits, before, False)).otherwise(upto)
    )
    last = (
        F.when(operator.isin(">", "crosses_above"), below).when(operator == ">=", upto)
        .when(operator == "crosses_below", _bound(limits, before, True)).otherwise(F.size(limits))
    )
    known = now.isNotNull() & ~F.isnan(now)
    crossed = before.isNotNull() & ~F.isnan(before)
    holds = known & (crossed | ~operator.isin("crosses_above", "crosses_below"))
    return F.when(holds, first), F.when(holds, last)


def _spans(first: Column, last: Column, limits: Column) -> Column:
    """The range of places first to last as at most two aligned spans of each power of two: (level, node)."""
    def at(level):
        size = F.pow(F.lit(2), level).cast("bigint")
        low, high = F.ceil(first / size), F.floor(last / size)
        left = F.when((low < high) & (low % 2 == 1), F.struct(level.alias("level"), low.alias("node")))
        right = F.when((low < high) & (high % 2 == 1), F.struct(level.alias("level"), (high - 1).alias("node")))
        return F.array(left, right)

    return F.filter(F.flatten(F.transform(_levels(limits), at)), lambda span: span.isNotNull())


def _levels(limits: Column) -> Column:
    return F.sequence(F.lit(0), F.ceil(F.log2(F.size(limits))).cast("int"))


def _ranged_hits(prepared: DataFrame, ranged: DataFrame) -> DataFrame:
    """_set, hits, first_time of conditions that compare with a number, without a row for each hit.

    A candle meets a range of its series' sorted limits. The range is taken as aligned spans, a few for each
    power of two; candles are counted by span, and a limit adds up the spans it lies in.
    """
    by = [*MATCH_KEYS, "_at", "_operator"]
    name = F.sha2(F.to_json(F.struct(*by), {"ignoreNullFields": "false"}), 256).alias("_index")
    asked = ranged.select("_set", *MATCH_KEYS, F.col("_first.at").alias("_at"), F.col("_first.operator").alias("_operator"),
                          (F.col("_first.limit") + 0.0).alias("_limit")).withColumn("_index", name)
    index = asked.groupBy("_index", *by).agg(F.sort_array(F.collect_set("_limit")).alias("_limits"))
    side, same = _same_series(prepared, index)
    now, before = F.get("_now", F.col("_at")), F.get("_before", F.col("_at"))
    first, last = _interval(F.col("_operator"), F.col("_limits"), now, before)
    met = prepared.join(side, same).select("_index", "open_time", "_limits", first.alias("_from"), last.alias("_to")).where("_from < _to")
    spans = met.select("_index", "open_time", F.explode(_spans(F.col("_from"), F.col("_to"), F.col("_limits"))).alias("_span"))
    counted = spans.groupBy("_index", "_span.level", "_span.node").agg(F.count("*").alias("n"), F.min("open_time").alias("t"))
    placed = asked.select("_set", "_index", "_limit").join(index.select("_index", "_limits"), "_index").select(
        "_set", "_index", (F.array_position("_limits", F.col("_limit")) - 1).alias("_place"), F.explode(_levels(F.col("_limits"))).alias("level"),
    )
    lying = placed.withColumn("node", F.floor(F.col("_place") / F.pow(F.lit(2), F.col("level")).cast("bigint")))
    return lying.join(counted, ["_index", "level", "node"]).groupBy("_set").agg(F.sum("n").alias("hits"), F.min("t").alias("first_time"))


def condition_hits(candles: DataFrame, conditions: DataFrame) -> DataFrame:
    """Every condition (``condition_id`` and its parts): hits, first_time, and without_previous.

    ``without_previous`` counts the candles of its series that have no earlier value of its field. Equal
    conditions are worked out once; those that compare with a number are counted by ranges of limits, for
    others candles meet only the conditions they fulfil. Conditions without a candle in their series are left out.
    """
    candles = with_previous(candles)
    numeric, text = _fields(candles)
    rules = with_sets(conditions.select(
        *MATCH_KEYS, "condition_id", F.array(F.struct("field", "operator", "value_num", "value_str")).alias("conditions"),
        F.lit("AND").alias("logic"),
    ))
    distinct = stored(compiled(sets(rules), numeric + text), "condition-sets")
    prepared = _prepared(candles, numeric, text)
    limit, at = F.col("_first.limit"), F.col("_first.at")
    counted = F.coalesce(F.col("_first.operator").isin(*RANGED) & limit.isNotNull() & ~F.isnan(limit) & (at >= 0), F.lit(False))
    others = stored(entries(distinct.where(~counted), len(numeric)), "rule-entries")
    hits = _ranged_hits(prepared, distinct.where(counted)).union(
        candidates(prepared, others, _new_hit()).groupBy("_set").agg(F.count("*").alias("hits"), F.min("open_time").alias("first_time"))
    )
    lacking = prepared.groupBy(*MATCH_KEYS).agg(F.array(*[
        F.count_if(F.get("_before", F.lit(k)).isNull()) for k in range(len(numeric) + len(text))
    ]).alias("_lacking"), F.count("*").alias("_rows"))
    lacking, same = _same_series(distinct, lacking)
    found = distinct.join(lacking, same).join(hits, "_set", "left").select(
        "_set", F.coalesce("hits", F.lit(0)).alias("hits"), "first_time",
        F.when(at < 0, F.col("_rows")).otherwise(F.get("_lacking", at)).alias("without_previous"),
    )
    return rules.select("_set", *MATCH_KEYS, "condition_id").join(found, "_set").drop("_set")


# --- validation ----------------------------------------------------------------------------------

def with_defaults(rules: DataFrame) -> DataFrame:
    """Fill what a user may leave out and upper-case the symbol."""
    return rules.withColumns({
        "symbol": F.upper("symbol"),
        "logic": F.coalesce("logic", F.lit(fixed.DEFAULT_LOGIC)),
        "notification_channels": F.coalesce(
            "notification_channels", F.array(*[F.lit(c) for c in fixed.DEFAULT_CHANNELS])
        ),
        "cooldown_seconds": F.coalesce("cooldown_seconds", F.lit(fixed.DEFAULT_COOLDOWN)),
        "is_active": F.coalesce("is_active", F.lit(True)),
    })


def _condition_error(c: Column) -> Column:
    pattern = F.upper(F.coalesce(c["value_str"], number_text(c["value_num"])))
    return (
        F.when(~_one_of(c["field"], fixed.NUMERIC_FIELDS + fixed.TEXT_FIELDS), "unknown condition field")
        .when(~_one_of(c["operator"], fixed.OPERATORS), "unknown condition operator")
        .when((c["field"] == "candle_pattern") & ~_one_of(pattern, fixed.PATTERNS), "unknown candle pattern")
        .when((c["field"] != "candle_pattern") & threshold(c).isNull(), "condition value is not a number")
    )


def _one_of(value: Column, domain: list[str]) -> Column:
    return F.coalesce(value.isin(*domain), F.lit(False))


def value_errors(of, given) -> Column:
    """Reasons against the single values of a rule or patch; ``given`` says which values are checked."""
    logic, action, channels = of("logic"), of("action"), of("notification_channels")
    cooldown, conditions = of("cooldown_seconds"), of("conditions")
    checks = F.array(
        F.when(given(logic) & ~_one_of(logic, fixed.LOGICS), "unknown logic"),
        F.when(given(action) & ~_one_of(action, fixed.ACTIONS), "unknown action"),
        F.when(F.exists(channels, lambda c: ~_one_of(c, fixed.CHANNELS)), "unknown channel"),
        F.when((cooldown < fixed.MIN_COOLDOWN) | (cooldown > fixed.MAX_COOLDOWN), "cooldown out of range"),
    )
    wrong = F.coalesce(F.transform(conditions, _condition_error), F.array().cast("array<string>"))
    return F.filter(F.concat(checks, F.array_distinct(wrong)), lambda e: e.isNotNull())


def rule_errors() -> Column:
    """All reasons a rule is refused, as an array; empty for a valid rule."""
    channels = F.col("notification_channels")
    uses = lambda name: F.coalesce(F.array_contains(channels, name), F.lit(False))
    number = F.coalesce(F.size("conditions"), F.lit(0))
    cooldown = F.col("cooldown_seconds")
    checks = F.array(
        F.when(F.col("symbol").isNull(), "symbol is missing"),
        F.when(~_one_of(F.col("timeframe"), list(fixed.TIMEFRAME_SECONDS)), "unknown timeframe"),
        F.when((number < fixed.MIN_CONDITIONS) | (number > fixed.MAX_CONDITIONS), "1 to 10 conditions required"),
        F.when(~_one_of(F.col("logic"), fixed.LOGICS), "unknown logic"),
        F.when(~_one_of(F.col("action"), fixed.ACTIONS), "unknown action"),
        F.when(F.exists(channels, lambda c: ~_one_of(c, fixed.CHANNELS)), "unknown channel"),
        F.when(uses("email") & ~F.coalesce(F.col("email_address").contains("@"), F.lit(False)), "email_address is required"),
        F.when(uses("webhook") & (F.coalesce("webhook_url", F.lit("")) == ""), "webhook_url is required"),
        F.when((cooldown < fixed.MIN_COOLDOWN) | (cooldown > fixed.MAX_COOLDOWN), "cooldown out of range"),
    )
    conditions = F.coalesce(F.transform("conditions", _condition_error), F.array().cast("array<string>"))
    return F.filter(F.concat(checks, F.array_distinct(conditions)), lambda e: e.isNotNull())


def checked(rules: DataFrame) -> DataFrame:
    return with_defaults(rules).withColumn("errors", rule_errors())


def validate(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rules, and refused ones with their errors."""
    both = checked(rules)
    return both.filter(F.size("errors") == 0).drop("errors"), both.filter(F.size("errors") > 0)


def duplicate_ids(rules: DataFrame) -> DataFrame:
    """Rule ids that occur more than once; a sound rules table has none."""
    return rules.groupBy("rule_id").agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


# --- lists ---------------------------------------------------------------------------------------

def owned(
    rules: DataFrame, user_id: str, symbol: str | None = None, timeframe: str | None = None,
    is_active: bool | None = None, rule_id: str | None = None,
) -> DataFrame:
    out = rules.filter(F.col("user_id") == user_id)
    if symbol:
        out = out.filter(F.col("symbol") == symbol.upper())
    if timeframe:
        out = out.filter(F.col("timeframe") == timeframe)
    if is_active is not None:
        out = out.filter(F.col("is_active") == is_active)
    if rule_id:
        out = out.filter(F.col("rule_id") == rule_id)
    return out


def page(rules: DataFrame, number: int = 1, limit: int = fixed.DEFAULT_PAGE_SIZE) -> DataFrame:
    """One page, newest rules first."""
    if number < 1 or not 1 <= limit <= fixed.MAX_PAGE_SIZE:
        raise ValueError(f"page must be >= 1 and limit within 1..{fixed.MAX_PAGE_SIZE}")
    return rules.orderBy(F.desc("created_at"), "rule_id").offset((number - 1) * limit).limit(limit)


def total(rules: DataFrame) -> DataFrame:
    return rules.agg(F.count("*").alias("total"))
