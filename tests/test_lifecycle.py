"""A change log applied in bulk against its changes applied one at a time."""

import random

from pyspark.sql import functions as F

from candlewright import schemas
from candlewright.operators import lifecycle as L
from candlewright.operators import rules as R

PAYLOAD = ["symbol", "timeframe", "conditions", "logic", "action", "notification_channels",
           "email_address", "webhook_url", "cooldown_seconds", "is_active"]
COND = [("close", ">", 1.0, None)]


def payload(**values):
    return tuple(values.get(c) for c in PAYLOAD)


def one_by_one(rules, changes):
    """Plain sequential application, as the service would do it request by request."""
    table = {r["rule_id"]: dict(r) for r in rules}
    for rule_id, user, op, ts, values in sorted(changes, key=lambda c: c[3]):
        values = dict(zip(PAYLOAD, values)) if values else {}
        held = table.get(rule_id)
        if op == "create" and held is None:
            if owners.setdefault(rule_id, user) != user:
                continue
            table[rule_id] = {
                "rule_id": rule_id, "user_id": user, "symbol": values["symbol"].upper(), "action": values["action"],
                "cooldown_seconds": values["cooldown_seconds"] or 300, "logic": values["logic"] or "AND",
                "is_active": True if values["is_active"] is None else values["is_active"], "updated": ts,
            }
        elif held is None or held["user_id"] != user:
            continue
        elif op == "delete":
            del table[rule_id]
        elif op == "toggle":
            held["is_active"] = not (held["is_active"] is None or held["is_active"])
            held["updated"] = ts
        elif op == "patch":
            new = {c: values.get(c) for c in ("action", "cooldown_seconds", "logic", "is_active") if values.get(c) is not None}
            if new:
                held.update(new, updated=ts)
    return table


owners: dict = {}


def test_bulk_equals_one_by_one(spark):
    rng = random.Random(4)
    rules, changes = [], []
    owners.clear()
    for i in range(40):
        if i % 4:
            rules.append({
                "rule_id": f"r{i}", "user_id": "u0", "symbol": "ABC", "action": "BUY", "cooldown_seconds": 300,
                "logic": "AND", "is_active": [True, False, None][i % 3], "updated": 0,
            })
            owners[f"r{i}"] = "u0"
    ts = 0
    for i in range(40):
        for _ in range(400 if i == 5 else rng.randint(0, 14)):
            ts += 1
            op = rng.choice(["patch", "patch", "toggle", "toggle", "create", "delete" if rng.random() < 0.3 else "patch"])
            values = None
            if op == "create":
                values = payload(symbol="new", timeframe="1h", conditions=COND, action="SELL", notification_channels=["email"],
                                 email_address="a@b", is_active=rng.choice([None, True, False]))
            elif op == "patch":
                values = payload(**rng.choice([{"action": f"A{ts}"}, {"cooldown_seconds": ts}, {"is_active": ts % 2 == 0}, {"logic": "OR"}, {}]))
            user = rng.choice(["u0", "u0", "u0", "u1"])
            if op == "create" and f"r{i}" not in owners:
                owners[f"r{i}"] = user
            changes.append((f"r{i}", user, op, ts, values))
    want = one_by_one(rules, changes)

    table = spark.createDataFrame(
        [(r["rule_id"], r["user_id"], r["symbol"], "1h", COND, r["logic"], r["action"], ["email"], "a@b", None,
          r["cooldown_seconds"], r["is_active"], None, None, None, 0) for r in rules], schemas.RULES,
    ).withColumns({"created_at": F.timestamp_seconds(F.lit(0)), "updated_at": F.timestamp_seconds(F.lit(0))})
    log = spark.createDataFrame(changes, schemas.RULE_CHANGES.replace("ts timestamp", "ts bigint")).withColumn(
        "ts", F.timestamp_seconds("ts")
    )
    got = {r.rule_id: r for r in L.apply_changes(table, log).withColumn("at", F.unix_seconds("updated_at")).collect()}
    assert set(got) == set(want)
    for rule_id, w in want.items():
        g = got[rule_id]
        assert (g.user_id, g.symbol, g.action, g.cooldown_seconds, g.logic, g.is_active, g["at"]) == (
            w["user_id"], w["symbol"], w["action"], w["cooldown_seconds"], w["logic"], w["is_active"], w["updated"]
        ), rule_id


def test_change_log_is_aggregated_with_its_values_once(spark, sf_dir):
    from candlewright.sources import feeds

    log = feeds.rule_changes(spark, sf_dir)
    plan = L.apply_changes(feeds.stored_rules(spark, sf_dir), log)._jdf.queryExecution().executedPlan().toString()
    tree = plan.split("Initial Plan")[-1].splitlines()
    # Values have no fixed width and so are sorted: once before and once after their shuffle, times never.
    assert sum("SortAggregate" in line for line in tree) == 2


def test_change_log_keeps_lives_and_owners_apart(spark):
    """Times that meet: a delete right before a create, a patch before the start, creates and toggles of others."""
    made = payload(symbol="new", timeframe="1h", conditions=COND, action="SELL", notification_channels=["email"], email_address="a@b")
    log = [
        ("a", "u1", "patch", 1, payload(action="EARLY")), ("a", "u1", "create", 2, made), ("a", "u2", "create", 3, made),
        ("a", "u2", "toggle", 4, None), ("a", "u1", "toggle", 5, None), ("a", "u1", "patch", 6, payload()),
        ("b", "u1", "create", 1, made), ("b", "u1", "toggle", 2, None), ("b", "u1", "patch", 3, payload(is_active=False, logic="OR")),
        ("b", "u1", "delete", 4, None), ("b", "u1", "toggle", 5, None), ("b", "u1", "create", 6, made), ("b", "u1", "create", 7, made),
        ("c", "u1", "create", 1, made), ("c", "u1", "delete", 2, None), ("d", "u1", "toggle", 1, None), ("e", "u1", "patch", 1, payload()),
    ]
    table = spark.createDataFrame([], schemas.RULES)
    log = spark.createDataFrame(log, schemas.RULE_CHANGES.replace("ts timestamp", "ts bigint")).withColumn("ts", F.timestamp_seconds("ts"))
    got = {r.rule_id: (r.user_id, r.action, r.logic, r.is_active, r["at"]) for r in
           L.apply_changes(table, log).withColumn("at", F.unix_seconds("updated_at")).collect()}
    assert got == {"a": ("u1", "SELL", "AND", False, 5), "b": ("u1", "SELL", "AND", True, 6)}


def test_validation_reports_every_error(spark):
    good = dict(rule_id="r", user_id="u", symbol="abc", timeframe="1h", conditions=COND, action="BUY",
                notification_channels=["webhook"], webhook_url="https://h", cooldown_seconds=60)
    cases = [
        ({}, []), ({"conditions": []}, ["1 to 10 conditions required"]), ({"conditions": COND * 11}, ["1 to 10 conditions required"]),
        ({"cooldown_seconds": 59}, ["cooldown out of range"]), ({"cooldown_seconds": 86401}, ["cooldown out of range"]),
        ({"cooldown_seconds": 86400}, []), ({"cooldown_seconds": None}, []),
        ({"notification_channels": ["email"], "email_address": "nobody"}, ["email_address is required"]),
        ({"notification_channels": None}, ["email_address is required"]), ({"webhook_url": ""}, ["webhook_url is required"]),
        ({"notification_channels": ["telegram"]}, ["unknown channel"]), ({"timeframe": "2h", "action": "HOLD"}, ["unknown timeframe", "unknown action"]),
        ({"logic": "XOR"}, ["unknown logic"]), ({"conditions": [("candle_pattern", "==", None, "doji")]}, []),
        ({"conditions": [("candle_pattern", "==", None, "COMET")]}, ["unknown candle pattern"]),
        ({"conditions": [("close", ">", None, "low")]}, ["condition value is not a number"]), ({"conditions": [("close", ">", None, "12")]}, []),
        ({"conditions": [("close", "~", 1.0, None)]}, ["unknown condition operator"]), ({"conditions": [("ma8", ">", 1.0, None)]}, ["unknown condition field"]),
    ]
    names = [c.split(" ", 1)[0] for c in schemas.RULES.split(", ") if "struct" not in c and ":" not in c]
    names.insert(4, "conditions")
    rows = [tuple({**good, **change, "user_id": str(i)}.get(n) for n in names) for i, (change, _) in enumerate(cases)]
    got = {int(r.user_id): (r.errors, r.symbol) for r in R.checked(spark.createDataFrame(rows, schemas.RULES)).collect()}
    for i, (change, errors) in enumerate(cases):
        assert got[i] == (errors, "ABC"), change
    valid, refused = R.validate(spark.createDataFrame(rows, schemas.RULES))
    assert valid.count() + refused.count() == len(cases)


def test_page_bounds(spark, sf_dir):
    import pytest

    from candlewright.sources import feeds

    for number, limit in ((0, 20), (1, 0), (1, 101)):
        with pytest.raises(ValueError):
            R.page(feeds.rules(spark, sf_dir), number, limit)


def test_patches_with_a_bad_value_are_refused(spark):
    schema = "rule_id string, user_id string, ts timestamp, payload struct<" + ", ".join([
        "symbol: string", "timeframe: string", f"conditions: {schemas.CONDITIONS}", "logic: string", "action: string",
        "notification_channels: array<string>", "email_address: string", "webhook_url: string", "cooldown_seconds: int", "is_active: boolean",
    ]) + ">"
    patches = [payload(action="BUY"), payload(logic="XOR"), payload(action="HOLD"), payload(notification_channels=["pager"]),
               payload(cooldown_seconds=5), payload(conditions=[("nothing", ">", 1.0, None)]), payload(is_active=False, cooldown_seconds=60)]
    rows = [(f"r{i}", "u", None, p) for i, p in enumerate(patches)]
    valid, refused = L.validate_patches(spark.createDataFrame(rows, schema))
    assert sorted(r.rule_id for r in valid.collect()) == ["r0", "r6"]
    assert {r.rule_id: r.errors for r in refused.collect()} == {
        "r1": ["unknown logic"], "r2": ["unknown action"], "r3": ["unknown channel"],
        "r4": ["cooldown out of range"], "r5": ["unknown condition field"]}
